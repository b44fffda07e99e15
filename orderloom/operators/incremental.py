"""Incremental load above a high watermark.

The comparison is strict: a late row dated on or before the watermark is not
loaded, and neither is a row without a date once the table holds any date.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.lake import Lake


def watermark(loaded: DataFrame) -> DataFrame:
    """One row with the highest loaded order date; NULL for an empty table."""
    return loaded.agg(F.expr("max(order_date) AS watermark"))


def rows_after(batch: DataFrame, last_loaded: date | None) -> DataFrame:
    """Batch rows above a known watermark; the literal is pushed to the scan."""
    if last_loaded is None:
        return batch
    return batch.where(F.col("order_date") > F.lit(last_loaded))


def new_rows(batch: DataFrame, loaded: DataFrame) -> DataFrame:
    """Batch rows above the watermark of ``loaded``, as one lazy plan.

    The watermark is a scalar subquery: one value, computed once, no join. It is not
    known when the scan is planned, so no filter is pushed down; the job that loads
    takes ``rows_after`` with a literal.
    """
    last_loaded = watermark(loaded).scalar()
    return batch.where(last_loaded.isNull() | (F.col("order_date") > last_loaded))


def append_by_name(loaded: DataFrame, batch: DataFrame) -> DataFrame:
    """The table after an incremental append, columns matched by name.

    A column of the batch that the table doesn't have is an error; one that it lacks is
    NULL.
    """
    known = {name.lower() for name in loaded.columns}
    if unknown := sorted(name for name in batch.columns if name.lower() not in known):
        raise ValueError(f"columns that the table does not have: {unknown}")
    return loaded.unionByName(new_rows(batch, loaded), allowMissingColumns=True)


LOAD_MODES = ("incremental", "append", "replace")


def load_bronze(lake: Lake, batch: DataFrame, mode: str = "incremental", batch_id: str | None = None) -> int:
    """Load a batch into bronze and return the number of rows written.

    ``incremental`` appends the rows above the watermark. The watermark is read
    before the write starts, so the table is never read while it grows, and
    loading the same batch again adds nothing. ``append`` adds the whole batch
    as it is, repeats included. ``replace`` drops what was there first.

    A batch counts whole or not at all. ``batch_id`` (letters, digits, ``_`` and ``-``)
    names it: a batch of that name that bronze holds already adds nothing in the first
    two modes, so a load can be repeated after a failure whatever had become of it.
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode {mode!r} is none of {', '.join(LOAD_MODES)}")
    if batch_id is not None and not re.fullmatch(r"[\w-]+", batch_id, re.ASCII):
        raise ValueError(f"batch id {batch_id!r} has other characters than letters, digits, _ and -")
    if mode == "replace":
        return lake.replace_bronze(batch, batch_id)
    if batch_id is not None and lake.has_batch(batch_id):
        return 0
    if mode == "incremental":
        batch = rows_after(batch, lake.bronze_watermark())
    return lake.append_bronze(batch, batch_id)
