"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words. Its documents, ordered by size, then
get ``target / source size`` expected copies each; their running sum plus one random
offset per source crosses integers, and each crossing emits the document once.
Since the running sum never strays more than one copy from its expectation, the
words taken miss the target by about one document's size.

The running sum is worked out in levels, so that no task holds a whole source:
documents are counted by (source, size band, hash bucket), those counts are summed
up over a source's bands and a band's buckets, and ranks inside one such cell come
from a window over the cell. The number of cells of a source is bounded by ``BUCKETS`` and the
number of bands, whatever the data. A source, a size or a text that holds a third
of all rows is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, checkpointed, text_of

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
BUCKETS = 256
SEED = 7

#: Sizes up to this have a band each; larger ones share bands about 4 % wide.
FINE_SIZES = 64
BANDS_PER_OCTAVE = 16


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _with_sums_before(rows: DataFrame, order: Column, values: dict[str, Column]) -> DataFrame:
    """``rows`` with the sums of ``values`` over the rows before each in ``order``, a total one.

    Rows are range-partitioned and written, so that no task holds them all. Sums inside a
    partition start from those of the partitions before it: one row per partition meets in
    one task, as many as the session's shuffle partitions at most.
    """
    placed = checkpointed(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    parts = parts.select("_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_parts") for n in values])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {n: F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"{n}_parts") for n, v in values.items()}
    return placed.join(parts, "_part").select(*rows.columns, *[v.alias(n) for n, v in sums.items()])


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``target`` for each row of ``sources`` (source, source_size).

    Sources by code point, null last, take the weights in turn and share the sum of
    all sizes. A target ends at ``max_copies`` times its source's size; the excess is
    shared again by weight until none is above. That fixed point is
    ``min(cap, level * weight)``; the level is found by taking sources in the order
    in which a rising level fills them. Works on one row per source, in range partitions,
    so sources may be as many as sites. Two sums and the level reach the driver.
    """
    named = _with_sums_before(sources, F.col("source").asc_nulls_last(), {"_turn": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_turn") % len(weights) + 1).cast("int"))
    cap = F.lit(float(max_copies)) * F.col("source_size")
    weighed = named.select("source", "source_size", weight.alias("_weight"), cap.alias("_cap"))
    fills_at = F.col("_cap") / F.col("_weight")
    # Sources that fill at the same level are one entry: the level is one number, whatever their order.
    groups = weighed.groupBy(fills_at.alias("_fills_at")).agg(
        F.sum("_cap").alias("_cap"), F.sum("_weight").alias("_weight"), F.sum("source_size").alias("_size")
    )
    whole = groups.agg(F.sum("_size").alias("size"), F.sum("_weight").alias("weight")).first()
    if whole["weight"] is None:
        return weighed.select("source", "source_size", F.col("_cap").alias("target"))
    filled = _with_sums_before(groups, F.col("_fills_at").asc(), {"_caps": F.col("_cap"), "_weights": F.col("_weight")})
    level = (F.lit(float(whole["size"])) - F.col("_caps")) / (F.lit(whole["weight"]) - F.col("_weights"))
    reached = filled.select("_fills_at", level.alias("_level")).where("_level <= _fills_at")
    level = reached.agg(F.min_by("_level", "_fills_at")).first()[0]
    return weighed.select("source", "source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("target"))


def _size_band(size: Column) -> Column:
    wide = FINE_SIZES + F.floor(BANDS_PER_OCTAVE * F.log2(size / F.lit(FINE_SIZES)))
    # Never null, so that the joins need no test of it, which would count the words again.
    return F.coalesce(F.when(size <= FINE_SIZES, size).otherwise(wide).cast("int"), F.lit(0))


def _unit_offset(source_key: Column, seed: int) -> Column:
    """In [0, 1), a multiple of 2^-20, so that adding it to a running sum is exact."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}"), source_key)), 1, 5)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 20))


def mix(
    docs: DataFrame,
    keep: list[str] | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs`` with its number of copies.

    Columns: ``doc`` (a struct of the columns named in ``keep``, all by default),
    ``size`` (words), ``source_size``, ``target`` (both of its source) and ``copies``.

    A null text has size 0. A null source is a source of its own, the last one. A null
    doc_id is an ordinary value. Repeated rows are rows of their own; ties in size are
    ordered by a hash of doc_id, then doc_id, then the text's hash. Reruns agree. An
    empty table gives no rows. Other columns may have any name.
    """
    payload = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = (
        docs.select(
            payload.alias("doc"),
            F.col("source"),
            word_count(text_of()).alias("size"),
            hashed.alias("_hash"),
            F.col("doc_id").alias("_id"),
            F.xxhash64("text").alias("_text_hash"),
        )
        .withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .withColumn("_band", _size_band(F.col("size")))
        .withColumn("_bucket", F.coalesce((F.conv(F.substring("_hash", 1, 7), 16, 10).cast("long") % buckets).cast("int"), F.lit(0)))
    )
    cell = ["_key", "_band", "_bucket"]
    # Three small tables follow from the cells: kept, so that texts are counted once for them.
    cells = checkpointed(
        rows.groupBy(*cell).agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_size"), F.first("source").alias("source")
        )
    )
    targets = source_targets(
        cells.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size")),
        weights,
        max_copies,
    ).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_key"), "source_size", "target"
    )
    # Rows before a cell: those of the source's smaller bands, and of the band's earlier buckets.
    rows_before = lambda window: F.coalesce(
        F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bands = (
        cells.groupBy("_key", "_band")
        .agg(F.sum("_rows").alias("_rows"))
        .select("_key", "_band", rows_before(Window.partitionBy("_key").orderBy("_band")).alias("_smaller"))
        .join(targets, "_key")
    )
    in_band = rows_before(Window.partitionBy("_key", "_band").orderBy("_bucket"))
    placed = (
        cells.select(*cell, in_band.alias("_earlier"))
        .join(bands, ["_key", "_band"])
        .select(*cell, (F.col("_smaller") + F.col("_earlier")).alias("_before"), "source_size", "target")
    )
    within = Window.partitionBy(*cell).orderBy("_hash", "_id", "_text_hash")
    rank = F.col("_before") + F.row_number().over(within)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit_offset(F.col("_key"), seed)
    crossed = F.floor(F.col("_rate") * F.col("_rank") + offset) - F.floor(
        F.col("_rate") * (F.col("_rank") - 1) + offset
    )
    return (
        rows.join(placed, cell)
        .withColumn("_rank", rank)
        .withColumn("_rate", rate)
        .select("doc", "size", "source_size", "target", F.least(crossed, F.lit(max_copies)).cast("int").alias("copies"))
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents as often as the mix takes them, in the columns of ``docs``."""
    taken = mix(docs, **settings).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")
