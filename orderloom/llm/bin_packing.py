"""Best-fit packing of token sequences by minimum bin slack.

A document's ids, ended by ``END_ID``, are cut into pieces of at most ``CAPACITY``
tokens; only a document longer than that is cut, and the shorter piece comes first.

Bins are planned on the number of pieces of each length, at most ``CAPACITY``
numbers whatever the data. For each bin the largest length left is set, then bitset
subset-sum dynamic programming over the available lengths finds the fullest feasible
combination for the rest. The combination is taken as often as the counts allow and
removed. Each piece finds its place by its rank among the pieces of its length, so
placing is one narrow shuffle. Ranks are counted per (length, hash bucket) first: a
length that most pieces have is spread over all its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed, small_batches, text_of
from orderloom.llm.tokens import VOCABULARY, token_ids

CAPACITY = 1024
END_ID = 2
LEAST_BUCKETS = 64
ROWS_PER_BUCKET = 100_000
DOCS_PER_BATCH = 1024

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def piece_bounds(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n_tokens`` tokens."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(first, n_tokens, capacity)] if n_tokens else []
    return [(start, min(capacity, n_tokens - start) if start else first) for start in starts]


def tokenized_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian uint32).

    A null or empty text is the single token ``end_id``. A null doc_id stays null;
    repeated rows give pieces each. An empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("piece", pa.int32()),
                ("start", pa.int64()),
                ("length", pa.int64()),
                ("ids", pa.binary()),
            ]
        )
        for whole in batches:
            for lo in range(0, whole.num_rows, DOCS_PER_BATCH):
                batch = whole.slice(lo, DOCS_PER_BATCH)
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = [*token_ids(text.as_py(), vocabulary), end_id]
                    packed = np.asarray(ids, dtype="<u4")
                    for piece, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                        rows.append((doc_id, piece, start, length, packed[start : start + length].tobytes()))
                columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
                )

    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(cut, PIECES)


@dataclass
class BinPlan:
    """Where pieces go, by position: all lengths in order, and ranks within a length.

    A run is a set of positions that one combination of lengths takes: ``per_bin``
    pieces of ``length`` in each of its bins, the first at ``offset``.
    """

    first: dict[int, int] = field(default_factory=dict)
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # position, per_bin, bin, offset, length
    bins: int = 0


def fullest(room: int, counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, times) of the combination of available lengths that fills most of ``room``.

    Bit i of the bitset says that some combination sums to i. Larger lengths are tried
    first, and the search ends at the first combination without slack.
    """
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left > 0:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            taken[length] = taken.get(length, 0) + times
    return sorted(taken.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> BinPlan:
    """Bins for ``histogram[length]`` pieces of each length."""
    plan, position = BinPlan(), 0
    for length in sorted(histogram):
        plan.first[length] = position
        position += histogram[length]
    counts, used = dict(histogram), dict.fromkeys(histogram, 0)
    while counts:
        largest = max(counts)
        rest = {**counts, largest: counts[largest] - 1}
        combination = dict(fullest(capacity - largest, rest))
        combination[largest] = combination.get(largest, 0) + 1
        times = min(counts[length] // n for length, n in combination.items())
        offset = 0
        for length, n in sorted(combination.items(), reverse=True):
            plan.runs.append((plan.first[length] + used[length], n, plan.bins, offset, length))
            offset += n * length
            used[length] += n * times
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        plan.bins += times
    plan.runs.sort()
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any others) with sequence_id and offset.

    The offsets of a sequence's pieces follow each other from 0 without gaps. Pieces
    are written to the checkpoint folder once, as both passes read them: pass narrow
    rows. Lengths must lie between 1 and ``capacity``.
    """
    with small_batches(pieces.sparkSession):
        pieces = checkpointed(pieces)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_bins(histogram, capacity)
    positions, per_bin, bins, offsets, lengths = (
        np.array(c, dtype=np.int64) for c in (zip(*plan.runs, strict=True) if plan.runs else [[0]] * 5)
    )
    buckets = max(LEAST_BUCKETS, -(-max(histogram.values(), default=0) // ROWS_PER_BUCKET))
    firsts = pieces.sparkSession.createDataFrame(sorted(plan.first.items()), "length bigint, _first bigint")

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(position: pd.Series) -> pd.DataFrame:
        at = position.to_numpy(dtype=np.int64)
        run = np.searchsorted(positions, at, side="right") - 1
        bin_of, turn = np.divmod(at - positions[run], per_bin[run])
        return pd.DataFrame({"sequence_id": bins[run] + bin_of, "offset": offsets[run] + turn * lengths[run]})

    # The partitions of the checkpoint are part of the hash: rows that repeat an id, or have
    # none, are spread over the buckets too.
    hashed = F.xxhash64("doc_id", "piece", "start", F.spark_partition_id())
    dealt = pieces.withColumn("_hash", hashed).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    cells = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.join(firsts, "length").select(
        "length", "_bucket", (F.col("_first") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_before")
    )
    within = Window.partitionBy("length", "_bucket").orderBy("_hash", "doc_id", "piece")
    position = F.col("_before") + F.row_number().over(within) - 1
    return (
        dealt.join(cells, ["length", "_bucket"])
        .withColumn("_position", position)
        .withColumn("_place", place("_position"))
        .select(*[F.col(f"`{c}`") for c in pieces.columns], "_place.sequence_id", "_place.offset")
    )


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ``ids`` from packed pieces that carry ``ids``."""
    piece = F.struct("offset", "ids")
    joined = F.aggregate(
        F.sort_array(F.collect_list(piece)), F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])
    )
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` with the checksum of their ids and their places."""
    pieces = tokenized_pieces(docs, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(pieces, capacity)
