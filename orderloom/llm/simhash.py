"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are linked at ``BITS`` or fewer differing bits. A fingerprint
has two segments of 32 bits. If two differ in at most 2 bits, one of their segments
differs in at most one, so each fingerprint probes, per segment, its value and the
values one bit away, fetches the table's matches and verifies whole distances. Of a
pair one bit apart in a segment, the probe of the side where the bit is 0 is enough.

Equal fingerprints are one entry, so a group of exact copies costs one row. A segment
value shared by more than ``BUCKET`` different fingerprints (many near copies of one
text) is not joined, as that would pair them all. Its fingerprints take another exact
way: two fingerprints differ in at most two bits if and only if some value lies
within one bit of both, so every fingerprint is listed under the 65 values within one
bit, and those that share a value are linked to the smallest of them. At most 65
fingerprints can share one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed, small_batches, text_of
from orderloom.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 2
BUCKET = 64
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text.

    ASCII letters are lower-cased; ``bytes`` methods touch ASCII alone and split at
    exactly its white space.
    """
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in shingles), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), HASHES_AT_ONCE):
        block = hashes[lo : lo + HASHES_AT_ONCE]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprints as signed longs."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segments(fp: Column) -> list[Column]:
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return [low, F.shiftrightunsigned(fp, 32)]


def _ball(value: Column) -> Column:
    """``value`` and those that have one more of its 32 bits set."""
    flips = [F.when(value.bitwiseAND(F.lit(1 << i)) == 0, value.bitwiseOR(F.lit(1 << i))) for i in range(32)]
    return F.array_compact(F.array(value, *flips))


def _ones() -> list[Column]:
    return [F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)]


def _meeting(fps: DataFrame) -> DataFrame:
    """Links at two bits or fewer, as stars around each value within one bit."""
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(one) for one in _ones()])
    shared = fps.select("fp", F.explode(near).alias("value")).groupBy("value").agg(F.collect_list("fp").alias("fps"))
    stars = shared.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return stars.where("a != b")


def _neighbours(fps: DataFrame) -> DataFrame:
    """Links at one bit: the fingerprints that are another's with one bit set."""
    fp = F.col("fp")
    up = F.array_compact(F.array(*[F.when(fp.bitwiseAND(one) == 0, fp.bitwiseOR(one)) for one in _ones()]))
    pairs = fps.select(fp.alias("a"), F.explode(up).alias("fp")).join(fps, "fp")
    return pairs.select("a", fp.alias("b"))


def links(fps: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints of ``fps`` at ``bits`` or fewer.

    Column fp, without repeats. Every link is kept in effect: two linked fingerprints
    are a pair, or are joined by pairs. ``bits`` is 1 or 2.
    """
    if bits not in (1, 2):
        raise ValueError("crowded buckets are linked exactly at 1 or 2 bits")
    fp = F.col("fp")
    table = fps.select(
        "fp", F.posexplode(F.array(*_segments(fp))).alias("segment", "value")
    )
    probes = fps.select(
        "fp", F.posexplode(F.array(*[_ball(s) for s in _segments(fp)])).alias("segment", "_ball")
    ).select("fp", "segment", F.explode("_ball").alias("value"))
    crowded = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
    crowded = checkpointed(crowded.select("segment", "value"))
    keys = ["segment", "value"]
    found = (
        probes.join(crowded, keys, "left_anti")
        .withColumnRenamed("fp", "a")
        .join(table.join(crowded, keys, "left_anti").withColumnRenamed("fp", "b"), keys)
        .where((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= bits))
        .select("a", "b")
    )
    dense = probes.join(crowded, keys, "left_semi").select("fp").distinct()
    return found.union(_meeting(dense) if bits == 2 else _neighbours(dense)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(docs: DataFrame, shingle: int, bits: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp, text_hash), and (fp, component) with the smallest fp as its name."""
    with small_batches(docs.sparkSession):
        marked = checkpointed(
            docs.select("doc_id", fingerprints(text_of(), shingle).alias("fp"), F.xxhash64("text").alias("text_hash"))
        )
    fps = checkpointed(marked.select("fp").distinct())
    joined = components(links(fps, bits, bucket))
    labels = fps.join(joined, fps["fp"] == joined["node"], "left")
    return marked, labels.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long) and component_id.

    ``component_id`` is the smallest doc_id that links lead to, its own included. Texts
    without a word (null texts too) have fingerprint 0 and are linked like any other.
    Repeated rows stay and share a component. A null doc_id names a component only
    where no row of it has one. An empty table gives no rows. Only doc_id and text are
    used of ``docs``.
    """
    marked, labels = _labelled(docs, shingle, bits, bucket)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")).join(labels, "fp")
    names = least.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = labels.join(names, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` in its own columns with one row of each group, that of the smallest doc_id.

    A row without a doc_id stays only where its group has none; of several such rows,
    or of rows that repeat a doc_id, the one of the smallest text hash, once.
    """
    return first_of_groups(docs, *_labelled(docs, shingle, bits, BUCKET))


def first_of_groups(docs: DataFrame, marked: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``representatives`` by rows (doc_id, fp, text_hash) and (fp, component)."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "text_hash")
    per_fp = marked.groupBy("fp").agg(F.min(first).alias("first")).join(labels, "fp")
    chosen = per_fp.groupBy("component").agg(F.min("first").alias("first"))
    key = ["_no_id", "_id", "_text_hash"]
    kept = chosen.select(
        F.col("first.no_id").alias("_no_id"),
        F.coalesce("first.id", F.lit(0)).alias("_id"),
        F.col("first.text_hash").alias("_text_hash"),
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_text_hash"),
    )
    return rows.join(kept, key, "left_semi").dropDuplicates(key).select("_doc.*")


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
