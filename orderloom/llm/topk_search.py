"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has 64 bits, the signs of its projections on fixed random directions.
It is cut in segments about as wide as the logarithm of the number of codes, so that
a segment value is shared by few codes at any size. A step looks up, in one or all
segments, the values exactly r bits away from the query's. Once segments 0 to s of m have
been searched to radius r and the others to r - 1, a code that wasn't found differs in at
least r + 1 and r bits in them, so all codes within m r + s bits are known and verified. A
query is finished when its k-th best distance lies within that bound; the others go on
with the next segment or radius (Norouzi et al., 2012).

A query that holds k + 1 entries takes no candidate beyond the farthest of them, so what
verification lets through stays near the answer's own size. A code pair may match in
several segments. It is taken only in the segment where its distance is least (the first
of those), so no step finds it twice. Equal codes are one entry with their k + 1 smallest
ids, which is all that a result can need: a code shared by a third of all vectors costs
one row. An id that has several codes is an entry of its own at each of them, and a query
keeps the nearest of these. The best entries are kept by a ranked filter that prunes
before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations
from math import comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed

K = 10
SEED = 17
CODE_BITS = 64
#: Widths of segments, in bits, whatever the number of codes.
LEAST_WIDTH, MOST_WIDTH = 16, 32
#: More masks than this are made by steps, not listed in the plan.
MOST_LISTED = 20_000
#: A query's look-ups, and those of all queries, above which a step takes one segment.
PROBES_AT_ONCE = 4000
STEP_PROBES = 300_000
EVERY = 20


def directions(dimension: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, 64))


def codes(embedding: Column, seed: int = SEED) -> Column:
    """64-bit codes as signed longs; null for a null, empty or non-finite vector."""

    @F.pandas_udf("bigint")
    def of(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), dtype="Int64")
        sizes = vectors.map(lambda v: 0 if v is None else len(v))
        for size in sorted(set(sizes)):
            at = np.flatnonzero(sizes.to_numpy() == size)
            if not size or not len(at):
                continue
            block = np.array([list(v) for v in vectors.iloc[at]], dtype=np.float64)
            signs = block @ directions(size, seed) > 0
            values = np.packbits(signs, axis=1, bitorder="little").view("<i8")[:, 0]
            good = np.isfinite(block).all(axis=1)
            out.iloc[at[good]] = values[good]
        return out

    return of(embedding)


def segment_widths(n_codes: int) -> list[int]:
    """Widths of the segments for a table of so many codes: about log2 of it, 64 bits in all."""
    width = min(max(log2(max(n_codes, 1)), LEAST_WIDTH), MOST_WIDTH)
    m = max(round(CODE_BITS / width), 1)
    return [CODE_BITS // m + (s < CODE_BITS % m) for s in range(m)]


def _segment(code: Column, widths: list[int], number: int) -> Column:
    begin = [0, *accumulate(widths)][number]
    return F.shiftrightunsigned(code, begin).bitwiseAND(F.lit((1 << widths[number]) - 1))


def _balls(probes: DataFrame, radii: list[int], widths: list[int]) -> DataFrame:
    """``probes`` (.., width) with ``mask``: every value of so many bits with as many set as one of ``radii``."""
    parts = []
    for width in sorted(set(widths)):
        part = probes.where(F.col("width") == width) if len(set(widths)) > 1 else probes
        if sum(comb(width, r) for r in radii) <= MOST_LISTED:
            masks = (sum(1 << bit for bit in chosen) for r in radii for chosen in combinations(range(width), r))
            listed = F.expr(f"CAST(array({', '.join(map(str, masks))}) AS array<bigint>)")
            parts.append(part.withColumn("mask", F.explode(listed)))
        else:
            parts += [_stepped(part, radius, width) for radius in radii]
    return reduce(DataFrame.union, parts)


def _stepped(probes: DataFrame, radius: int, width: int) -> DataFrame:
    """``probes`` with every mask of ``radius`` bits, one bit after the other, rising."""
    at = probes.withColumns({"mask": F.lit(0).cast("bigint"), "next": F.lit(0)})
    for _ in range(radius):
        bits = F.when(F.col("next") < width, F.sequence(F.col("next"), F.lit(width - 1)))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
        at = at.withColumn("bit", F.explode(bits)).withColumns({"mask": F.col("mask").bitwiseOR(bit), "next": F.col("bit") + 1}).drop("bit")
    return at.drop("next")


def next_step(radius: int, segment: int, n_queries: int, widths: list[int]) -> tuple[list[int], list[int]]:
    """(radii, segments) to search next, from a position in the order of radius, then segment.

    All segments at once while a query's balls are small or its like are few; several
    radii at once while all that is few.
    """
    look_ups = lambda r: sum(comb(w, r) for w in widths)
    if segment or look_ups(radius) > PROBES_AT_ONCE and n_queries * look_ups(radius) > STEP_PROBES:
        return [radius], [segment]
    radii = [radius]
    while radii[-1] < max(widths) and n_queries * sum(map(look_ups, [*radii, radii[-1] + 1])) <= STEP_PROBES:
        radii.append(radii[-1] + 1)
    return radii, list(range(len(widths)))


def _found(queries: DataFrame, table: DataFrame, radii: list[int], segments: list[int], widths: list[int]) -> DataFrame:
    """(query, code, owner, distance, n_ids, least_id) of entries first found in this step.

    ``queries`` has code and bound, the distance up to which candidates matter.
    """
    values = [
        F.struct(F.lit(s).alias("segment"), F.lit(widths[s]).alias("width"), _segment(F.col("code"), widths, s).alias("value"))
        for s in segments
    ]
    own = F.explode(F.array(*values))
    probes = queries.select(F.col("code").alias("query"), "bound", own.alias("own")).select("query", "bound", "own.*")
    probes = _balls(probes, radii, widths).select(
        "query", "bound", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), F.bit_count("mask").alias("radius")
    )
    entries = table.select("*", own.alias("own")).select("code", "owner", "n_ids", "least_id", "own.segment", "own.value")
    apart = F.col("query").bitwiseXOR(F.col("code"))
    wanted = F.bit_count(apart) <= F.col("bound")
    for s in range(len(widths)):
        here = F.bit_count(_segment(apart, widths, s))
        wanted = wanted & F.when(F.col("segment") > s, here > F.col("radius")).otherwise(here >= F.col("radius"))
    # Merged, never broadcast: look-ups compress so well that their measured size misleads.
    return (
        probes.join(entries.hint("merge"), ["segment", "value"])
        .where(wanted)
        .select("query", "code", "owner", F.bit_count(apart).alias("distance"), "n_ids", "least_id")
    )


def _nearest(found: DataFrame, k: int, owners: bool) -> DataFrame:
    """The k + 1 nearest entries of each query; of an id with several codes its nearest one."""
    if owners:
        nearest = F.min(F.struct("distance", "code", "n_ids")).alias("nearest")
        owned = found.where("owner IS NOT NULL").groupBy("query", "owner").agg(nearest)
        owned = owned.select("query", "nearest.code", "owner", "nearest.distance", "nearest.n_ids", F.col("owner").alias("least_id"))
        found = found.where("owner IS NULL").union(owned)
    order = Window.partitionBy("query").orderBy("distance", "least_id")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """The ``k`` nearest vectors of each query by Hamming distance of codes, ties by id.

    Both tables have vec_id and embedding. Result: query_id, rank (from 1), neighbour_id,
    distance. A vector isn't its own neighbour: those of the query's id are left out.
    With fewer than ``k`` others a query has as many rows. Vectors without an id, null,
    empty or with a NaN are no neighbours and have no result. An id with several vectors
    is one neighbour and one query; the least distance between any two of the codes
    counts. Other columns are not used.
    """
    marked = checkpointed(vectors.select("vec_id", codes(F.col("embedding"), seed).alias("code")).dropna().distinct())
    asked = checkpointed(queries.select("vec_id", codes(F.col("embedding"), seed).alias("code")).dropna().distinct())
    several = checkpointed(marked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    owners = not several.isEmpty()
    least = Window.partitionBy("code").orderBy("vec_id")
    members = marked.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k + 1).drop("_n")
    if owners:
        members = checkpointed(members.join(several.withColumn("_several", F.lit(True)), "vec_id", "left"))
    else:
        members = members.withColumn("_several", F.lit(None).cast("boolean"))
    table = checkpointed(
        members.where("_several IS NULL").groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = table.select("code", F.lit(None).cast("bigint").alias("owner"), F.size("ids").alias("n_ids"), F.col("ids")[0].alias("least_id"))
    if owners:
        alone = members.where("_several")
        entries = entries.union(alone.select("code", F.col("vec_id").alias("owner"), F.lit(1).alias("n_ids"), F.col("vec_id").alias("least_id")))
    widths = segment_widths(table.count())
    active = asked.select("code").distinct().withColumn("bound", F.lit(CODE_BITS))
    near: DataFrame | None = None
    radius, segment, n_active = 0, 0, active.count()
    while n_active and radius <= max(widths):
        radii, segments = next_step(radius, segment, n_active, widths)
        found = _found(active, entries, radii, segments, widths)
        near = checkpointed(_nearest(found if near is None else near.union(found), k, owners))
        known = len(widths) * radii[-1] + segments[-1]
        so_far = near.groupBy(F.col("query").alias("code")).agg(
            F.sum(F.when(F.col("distance") <= known, F.col("n_ids"))).alias("n_known"),
            F.when(F.count(F.lit(1)) > k, F.max("distance")).alias("least_bound"),
        )
        active = checkpointed(
            active.join(so_far, "code", "left")
            .where(F.coalesce("n_known", F.lit(0)) <= k)
            .select("code", F.coalesce("least_bound", "bound").alias("bound"))
        )
        radius, segment = divmod(known + 1, len(widths))
        n_active = active.count()
    if near is None:
        near = _found(active, entries, [0], [0], widths)
    by_query = asked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")).join(near, "query")
    shared = by_query.where("owner IS NULL").join(table, "code").select("query_id", "distance", F.explode("ids").alias("neighbour_id"))
    found = shared.union(by_query.where("owner IS NOT NULL").select("query_id", "distance", "owner")) if owners else shared
    nearest = found.where("query_id != neighbour_id").groupBy("query_id", "neighbour_id").agg(F.min("distance").alias("distance"))
    rank = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return (
        nearest.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "neighbour_id", "distance")
    )


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """The stated query set: rows whose id is divisible by 20."""
    return vectors.where(F.col("vec_id") % EVERY == 0)
