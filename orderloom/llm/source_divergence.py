"""Source divergence audit: how far the term rates of a language's sources lie apart.

Terms are runs of ASCII letters and other non-ASCII characters. A language keeps the
terms that enough of its documents hold; each source gives each kept term a smoothed
rate p in billionths, a whole number. Two sources differ by the sum of ``abs(p - q)``.

Rates depend on a term's count alone, so the sum needs no more than the joint table of
two sources' count levels: how many terms have level a in one and b in the other. Kept
terms are dealt into blocks. In a block, every (source, level) is an indicator column
over the terms, level 0 included. The product of those columns with their transpose
holds every joint table; it is exact, as its entries count at most a block's terms. Each
cell is priced by the two levels' rates and the prices are summed per pair of sources.
Sources are cut into tiles, so a task multiplies one block of one pair of tiles,
whatever the number of sources and terms.

Documents are counted in tasks before the shuffle: a source or term that holds a third
of all text is one row per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed, text_of

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
BLOCK_TERMS = 512
TILE = 32
COLUMNS_AT_ONCE = 256
HELD_AT_MOST = 400_000

#: Bytes of terms, ASCII letters lower-cased; all others part terms.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0x20 for c in range(256)
)
_COUNTS = [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term.

    A group's row with the empty term, of no occurrences, says that the group is there.
    """
    schema = pa.schema(_COUNTS)

    def emitted(found: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, held) in found.items():
            terms = [b"", *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(held.__getitem__, n)], pa.int64()),
                ],
                schema=schema,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), strict=True):
                n, with_term = found.setdefault((lang, source), (Counter(), Counter()))
                terms = text.as_py().translate(_TERM_BYTES).split()
                held -= len(n)
                n.update(terms)
                with_term.update(set(terms))
                held += len(n)
                if held > HELD_AT_MOST:
                    yield from emitted(found)
                    found, held = {}, 0
        yield from emitted(found)

    named = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of().cast("binary").alias("text"))
    counted = named.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rate(count: Column | str, total: str, n_terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * n_terms)), in whole numbers; null without terms."""
    return F.expr(
        f"CAST(1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {SMOOTHING} AS DECIMAL(20, 0))) "
        f"DIV NULLIF(CAST({total} + {SMOOTHING} * {n_terms} AS DECIMAL(20, 0)), 0) AS BIGINT)"
    )


def _indicators(cells: pd.DataFrame, n_terms: int, zero_rates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, rate per column, source per column): terms by (source, level), ordered by source.

    ``cells`` has at, the term's row, source from 0 and rate. A term without a cell of
    a source has the source's level 0, the source's first column.
    """
    n_sources = len(zero_rates)
    keys = np.stack([cells["source"].to_numpy(np.int64), cells["rate"].to_numpy(np.int64)], axis=1).reshape(-1, 2)
    levels, which = np.unique(keys, axis=0, return_inverse=True)
    source = np.concatenate([np.arange(n_sources), levels[:, 0]])
    rates = np.concatenate([zero_rates, levels[:, 1]])
    order = np.argsort(source, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    matrix = np.zeros((n_terms, len(order)), dtype=np.float32)
    matrix[:, place[:n_sources]] = 1
    rows = cells["at"].to_numpy(np.int64)
    matrix[rows, place[keys[:, 0]]] = 0
    matrix[rows, place[n_sources + which.reshape(-1)]] = 1
    return matrix, rates[order], source[order]


def priced_product(one: tuple, other: tuple, n_one: int, n_other: int) -> np.ndarray:
    """Sum of ``abs(p - q)`` per pair of sources, from the joint tables of their levels."""
    (x, p, g), (y, q, h) = one, other
    total = np.zeros((n_one, n_other), dtype=np.int64)
    begins = np.searchsorted(h, np.arange(n_other))
    for lo in range(0, len(p), COLUMNS_AT_ONCE):
        block = slice(lo, lo + COLUMNS_AT_ONCE)
        joint = (x[:, block].T @ y).astype(np.int64)
        prices = joint * np.abs(p[block, None] - q[None, :])
        np.add.at(total, g[block], np.add.reduceat(prices, begins, axis=1))
    return total


def _price_block(block: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of a pair of tiles over one block of terms, for both orders of each pair."""
    lang, first, second = block["lang"].iloc[0], block["one"].iloc[0], block["other"].iloc[0]
    given = block["term"].isna()
    groups = block[given].drop_duplicates("number").sort_values("number")
    cells = block[~given]
    terms, rows = np.unique(cells["term"].to_numpy(dtype=object).astype(str), return_inverse=True)
    cells = cells.assign(at=rows)
    sides = []
    for tile in (first, second):
        members = groups[groups["number"] // TILE == tile]
        own = cells[cells["number"] // TILE == tile]
        own = own.assign(source=np.searchsorted(members["number"].to_numpy(), own["number"].to_numpy()))
        zero = members["rate"].to_numpy(dtype=np.int64)
        sides.append((members["source"].to_numpy(), zero, _indicators(own, len(terms), zero)))
        if first == second:
            sides *= 2
            break
    (names, zero, x), (others, other_zero, y) = sides
    value = priced_product(x, y, len(names), len(others))
    unseen = int(groups["n_terms"].iloc[0]) - len(terms)
    value += unseen * np.abs(zero[:, None] - other_zero[None, :])
    i, j = (a.reshape(-1) for a in np.indices(value.shape))
    if first == second:
        i, j = i[i != j], j[i != j]
    found = pd.DataFrame({"lang": lang, "source": names[i], "item": others[j], "value": value[i, j]})
    if first == second:
        return found
    return pd.concat([found, found.rename(columns={"source": "item", "item": "source"})[["lang", "source", "item", "value"]]])


def divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """The audit of ``docs``: lang, source, part, item, value and rank.

    Part ``pair`` has every other source of the language, its value the sum of
    ``abs(p - q)`` over the language's kept terms, 0 without any. Part ``term`` has the
    ``top_terms`` kept terms that the source uses more than its language does, by
    ``p - q``. Ranks go from 1, by value from the largest, then item.

    Null text, lang and source are empty strings. Rows count as documents, repeated rows
    and null ids too. A language of one source has no pairs. A source without terms
    counts 0 for all. An empty table gives no rows. Other columns are not used.
    """
    counts = checkpointed(term_counts(docs))
    kept = checkpointed(
        counts.where("term != ''")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"), F.sum("lang_n").alias("lang_total"))
    sized = kept.join(langs, "lang").withColumn(
        "block", F.pmod(F.xxhash64("term"), F.ceil(F.col("n_kept") / F.lit(block_terms)))
    )
    cells = checkpointed(counts.where("n > 0").drop("docs").join(sized, ["lang", "term"]))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = checkpointed(
        counts.where("term = ''")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs.select("lang", "n_kept"), "lang", "left")
        .fillna(0, ["total", "n_kept"])
        .withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("zero_rate", F.coalesce(rate("0", "total", "n_kept"), F.lit(0).cast("bigint")))
    )
    rated = cells.join(groups.select("lang", "source", "number", "total"), ["lang", "source"]).withColumn(
        "rate", rate("n", "total", "n_kept")
    )

    # Each block of terms meets each pair of tiles; a group is in as many pairs as there are tiles.
    blocks = sized.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("n_terms"))
    tiles = groups.groupBy("lang").agg(F.floor(F.max("number") / F.lit(TILE)).alias("last_tile"))
    own = F.floor(F.col("number") / F.lit(TILE))
    pairs = F.explode(
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("last_tile")),
            lambda t: F.struct(F.least(t, own).alias("one"), F.greatest(t, own).alias("other")),
        )
    )
    fields = ["lang", "block", "source", "number", "term", "rate", "n_terms"]
    there = groups.join(blocks, "lang", "left").select(
        "lang", F.coalesce("block", F.lit(0).cast("bigint")).alias("block"), "source", "number",
        F.lit(None).cast("string").alias("term"), F.col("zero_rate").alias("rate"),
        F.coalesce("n_terms", F.lit(0).cast("bigint")).alias("n_terms"),
    )
    levels = rated.select("lang", "block", "source", "number", "term", "rate", F.lit(None).cast("bigint").alias("n_terms"))
    laid = there.union(levels).join(tiles, "lang").select(*fields, pairs.alias("pair")).select(*fields, "pair.*")
    pair_values = (
        laid.groupBy("lang", "block", "one", "other")
        .applyInPandas(_price_block, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    term_values = (
        rated.withColumn("lang_rate", rate("lang_n", "lang_total", "n_kept"))
        .where("rate > lang_rate")
        .select("lang", "source", F.col("term").alias("item"), (F.col("rate") - F.col("lang_rate")).alias("value"))
    )
    ranking = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(pair_values.withColumn("rank", ranking), "pair").union(
        named(term_values.withColumn("rank", ranking).where(F.col("rank") <= top_terms), "term")
    )
