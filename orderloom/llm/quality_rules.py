"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are trained by histogram boosting with the logistic loss. On chosen features
a split is allowed only if the verdict moves one way: a child on the worse side can
never score above its sibling, and both subtrees keep to the bound between them. A
trained model is flattened into node arrays (feature, threshold, left, right, value),
and a block of documents walks all trees level by level in numpy.

The model is fitted on the driver on at most ``MAX_ROWS`` labelled documents, those
with the smallest hashes of doc_id. Every document's statistics come from its whole text, in one pass
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import text_of
from orderloom.llm.quality_classifier import held_out

MAX_ROWS = 20_000
SEED = 13
TREES = 40
DEPTH = 4
BINS = 64
LEARNING_RATE = 0.2
LEAST_ROWS = 8
SMOOTHING = 1.0
THRESHOLD = 0.5
DOCS_PER_BATCH = 1024

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])

#: Features by name, with the sign that the verdict must follow: -1 falls, 1 rises, 0 is free.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "punctuation_share": 0,
    "exclamation_share": -1,
    "distinct_share": 0,
    "words_per_line": 0,
    "line_ends": 0,
    "longest_word": 0,
}


@dataclass
class Statistics:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: list[float]

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED_PERCENT * self.n_words


def _repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in windows that occur twice or more, and the number of different words."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) < WINDOW + 1:
        return 0, len(numbers)
    # Pairs are numbered first, so that a window of any vocabulary fits 64 bits.
    pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    repeated = times[which] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(repeated)] |= repeated
    return int(covered.sum()), len(numbers)


def statistics(text: str) -> Statistics:
    """Base counts and features of one text; an empty one has zeros."""
    raw = text.encode("utf-8")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, _WHITE_SPACE)))
    n_symbols = sum(raw.count(s) for s in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_dup_lines = len(lines) - len(set(lines))
    n_repeat, n_distinct = _repeated_words(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digits = int(counts[65:91].sum()), int(counts[48:58].sum())
    letters = upper + int(counts[97:123].sum())
    punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    per_word, per_char, per_line = max(n, 1), max(word_chars, 1), max(len(lines), 1)
    features = [
        np.log1p(n),
        word_chars / per_word,
        n_symbols / per_char,
        n_symbols / per_word,
        n_dup_lines / per_line,
        n_repeat / per_word,
        upper / max(letters, 1),
        digits / per_char,
        punctuation / per_char,
        int(counts[33]) / per_word,
        n_distinct / per_word,
        n / per_line,
        sum(line.rstrip()[-1:] in (b".", b"?", b"!", b":") for line in lines) / per_line,
        np.log1p(max(map(len, words), default=0)),
    ]
    return Statistics(n, word_chars, n_symbols, n_dup_lines, n_repeat, features)


@dataclass
class Forest:
    """Trees as flat node arrays; a leaf's children are the leaf itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(low, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-np.clip(self.start + self.value[at].sum(axis=1), -30, 30)))


class _Grower:
    """Grows trees on binned features into shared node lists."""

    def __init__(self, x: np.ndarray, monotone: np.ndarray):
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        self.binned = np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(self.cuts, x.T, strict=True)])
        self.monotone = monotone
        self.nodes: list[list[float]] = []  # feature, threshold, left, right, value

    def leaf(self, gradient: float, weight: float, low: float, high: float) -> float:
        return float(np.clip(-gradient / (weight + SMOOTHING), low, high))

    def split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """(gain, feature, bin) of the best allowed split, or None."""
        best = None
        total_g, total_h = g[rows].sum(), h[rows].sum()
        gain_of = lambda a, b: a * a / (b + SMOOTHING)
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins, size = self.binned[rows, f], len(cuts) + 1
            left_g = np.cumsum(np.bincount(bins, g[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(bins, h[rows], size))[:-1]
            left_n = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            gain = gain_of(left_g, left_h) + gain_of(total_g - left_g, total_h - left_h) - gain_of(total_g, total_h)
            allowed = (left_n >= LEAST_ROWS) & (len(rows) - left_n >= LEAST_ROWS)
            if self.monotone[f]:
                below = np.clip(-left_g / (left_h + SMOOTHING), low, high)
                above = np.clip(-(total_g - left_g) / (total_h - left_h + SMOOTHING), low, high)
                allowed &= self.monotone[f] * (above - below) >= 0
            gain = np.where(allowed, gain, -np.inf)
            b = int(np.argmax(gain))
            if gain[b] > 1e-6 and (best is None or gain[b] > best[0]):
                best = (gain[b], f, b)
        return best

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, out: np.ndarray, depth=0, low=-4.0, high=4.0) -> int:
        """Adds the subtree over ``rows`` and returns its node; ``out`` gets its values."""
        node = len(self.nodes)
        value = self.leaf(g[rows].sum(), h[rows].sum(), low, high)
        self.nodes.append([0, 0.0, node, node, value])
        found = self.split(rows, g, h, low, high) if depth < DEPTH else None
        if found is None:
            out[rows] = value
            return node
        _, f, b = found
        goes_left = self.binned[rows, f] <= b
        sides = [rows[goes_left], rows[~goes_left]]
        bounds = [(low, high), (low, high)]
        if self.monotone[f]:
            middle = np.mean([self.leaf(g[s].sum(), h[s].sum(), low, high) for s in sides])
            bounds = [(low, middle), (middle, high)] if self.monotone[f] > 0 else [(middle, high), (low, middle)]
        children = [self.grow(s, g, h, out, depth + 1, *limits) for s, limits in zip(sides, bounds, strict=True)]
        self.nodes[node] = [f, self.cuts[f][b], *children, value]
        return node


def boost(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = TREES) -> Forest:
    """A forest for labels 0 and 1. Without both labels it scores their share alone."""
    share = float(np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    grower, roots = _Grower(x if len(x) else np.zeros((1, len(monotone))), monotone), []
    margin = np.full(len(y), start)
    if len(np.unique(y)) == 2:
        for _ in range(trees):
            chance = 1 / (1 + np.exp(-margin))
            out = np.zeros(len(y))
            roots.append(grower.grow(np.arange(len(y)), chance - y, chance * (1 - chance), out))
            margin += LEARNING_RATE * out
    if not roots:
        roots, grower.nodes = [0], [[0, 0.0, 0, 0, 0.0]]
    feature, threshold, left, right, value = (np.array(c) for c in zip(*grower.nodes, strict=True))
    ints = [a.astype(np.int64) for a in (feature, left, right)]
    return Forest(ints[0], threshold, ints[1], ints[2], value * LEARNING_RATE, np.array(roots), start)


COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
COLUMNS = f"doc_id bigint, {COUNTS}, base_failed boolean, features array<double>"


def document_statistics(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed`` and ``features`` of each row of ``docs`` (doc_id, text).

    A null text has no words. Null ids and repeated rows give rows like any other; an
    empty table gives none. Other columns are not used.
    """
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("base_failed", pa.bool_()), ("features", pa.list_(pa.float64()))]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, DOCS_PER_BATCH):
                batch = whole.slice(lo, DOCS_PER_BATCH)
                found = [statistics(text.as_py()) for text in batch.column(1)]
                columns = [
                    batch.column(0),
                    *(
                        pa.array([getattr(s, name) for s in found], pa.int64())
                        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                    ),
                    pa.array([s.base_failed for s in found], pa.bool_()),
                    pa.array([s.features for s in found], pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(measure, COLUMNS)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Forest:
    """A forest for ``labels.quality`` from rows that aren't held out.

    Null labels and ids are left out. A document counts once, with the mean of its
    labels rounded up; of several texts under one id, that of the smallest hash counts.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    graded = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    # Ids are unique here, so the order and with it the choice is the same in every run.
    sample = F.broadcast(graded.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(max_rows))
    picked = docs.select("doc_id", "text").join(sample, "doc_id", "left_semi")
    one_each = picked.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = document_statistics(one_each).join(sample, "doc_id").select("doc_id", "features", "quality")
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    x = np.array([r["features"] for r in found], dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array([r["quality"] for r in found], dtype=np.float64)
    return boost(x, y, np.array(list(FEATURES.values())))


def judged(docs: DataFrame, forest: Forest) -> DataFrame:
    """``document_statistics`` with ``score`` and ``kept``.

    ``kept`` is false where a base rule fails, else whether the forest's score reaches
    the threshold.
    """

    @F.pandas_udf("double")
    def score(features):
        import pandas as pd

        if not len(features):
            return pd.Series([], dtype=np.float64)
        return pd.Series(forest.score(np.vstack(features.to_numpy())))

    return (
        document_statistics(docs)
        .withColumn("score", score("features"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD))
        .drop("features")
    )
