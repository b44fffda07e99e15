"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1; all other text is unlabelled, labels 0
are not used as negatives. With a class prior p, the risk

    p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)])

is unbiased where the maximum doesn't act and never negative (Kiryo et al., 2017). It
is minimised with the logistic loss, so the score estimates the chance of label 1. The
prior is estimated as the share of 1 among the labelled rows of the training fold.

The model is logistic in shares of character classes and word statistics and in fixed
random combinations of them. With the second part weighed by a factor of at most 1 the
risk is convex, so a few Newton steps minimise it. The factor is 1 where the part is not
below zero; wherever a step has taken it there, the factor shrinks, until the maximum
acts no more or the part no longer pays. Features of all documents outside the held out fold are
measured once and stored, some 180 bytes a document; every step is one pass
over them that sums losses, slopes and curvature in Spark, over all trusted positives and
all documents. Only the sums, a few thousand numbers, reach the driver. They are added as
decimals, so their order doesn't matter. Every document is scored, on its whole text, in
one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import small_batches, stored, text_of

FOLDS = 5
THRESHOLD = 0.3
COMBINATIONS = 24
PASSES = 8
DECAY = 1e-2
#: What the negative part's factor is multiplied by where the part is below zero, and elsewhere up to 1.
SHRINK, GROW = 0.7, 1.1
SEED = 11
ROWS_PER_BLOCK = 2048

_LETTER = bytes(
    ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c
    for c in range(256)
)
#: Classes whose shares are features: letters by case, digits, white space, each ASCII punctuation mark.
_CLASSES = np.array([ord(c) for c in "Aa0 \n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"])


def features(text: str) -> np.ndarray:
    """Features of one text; an empty text has zeros alone."""
    raw = text.encode("utf-8")
    shape = raw.translate(_LETTER)
    shares = np.bincount(np.frombuffer(shape, np.uint8), minlength=256)[_CLASSES] / max(len(raw), 1)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n = max(len(words), 1)
    words_and_lines = (
        np.log1p(len(words)) / 10,
        len(shape.replace(b" ", b"")) / n / 20,
        len(set(words)) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.isalnum, words)) / n,
        min(n / max(len(lines), 1), 200) / 200,
    )
    return np.concatenate([np.sqrt(shares), words_and_lines])


N_FEATURES = len(_CLASSES) + 7


_random = np.random.default_rng(SEED)
_DIRECTIONS = _random.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, COMBINATIONS))
_SHIFTS = _random.normal(0, 1, COMBINATIONS)
N_WEIGHTS = 1 + N_FEATURES + COMBINATIONS


@dataclass
class Model:
    prior: float
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), z, np.tanh(z @ _DIRECTIONS + _SHIFTS)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _chance(self.inputs(x) @ self.weights)


def _chance(out: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


#: Sums over a block of rows: their features, and which of them are trusted positives.
Summand = Callable[[np.ndarray, np.ndarray], np.ndarray]


def moments(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Rows, trusted rows, and sums of the features and their squares."""
    return np.concatenate([[len(x), trusted.sum()], x.sum(0), (x * x).sum(0)])


def risk_sums(model: Model) -> Summand:
    """Losses against label 0, slopes and curvature of these, each of all rows and of the
    trusted ones, and the inputs of trusted rows."""

    def of(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        inputs = model.inputs(x)
        out = inputs @ model.weights
        loss, chance = np.logaddexp(0, out), _chance(out)
        spread = inputs * (chance * (1 - chance))[:, None]
        parts = [inputs[trusted].sum(0)]
        for rows in (slice(None), trusted):
            parts += [[loss[rows].sum()], chance[rows] @ inputs[rows], (spread[rows].T @ inputs[rows]).ravel()]
        return np.concatenate(parts)

    return of


def train(summed: Callable[[Summand], np.ndarray], prior: float) -> Model:
    """Minimise the non-negative risk over ``summed`` rows in ``PASSES`` Newton steps.

    Without positives or rows the model scores every text by the prior.
    """
    n, n_trusted, *sums = summed(moments)
    start = np.zeros(N_WEIGHTS)
    start[0] = np.log((prior + 1e-6) / (1 - prior + 1e-6))
    if not n or not n_trusted:
        return Model(prior, np.zeros(N_FEATURES), np.ones(N_FEATURES), start)
    mean = np.array(sums[:N_FEATURES]) / n
    scale = np.sqrt(np.maximum(np.array(sums[N_FEATURES:]) / n - mean**2, 0)) + 1e-3
    model, factor = Model(prior, mean, scale, start), 1.0
    decay = np.full(N_WEIGHTS, DECAY)
    decay[0] = 0
    sizes = [N_WEIGHTS, *2 * [1, N_WEIGHTS, N_WEIGHTS**2]]
    for _ in range(PASSES):
        inputs, *found = np.split(summed(risk_sums(model)), np.cumsum(sizes)[:-1])
        (loss, slope, bend), (p_loss, p_slope, p_bend) = [f / n for f in found[:3]], [f / n_trusted for f in found[3:]]
        below = loss[0] - prior * p_loss[0] < 0
        factor = factor * SHRINK if below else min(1.0, factor * GROW)
        # prior * E_P[loss(+)] + factor * (E_U[loss(-)] - prior * E_P[loss(-)])
        gradient = prior * (p_slope - inputs / n_trusted) + factor * (slope - prior * p_slope) + decay * model.weights
        curvature = prior * (1 - factor) * p_bend + factor * bend
        whole = curvature.reshape(N_WEIGHTS, N_WEIGHTS) + np.diag(decay + 1e-6)
        model = Model(prior, mean, scale, model.weights - np.linalg.solve(whole, gradient))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, divisible by ``FOLDS``. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _blocks(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Features of ``docs`` with a mark for those whose id is in ``trusted``, a row each.

    One Python node, so that a task needs one worker.
    """

    @F.pandas_udf("binary")
    def measure(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: features(text).astype(np.float32).tobytes())

    measured = docs.select("doc_id", measure(text_of()).alias("x"))
    marked = measured.join(trusted.select("doc_id", F.lit(True).alias("trusted")), "doc_id", "left")
    rows = marked.sortWithinPartitions("doc_id", "x").select("x", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    with small_batches(docs.sparkSession):
        return stored(rows)


def _summed(rows: DataFrame, summand: Summand) -> np.ndarray:
    """``summand`` added over all ``rows`` in blocks; zeros without any."""
    size = len(summand(np.zeros((0, N_FEATURES)), np.zeros(0, dtype=bool)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = batch.slice(lo, ROWS_PER_BLOCK)
                x = np.frombuffer(b"".join(part.column(0).to_pylist()), np.float32).reshape(-1, N_FEATURES)
                total += summand(x.astype(np.float64), np.array(part.column(1).to_pylist(), dtype=bool))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["i", "value"])

    parts = rows.mapInArrow(add, "i int, value double")
    found = parts.groupBy("i").agg(F.sum(F.col("value").cast("decimal(38, 12)")).cast("double").alias("value")).collect()
    total = np.zeros(size)
    for row in found:
        total[row["i"]] = row["value"]
    return total


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model for ``labels.quality``, learnt from rows that aren't held out.

    All documents are unlabelled text, those without a label or an id too; the trusted
    ones are those with a label 1. Null labels are left out; repeated labels count each
    in the prior, and once as a mark. Repeated documents count each. Without positives
    or text the model scores every text by the prior, 0.5 without labels.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select(
        "doc_id", (F.col("quality") == 1).alias("good")
    )
    found = known.agg(F.count("good").alias("n"), F.sum(F.col("good").cast("bigint")).alias("good")).first()
    prior = (found["good"] or 0) / found["n"] if found["n"] else 0.5
    rows = _blocks(docs.where(~held_out(F.col("doc_id"))), known.where("good").select("doc_id").distinct())
    return train(lambda summand: _summed(rows, summand), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as a struct ``doc``, with ``score`` and ``predicted``.

    A null text is an empty one and has a score too. Each row is handled by itself:
    null ids, repeated rows and other columns of any name pass through.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=np.float64)
        return pd.Series(model.score(np.vstack([features(t) for t in texts])))

    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), score(text_of()).alias("score")
    )
    return marked.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents predicted 1, in the columns of ``docs``."""
    return scored(docs, model).where("predicted = 1").select("doc.*")
