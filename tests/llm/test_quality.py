"""The quality classifier and the quality rules, on held-out labels."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import quality_classifier, quality_rules, queries

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_classifier_on_held_out_rows(spark, labels):
    rows = queries.op2_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in held]) > 0.97
    assert np.mean([p for p, y in held if y == 1]) > 0.99
    assert np.mean([p for p, y in held if y == 0]) < 0.1


def test_non_negative_risk_separates_without_negatives():
    random = np.random.default_rng(0)
    width = quality_classifier.N_FEATURES
    rows = np.vstack([random.normal(1, 1, (1100, width)), random.normal(-1, 1, (300, width))])
    trusted = np.arange(len(rows)) < 400
    model = quality_classifier.train(lambda summand: summand(rows, trusted), 1100 / 1400)
    assert model.score(random.normal(1, 1, (300, width))).mean() > 0.8
    assert model.score(random.normal(-1, 1, (300, width))).mean() < 0.2


def test_classifier_edge_rows(spark, documents, with_clashes):
    docs = with_clashes(documents((None, None, None), (1, "", "s"), (2, "a b " * 60_000, "s"), (2, "a", "s"), (2, "a", "s")))
    labelled = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    for known in (labelled, labelled.where("false")):
        model = quality_classifier.fit(docs, known)
        rows = quality_classifier.scored(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
        assert quality_classifier.accepted(docs, model).columns == docs.columns
        assert quality_classifier.scored(docs.where("false"), model).count() == 0
    assert quality_classifier.scored(docs, quality_classifier.fit(docs.where("false"), labelled)).count() == 5


def test_all_documents_and_blocks_count_in_the_risk(spark, documents, monkeypatch):
    texts = ["Some good words in a line.", "x", "", "## || $$ junk", "More words, said well."] * 30
    docs = documents(*[(i, t, "s") for i, t in enumerate(texts)])
    known = spark.createDataFrame([(i, int(i % 5 in (0, 4))) for i in range(60)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality_classifier, "ROWS_PER_BLOCK", 7)
    learnt = [i for i in range(150) if zlib.crc32(str(i).encode()) % 5]
    trusted = np.array([i < 60 and i % 5 in (0, 4) for i in learnt])
    x = np.vstack([quality_classifier.features(texts[i]).astype(np.float32) for i in learnt]).astype(np.float64)
    blocks = quality_classifier._blocks(docs.where(~quality_classifier.held_out(docs["doc_id"])), known.where("quality = 1 AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 != 0"))
    weights = np.random.default_rng(1).normal(0, 0.3, quality_classifier.N_WEIGHTS)
    summand = quality_classifier.risk_sums(quality_classifier.Model(0.5, x.mean(0), x.std(0) + 1e-3, weights))
    assert np.allclose(quality_classifier._summed(blocks, summand), summand(x, trusted), atol=1e-6)
    assert quality_classifier._summed(blocks, quality_classifier.moments)[:2].tolist() == [len(learnt), trusted.sum()]


def test_reruns_with_repeated_ids_give_the_same_models(spark, documents):
    docs = documents(*[(i % 40, f"words {i % 7} of a text. " * (1 + i % 9), "s") for i in range(200)]).repartition(5)
    known = spark.createDataFrame([(i % 40, i % 3 % 2) for i in range(90)], "doc_id bigint, quality int")
    first, second = (quality_classifier.fit(docs, known.repartition(n)) for n in (2, 3))
    x = np.vstack([quality_classifier.features(f"words {i}. " * i) for i in range(5)])
    assert np.allclose(first.score(x), second.score(x), atol=1e-9)
    one, other = (quality_rules.fit(docs, known.repartition(n), max_rows=20) for n in (2, 3))
    assert (one.value == other.value).all() and (one.threshold == other.threshold).all()


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\t", "\x0b", "#", "|", "𝔘x", " ", "\x85", "a b a b"]), max_size=40).map("".join))
def test_statistics_equal_brute_force(text):
    s = quality_rules.statistics(text)
    assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute_counts(text)


def test_rules_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op10_quality_rules(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = brute_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *rest)
        assert r["base_failed"] == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_rules_on_held_out_rows(spark, labels):
    rows = queries.op10_quality_rules(spark, SF).collect()
    held = [(r["kept"], labels[r["doc_id"]]) for r in rows if not r["base_failed"] and r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([k == (y == 1) for k, y in held]) > 0.95
    assert np.mean([k for k, y in held if y == 1]) > 0.98


def test_forest_is_monotone_and_flat_arrays_score_like_a_walk():
    random = np.random.default_rng(3)
    x = random.uniform(0, 1, (3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + x[:, 1] + random.normal(0, 0.2, 3000)) < 1).astype(float)
    forest = quality_rules.boost(x, y, np.array([-1, 0, 1]))
    grid = np.linspace(0, 1, 60)
    for _ in range(40):
        others = random.uniform(0, 1, 2)
        falling = forest.score(np.column_stack([grid, np.full(60, others[0]), np.full(60, others[1])]))
        rising = forest.score(np.column_stack([np.full(60, others[0]), np.full(60, others[1]), grid]))
        assert (np.diff(falling) <= 1e-12).all() and (np.diff(rising) >= -1e-12).all()
    assert ((forest.score(x) > 0.5) == y).mean() > 0.8
    row, total = x[5], forest.start
    for at in forest.roots:
        while forest.left[at] != at:
            at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
        total += forest.value[at]
    assert forest.score(x[5:6])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_rules_edge_rows(spark, documents, with_clashes):
    docs = with_clashes(documents((None, None, None), (1, "", "s"), (2, "word " * 100_000, "s"), (2, "a", "s"), (2, "a", "s")))
    known = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    forest = quality_rules.fit(docs, known)
    rows = quality_rules.judged(docs, forest).collect()
    assert len(rows) == 5 and not any(r["kept"] for r in rows)
    assert quality_rules.judged(docs.where("false"), quality_rules.fit(docs, known.where("false"))).count() == 0
