import random

import pytest
from pyspark.sql import functions as F

from orderloom.llm import queries, token_counts
from orderloom.llm.tokens import encoding

ALPHABET = " ab'rells  \n\t.,!?é中1 2 <|>A"


def edited(text, edits):
    for start, deleted, inserted in edits:
        at = min(max(start, 0), len(text))
        text = text[:at] + inserted + text[at + max(deleted, 0) :]
    return text


@pytest.mark.parametrize("seed", range(40))
def test_edits_leave_the_tree_of_the_edited_text(seed):
    rng = random.Random(seed)
    for length in (0, 1, 5, 80, 80, 2500):
        text = "".join(rng.choices(ALPHABET, k=length))
        tree = token_counts.TokenTree(text)
        for _ in range(8):
            edit = (rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 3, 60]), "".join(rng.choices(ALPHABET, k=rng.choice([0, 0, 1, 5, 300]))))
            tree.edit(*edit)
            text = edited(text, [edit])
            assert tree.text() == text and tree.chars == len(text)
            fresh = token_counts.TokenTree(text)
            assert [p for b in tree.buckets for p in b] == [p for b in fresh.buckets for p in b]
            assert (tree.tokens, tree.size) == (len(encoding().encode_ordinary(text)), fresh.size)
            at = rng.randint(0, len(text))
            assert tree.tokens_before(at) == fresh.tokens_before(at)


def test_only_the_region_of_an_edit_is_encoded():
    tree = token_counts.TokenTree("some words in a row " * 20_000)
    tree.edit(200_000, 4, "thing")
    assert tree.encoded_chars < 60


def test_query_equals_counts_from_scratch(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("text", F.coalesce("text", F.lit("")))
    place = [F.pmod(F.xxhash64(F.lit(n), "doc_id"), F.length("text") + 1).alias(f"p{n}") for n in (1, 2, 3)]
    got = {r["doc_id"]: r for r in queries.op5_token_counts(spark, sf).collect()}
    for r in docs.select("doc_id", "text", *place).collect():
        edits = [(r["p1"], 0, " An added sentence."), (r["p2"], 8, ""), (r["p3"], 40, r["text"][:25])]
        after = edited(r["text"], edits)
        assert got[r["doc_id"]]["tokens_before"] == len(encoding().encode_ordinary(r["text"]))
        assert got[r["doc_id"]]["tokens_after"] == len(encoding().encode_ordinary(after))
        assert got[r["doc_id"]]["chars_after"] == len(after)


def test_edge_rows(spark):
    schema = "doc_id bigint, text string, edits array<struct<start:bigint,deleted:bigint,inserted:string>>, fp string"
    rows = [(None, None, None, "x"), (1, "", [(0, 0, "ab cd")], "x"), (1, "", [(0, 0, "ab cd")], "x"), (2, "a b", [None, (None, None, None), (99, 99, "!")], "x"), (3, "w " * 100_000, [(5, 10**12, "")], "x")]
    got = token_counts.count_after_edits(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r["chars_after"] for r in got) == [0, 4, 5, 5, 5]
    assert token_counts.count_after_edits(spark.createDataFrame([], schema)).count() == 0


def test_stored_trees_are_taken_up_again(spark, tmp_path):
    rows = [(1, "some words in a row " * 5000), (2, ""), (3, None), (None, "it's  a\n\n b"), (3, "é中 " * 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    token_counts.token_trees(docs).write.parquet(str(tmp_path / "first"))
    edits = "array(named_struct('start', 7L, 'deleted', 2L, 'inserted', ' thing'), NULL, named_struct('start', 0L, 'deleted', 0L, 'inserted', 'x '))"
    first = spark.read.parquet(str(tmp_path / "first"))
    token_counts.edit_trees(first.withColumn("edits", F.expr(edits))).write.parquet(str(tmp_path / "second"))
    second = spark.read.parquet(str(tmp_path / "second"))
    want = sorted(edited(edited(t or "", [(7, 2, " thing")]), [(0, 0, "x ")]) for _, t in rows)
    assert sorted(r["text"] for r in second.collect()) == want
    for r in second.collect():
        fresh = token_counts.TokenTree(r["text"])
        assert (r["n_tokens"], (bytes(r["lengths"]), bytes(r["counts"]))) == (fresh.tokens, fresh.stored())
        assert r["encoded_chars"] < 200
    assert token_counts.token_trees(docs.where("false")).count() == 0


def test_a_stored_tree_of_another_text_fails():
    lengths, counts = token_counts.TokenTree("a b c").stored()
    assert token_counts.TokenTree("a b c", lengths=lengths, counts=counts).tokens == 3
    with pytest.raises(ValueError):
        token_counts.TokenTree("a b", lengths=lengths, counts=counts)


def test_long_white_space():
    for text in ("a" + " " * 1_000_000 + "b", "\n" * 1_000_000, " " * 50_000 + "<|endoftext|>x"):
        tree = token_counts.TokenTree(text)
        tree.edit(10, 2, "word")
        assert tree.tokens == token_counts.TokenTree(tree.text()).tokens
