import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from orderloom.llm import components, queries, simhash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    """{key: smallest key reachable} for {key: fingerprint}."""
    keys, parent = list(marks), {k: k for k in marks}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(marks[a] ^ marks[b]).count("1") <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


@pytest.mark.parametrize("text", ["", " \n\t", "One", "one two", "A b C d É Ü", "x\x0by\x0cz\x1fw v\x85u", "a " * 500, "the same the same the same the same"])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def _signed(values):
    return [v - (1 << 64) if v >> 63 else v for v in values]


@pytest.mark.parametrize("bucket", [0, 3, 64])
@pytest.mark.parametrize("bits", [1, 2])
def test_links_connect_what_is_near(spark, bucket, bits):
    rng = random.Random(bucket + 7)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    marks = {rng.choice(seeds) ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 5))}) for _ in range(150)} | {0, (1 << 64) - 1, 1 << 63}
    fps = spark.createDataFrame([(v,) for v in _signed(marks)], "fp bigint")
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(fps, bits, bucket).collect()]
    parent = {m: m for m in marks}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in pairs:
        assert bin(a ^ b).count("1") <= bits
        parent[root(a)] = root(b)
    for a in marks:
        for b in marks:
            if bin(a ^ b).count("1") <= bits:
                assert root(a) == root(b)


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(900 + i, 900 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {i: 900 for i in range(900, 909)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_edge_rows_and_representatives(spark, documents, with_clashes):
    words = "one two three four five six seven eight nine ten"
    docs = with_clashes(
        documents((5, words, "a"), (3, words.upper(), "b"), (3, words.upper(), "b"), (None, words, "c"), (9, None, "d"), (8, "", "e"), (None, "alone in here", "f"), (None, "alone in here", "f"))
    )
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (-1, -1), (-1, 3), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8)]
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["source"]) for r in kept.collect()) == [(-1, "f"), (3, "b"), (8, "e")]
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.representatives(docs.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    marks = {r["doc_id"]: brute_fingerprint(r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = brute_components(marks)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, sf).collect()}
    assert got == {i: (f"{marks[i]:016x}", want[i]) for i in marks}


def test_hex_of_signed_values(spark):
    row = spark.sql("SELECT CAST(-1 AS BIGINT) AS a, 255L AS b, 0L AS c").select(*[simhash.fingerprint_text(F.col(c)) for c in "abc"]).first()
    assert list(row) == ["f" * 16, "0" * 14 + "ff", "0" * 16]
