import numpy as np
import pytest

from orderloom.llm import queries, topk_search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, asked, k):
    """{query: [(distance, id)]} from (id, vector) rows, all pairs."""
    ids = np.array([i for i, _ in rows])
    block = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    codes = np.packbits(block @ topk_search.directions(block.shape[1]) > 0, axis=1, bitorder="little").view("<u8")[:, 0]
    out = {}
    for q in asked:
        least = {}
        for own in codes[ids == q]:
            for d, i in zip(np.bitwise_count(codes ^ own).astype(int), ids, strict=True):
                least[int(i)] = min(int(d), least.get(int(i), 64))
        out[q] = sorted((d, i) for i, d in least.items() if i != q)[:k]
    return out


def _search(spark, rows, asked, k):
    vectors = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], SCHEMA)
    got = {}
    for r in topk_search.top_k(vectors, vectors.where(vectors.vec_id.isin(asked)), k).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["neighbour_id"])
    return {q: [found[n] for n in sorted(found)] for q, found in got.items()}


def test_equals_brute_force_with_ties_and_a_hot_code(spark):
    random = np.random.default_rng(2)
    centres = random.normal(0, 1, (5, 16))
    rows = [(i, centres[i % 5] + random.normal(0, 0.15, 16)) for i in range(300)]
    rows += [(1000 + i, np.ones(16)) for i in range(120)]
    asked = [0, 20, 41, 299, 1000, 1060, 1119]
    assert _search(spark, rows, asked, 7) == brute(rows, asked, 7)


def test_fewer_vectors_than_asked_for(spark):
    rows = [(1, np.ones(4)), (2, -np.ones(4)), (3, np.ones(4))]
    got = _search(spark, rows, [1, 2], 10)
    assert got[1] == [(0, 3), (64, 2)] and [d for d, _ in got[2]] == [64, 64]


def test_edge_rows(spark):
    rows = [(None, [1.0, 2.0], 0), (1, None, 0), (2, [], 0), (3, [float("nan"), 1.0], 0), (4, [1.0, None], 0), (5, [1.0, 1.0], 0), (5, [1.0, 1.0], 0), (6, [1.0, 1.1], 0)]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS query", "3 AS value")
    got = [tuple(r) for r in topk_search.top_k(vectors, vectors, 3).collect()]
    assert sorted(got)[0][:3] == (5, 1, 6) and len(got) == 2
    assert topk_search.top_k(vectors.where("false"), vectors, 3).count() == 0
    assert topk_search.top_k(vectors, vectors.where("false"), 3).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    asked = [i for i, _ in rows if i % 20 == 0]
    got = {}
    for r in queries.op9_topk_search(spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["neighbour_id"]))
    assert {q: sorted(v) for q, v in got.items()} == brute(rows, asked, topk_search.K)


@pytest.mark.parametrize("widths", [[16] * 4, [22, 21, 21], [8] * 8, [32, 32]])
def test_steps_go_through_all_radii_and_segments(widths):
    m, most = len(widths), max(widths)
    for n in (1, 400, 10**9):
        at, seen = (0, 0), []
        while at[0] <= most:
            radii, segments = topk_search.next_step(*at, n, widths)
            seen += [(r, s) for r in radii for s in segments]
            at = divmod(m * radii[-1] + segments[-1] + 1, m)
        assert seen == [(r, s) for r in range(most + 1) for s in range(m)]
    assert topk_search.next_step(6, 1, 10**8, widths) == ([6], [1])


def test_segments_widen_with_the_table():
    assert [topk_search.segment_widths(n) for n in (0, 300, 51_282, 10**6, 10**9, 10**12)] == [
        [16] * 4, [16] * 4, [16] * 4, [22, 21, 21], [32, 32], [32, 32],
    ]


@pytest.mark.parametrize("widths", [[22, 21, 21], [32, 32]])
def test_wider_segments_find_the_same(spark, monkeypatch, widths):
    monkeypatch.setattr(topk_search, "segment_widths", lambda n: widths)
    random = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(random.normal(0, 1, (3, 8))[random.integers(0, 3, 60)] + random.normal(0, 0.05, (60, 8)))]
    assert _search(spark, rows, [0, 20], 4) == brute(rows, [0, 20], 4)


def test_ids_with_several_codes(spark):
    random = np.random.default_rng(6)
    centres = random.normal(0, 1, (4, 16))
    rows = [(i, centres[i % 4] + random.normal(0, 0.2, 16)) for i in range(150)]
    rows += [(500 + i % 3, centres[i % 4] + random.normal(0, 0.2, 16)) for i in range(90)]
    rows += [(20, centres[2] + random.normal(0, 0.1, 16)), (20, centres[3]), (41, centres[3]), (41, centres[3])]
    asked = [0, 20, 41, 500]
    assert _search(spark, rows, asked, 9) == brute(rows, asked, 9)


@pytest.mark.parametrize("step", [0, 40_000])
def test_small_and_large_steps_agree(spark, monkeypatch, step):
    monkeypatch.setattr(topk_search, "STEP_PROBES", step)
    random = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(random.normal(0, 1, (4, 8))[random.integers(0, 4, 200)] + random.normal(0, 0.2, (200, 8)))]
    asked = [0, 60, 199]
    assert _search(spark, rows, asked, 5) == brute(rows, asked, 5)
