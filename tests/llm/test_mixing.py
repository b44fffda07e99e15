import pytest
from pyspark.sql import functions as F

from orderloom.llm import mixing


def water_fill(sizes: dict, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[n] for n in capped)
        free = sum(weight[n] for n in names if n not in capped)
        target = {n: most * sizes[n] if n in capped else left * weight[n] / free for n in names}
        above = {n for n in names if n not in capped and target[n] > most * sizes[n]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 10, "c": 1000},
        {"a": 1, "b": 1, "c": 1, "d": 5000, None: 7},
        {"é": 40, "z": 30, "A": 0, None: 0},
        {"a": 0},
        {"only": 12},
        {f"s{i}": (i * 37) % 101 for i in range(23)},
        # Sources that fill at one level.
        {"a": 10, "b": 10, "c": 10, "d": 10},
        {"a": 5, "b": 2, "c": 1},
        {"a": 0, "b": 0, "c": 9, None: 9},
        {f"site{i:05}": 7 for i in range(3000)},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(water_fill(sizes))


def _documents(documents, n, sources):
    return documents(*[(i, "w " * (1 + (i * 7919) % 300), sources[i % len(sources)]) for i in range(n)])


def test_words_taken_come_near_the_targets(spark, documents):
    docs = _documents(documents, 1500, ["a", "b", "b", "c", None])
    rows = mixing.mix(docs, keep=["doc_id", "source"]).collect()
    assert len(rows) == 1500
    taken, target, largest = {}, {}, {}
    for r in rows:
        s = r["doc"]["source"]
        assert 0 <= r["copies"] <= 3
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        target[s], largest[s] = r["target"], max(largest.get(s, 0), r["size"])
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]


def test_no_task_holds_all_sources(spark):
    frame = spark.createDataFrame([(f"site{i}", i) for i in range(5000)], "source string, source_size bigint").repartition(3)
    rows = mixing._with_sums_before(frame, F.col("source").asc_nulls_last(), {"n": F.lit(1), "size": F.col("source_size")})
    got = [(r["source"], r["n"], r["size"]) for r in rows.orderBy("source").collect()]
    expected, total = [], 0
    for n, (name, size) in enumerate(sorted((f"site{i}", i) for i in range(5000))):
        expected.append((name, n, total))
        total += size
    assert got == expected
    _only_sums_by_partition_meet(rows)


def _only_sums_by_partition_meet(frame):
    lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("Aggregate(key=[_part" in lines[i + 1] or "Aggregate(keys=[_part" in lines[i + 1] for i in single)


def test_reruns_and_layouts_agree(spark, documents):
    docs = _documents(documents, 400, ["a", "b"])
    once = {r["doc"]["doc_id"]: r["copies"] for r in mixing.mix(docs, keep=["doc_id"]).collect()}
    again = {r["doc"]["doc_id"]: r["copies"] for r in mixing.mix(docs.repartition(7), keep=["doc_id"]).collect()}
    assert once == again


def test_one_text_with_most_rows_is_spread(spark, documents):
    docs = documents(*[(i, "the same words", "hot") for i in range(3000)], *[(i, "x y", "b") for i in range(3000, 3100)])
    cells = mixing.mix(docs, keep=["doc_id"])
    assert cells.count() == 3100
    _only_sums_by_partition_meet(cells)
    buckets = F.expr("CAST(conv(substring(md5(concat('7:', doc_id)), 1, 7), 16, 10) AS BIGINT) % 256")
    assert docs.where("source = 'hot'").select(buckets).distinct().count() > 250


def test_edge_rows(spark, documents, with_clashes):
    docs = with_clashes(documents((None, None, None), (None, "a b", None), (1, "", "s"), (2, "x" * 100_000, "s"), (2, "x", "s"), (2, "x", "s")))
    rows = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 1, 1, 1, 2]
    assert rows[0]["doc"].asDict().keys() == set(docs.columns)
    assert set(mixing.mixed_documents(docs).columns) == set(docs.columns)
    assert mixing.mix(docs.where("false")).count() == 0


def test_emitted_documents_match_the_copies(spark, documents):
    docs = _documents(documents, 300, ["a", "b", "c"])
    copies = {r["doc"]["doc_id"]: r["copies"] for r in mixing.mix(docs, keep=["doc_id"]).collect()}
    emitted = {r["doc_id"]: r["n"] for r in mixing.mixed_documents(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert emitted == {i: n for i, n in copies.items() if n}


def test_stays_native(spark, documents):
    plan = mixing.mix(_documents(documents, 10, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
