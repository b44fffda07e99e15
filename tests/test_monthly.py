"""Months committed in one step, partial sums, batch log, freshness of what is derived."""

import os
import threading
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.operators import marts, partials, quality, rollups
from orderloom.operators.cleaning import clean_orders
from orderloom.operators.incremental import load_bronze
from orderloom.operators.quality import ColumnTest, QualityGateError
from orderloom.operators.staging import stg_orders
from orderloom.plans import names, pipeline
from orderloom.sources.lake import Lake, month_key
from orderloom.sources.monthly import MONTH_KEY, MonthlyTable
from orderloom.sources.star_orders import StarOrders

SF_DIR = "/root/testdata/sf0.001"
AS_OF = date(2002, 1, 1)


def _same_rows(left, right):
    assert left.columns == right.columns and left.dtypes == right.dtypes
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def orders(bronze_rows):
    """Bronze rows of (order id, date) and any other columns."""
    return lambda *rows, **more: bronze_rows(*[{"order_id": i, "order_date": d, **more} for i, d in rows])


JAN, FEB, MAR = date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)


def _build(lake):
    """Silver in step with bronze, as a run does; the months that were made again."""
    marks, silver = lake.bronze_marks(), lake.silver_months
    stale = silver.stale(marks)
    if stale:
        lake.replace_silver(clean_orders(lake.bronze_of_months(stale)), marks, stale)
    return stale


def _ids(frame):
    return sorted(r["order_id"] for r in frame.select("order_id").collect())


# -- partial sums ---------------------------------------------------------------


@pytest.fixture(scope="module")
def dirty_silver(spark):
    silver = clean_orders(StarOrders(spark, SF_DIR, dirty=True).orders())
    gaps = silver.limit(200).selectExpr(
        "* EXCEPT (customer_id, category, city, total_amount, order_date)",
        "CAST(NULL AS STRING) AS customer_id", "CAST(NULL AS STRING) AS category", "IF(quantity > 2, NULL, city) AS city",
        "IF(quantity > 1, NULL, total_amount) AS total_amount", "IF(quantity > 3, NULL, order_date) AS order_date",
    ).select(*silver.columns)
    return silver.union(gaps).persist()


def test_merged_partials_equal_the_roll_ups(dirty_silver):
    sums = partials.by_month(dirty_silver).drop(MONTH_KEY)
    assert sums.columns == partials.SCHEMA.fieldNames()
    assert [t for _, t in sums.dtypes] == [f.dataType.simpleString() for f in partials.SCHEMA.fields]
    _same_rows(partials.by_category(sums), rollups.by_category(dirty_silver))
    _same_rows(partials.by_city(sums), rollups.by_city(dirty_silver))
    _same_rows(partials.by_customer(sums, AS_OF), marts.customer_rollup(dirty_silver, AS_OF))


def test_partials_combine_before_the_shuffle(dirty_silver):
    plan = partials.by_month(dirty_silver)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "REBALANCE" in plan.upper()


def test_only_changed_months_are_read(lake, orders):
    load_bronze(lake, orders(("a", JAN), ("b", FEB), ("c", None)))
    assert _build(lake) == ["202401", "202402", "__HIVE_DEFAULT_PARTITION__"]
    assert pipeline.refresh(lake) == {name: ["202401", "202402", "__HIVE_DEFAULT_PARTITION__"] for name in pipeline.DERIVED}
    assert pipeline.refresh(lake) == {name: [] for name in pipeline.DERIVED}
    before = {name: pipeline.derived(lake, name).month_paths() for name in pipeline.DERIVED}

    load_bronze(lake, orders(("d", FEB), ("e", MAR), city="Dallas"), "append")
    assert _build(lake) == ["202402", "202403"]
    read = lake.silver_of_months(["202402", "202403"]).inputFiles()
    assert read and all("order_ym=202402" in f or "order_ym=202403" in f for f in read)
    assert pipeline.refresh(lake) == {name: ["202402", "202403"] for name in pipeline.DERIVED}
    for name, paths in before.items():
        now = pipeline.derived(lake, name).month_paths()
        assert {m for m in now if now[m] == paths.get(m)} == {"202401", "__HIVE_DEFAULT_PARTITION__"}

    assert _ids(lake.silver()) == list("abcde")
    staging = stg_orders(lake.silver())
    sums = pipeline.derived(lake, pipeline.PARTIALS).read()
    _same_rows(partials.by_category(sums), rollups.by_category(staging))
    _same_rows(partials.by_city(sums), rollups.by_city(staging))
    _same_rows(partials.by_customer(sums, AS_OF), marts.customer_rollup(staging, AS_OF))
    _same_rows(pipeline.derived(lake, pipeline.DAILY).read(), marts.daily_sales(staging))


def test_months_that_lose_their_rows_go(lake, orders):
    load_bronze(lake, orders(("a", JAN), ("b", FEB)))
    _build(lake)
    pipeline.refresh(lake)
    load_bronze(lake, orders(("c", FEB)), "replace")
    assert _build(lake) == ["202401", "202402"]
    assert _ids(lake.silver()) == ["c"] and _build(lake) == []
    assert pipeline.refresh(lake)[pipeline.PARTIALS] == ["202401", "202402"]
    assert pipeline.derived(lake, pipeline.PARTIALS).read().agg(F.sum("orders")).first()[0] == 1


def test_months_without_a_valid_row_are_not_made_twice(lake, orders):
    load_bronze(lake, orders(("a", JAN), status="cancelled"))
    assert _build(lake) == ["202401"] and _build(lake) == []
    assert lake.silver().count() == 0
    assert pipeline.refresh(lake) == {name: [] for name in pipeline.DERIVED}


# -- commits --------------------------------------------------------------------


def test_a_failed_month_leaves_the_old_ones(spark, lake, orders):
    load_bronze(lake, orders(("a", JAN), ("b", FEB)))
    _build(lake)
    rows = clean_orders(orders(("x", JAN), ("y", FEB)))
    broken = rows.withColumn("order_id", F.expr("IF(order_id = 'y', raise_error('lost'), order_id)").cast("string"))
    with pytest.raises(Exception, match="lost"):
        lake.replace_silver(broken, lake.bronze_marks(), ["202401", "202402"])
    assert _ids(lake.silver()) == ["a", "b"]
    lake.replace_silver(rows, lake.bronze_marks(), ["202401", "202402"])
    assert _ids(lake.silver()) == ["x", "y"]


def test_a_build_counts_with_its_manifest_alone(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, 202401), (2, 202402)], "v int, order_ym int")
    table = MonthlyTable(spark, str(tmp_path / "t"), rows.drop(MONTH_KEY).schema)
    assert table.replace(rows, {"202401": "m1", "202402": "m1"}) == 2
    lost = rows.withColumn("v", F.col("v") * 10)
    with monkeypatch.context() as patched:
        patched.setattr(MonthlyTable, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            table.replace(lost, {"202401": "m2", "202402": "m2"})
    assert sorted(r["v"] for r in table.read().collect()) == [1, 2]
    assert table.stale({"202401": "m2", "202402": "m1"}) == ["202401"]
    table.replace(lost.where("order_ym = 202401"), {"202401": "m2", "202402": "m1"}, ["202401"])
    assert sorted(r["v"] for r in table.read().collect()) == [2, 10]
    assert sorted(r["v"] for r in table.read(["202402"]).collect()) == [2]


def test_readers_of_the_manifest_before_keep_their_files(spark, tmp_path):
    def rows(v):
        return spark.createDataFrame([(v, 202401)], "v int, order_ym int")

    table = MonthlyTable(spark, str(tmp_path / "t"), rows(1).drop(MONTH_KEY).schema)
    table.replace(rows(1), {"202401": "a"})
    reader = table.read()
    table.replace(rows(2), {"202401": "b"})
    assert [r["v"] for r in reader.collect()] == [1] and [r["v"] for r in table.read().collect()] == [2]
    table.replace(rows(3), {"202401": "c"})
    assert len(list((tmp_path / "t").glob("build=*"))) == 2


def test_rows_of_other_months_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, 202401), (2, 202402)], "v int, order_ym int")
    table = MonthlyTable(spark, str(tmp_path / "t"), rows.drop(MONTH_KEY).schema)
    with pytest.raises(ValueError, match="202402"):
        table.replace(rows, {"202401": "m"})
    assert table.read().count() == 0 and table.version() == 0


def test_a_repeated_batch_adds_nothing(lake, orders):
    first, second = orders(("a", JAN)), orders(("b", JAN))
    for mode in ("append", "incremental"):
        assert load_bronze(lake, second, mode, f"{mode}-1") == (1 if mode == "append" else 0)
    assert load_bronze(lake, first, "append", "append-1") == 0
    assert load_bronze(lake, first, "append", "append-2") == 1
    assert load_bronze(lake, first, "append") == 1  # without a name it is another batch
    assert _ids(lake.bronze()) == ["a", "a", "b"]
    with pytest.raises(ValueError, match="batch id"):
        load_bronze(lake, first, "append", "../x")


def test_a_lost_batch_is_not_read_and_is_written_anew(lake, orders):
    load_bronze(lake, orders(("a", JAN)), "append", "one")
    rows = orders(("b", JAN), ("c", FEB))
    broken = rows.withColumn("order_id", F.expr("IF(order_id = 'c', raise_error('lost'), order_id)").cast("string"))
    with pytest.raises(Exception, match="lost"):
        load_bronze(lake, broken, "append", "two")
    # What a writer leaves that is lost between its files and its marker.
    left = Path(lake.path("bronze_orders")) / "batch=two" / "order_ym=202402"
    left.mkdir(parents=True, exist_ok=True)
    whole = next(Path(lake.path("bronze_orders")).glob("batch=one/*/*.parquet"))
    (left / "part-lost.parquet").write_bytes(whole.read_bytes())
    assert _ids(lake.bronze()) == ["a"] and lake.bronze_months() == ["202401"] and list(lake.bronze_marks()) == ["202401"]
    assert load_bronze(lake, rows, "append", "two") == 2
    assert _ids(lake.bronze()) == ["a", "b", "c"]


def test_a_replaced_file_of_equal_size_is_noticed(lake, orders):
    load_bronze(lake, orders(("a", JAN), ("b", FEB)))
    before = lake.bronze_marks()
    assert lake.bronze_marks() == before
    file = next(Path(lake.path("bronze_orders")).glob("batch=*/order_ym=202402/*.parquet"))
    file.write_bytes(file.read_bytes())
    os.utime(file, (file.stat().st_atime + 60, file.stat().st_mtime + 60))
    after = lake.bronze_marks()
    assert {m for m in after if after[m] != before[m]} == {"202402"}


# -- checks of silver as it is ------------------------------------------------------


def test_checks_after_the_silver_stage_see_new_rows(spark, lake, orders):
    # Three segments' worth of orders would be needed for all four; one is asked for.
    load_bronze(lake, orders(("a", JAN), ("b", FEB)))
    settings = dict(as_of=AS_OF, categories=("Books",), expected_segments=1)
    for stage in ("silver", "marts", "gold", "tests", "checks"):
        pipeline.run_stage(spark, stage, lake.base, **settings)
    load_bronze(lake, orders(("c", MAR), customer_id=None))
    pipeline.run_stage(spark, "silver", lake.base)
    with pytest.raises(QualityGateError, match="no_missing_customer"):
        pipeline.run_stage(spark, "checks", lake.base, **settings)
    with pytest.raises(QualityGateError, match="not_null"):
        pipeline.run_stage(spark, "tests", lake.base, **settings)


def test_colliding_keys_of_distinct_orders_fail_the_gate(bronze_rows):
    staging = stg_orders(clean_orders(bronze_rows({"order_id": "a"}, {"order_id": "b"}, {"order_id": "c"})))
    tests = [ColumnTest("unique", "stg_orders", "order_sk"), ColumnTest("unique", "stg_orders", "order_id")]
    assert len(quality.gate(quality.run_column_tests({"stg_orders": staging}, tests))) == 2
    colliding = staging.withColumn("order_sk", F.expr("IF(order_id = 'c', order_sk, 'same')"))
    with pytest.raises(QualityGateError) as failure:
        quality.gate(quality.run_column_tests({"stg_orders": colliding}, tests))
    assert [(r["column_name"], r["failures"]) for r in failure.value.failed] == [("order_sk", 1)]
    loose = staging.withColumn("order_id", F.expr("IF(order_id = 'c', 'c', 'same')"))
    with pytest.raises(QualityGateError) as failure:
        quality.gate(quality.run_column_tests({"stg_orders": loose}, tests))
    assert [(r["column_name"], r["failures"]) for r in failure.value.failed] == [("order_id", 1)]


def test_unique_columns_share_a_scan_and_a_shuffle(bronze_rows, spark, tmp_path):
    bronze_rows({"order_id": "a"}).write.parquet(str(tmp_path / "b"))
    staging = stg_orders(clean_orders(spark.read.parquet(str(tmp_path / "b"))))
    plan = quality.repeated_keys(staging, ["order_sk", "order_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(column_name") == 2
    assert "partial_count" in plan


# -- catalog ------------------------------------------------------------------------


def test_published_tables_are_never_missing(spark, lake, orders):
    settings = dict(as_of=AS_OF, categories=("Books",), expected_segments=1, database="shop_swap")
    pipeline.run(spark, orders(("a", JAN), ("b", MAR)), lake.base, **settings)
    seen, problems, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.sql("SELECT count(*) FROM shop_swap.gold_daily_sales").first()[0])
                seen.add(("silver", spark.sql("SELECT count(*) FROM shop_swap.silver_orders").first()[0]))
            except Exception as error:  # whatever a reader would see
                problems.append(str(error))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        pipeline.run(spark, orders(("c", FEB)), lake.base, load="append", **settings)
    finally:
        stop.set()
        reader.join()
    try:
        assert not problems and seen <= {2, 3, ("silver", 2), ("silver", 3)}
        assert spark.sql("SELECT count(*) FROM shop_swap.gold_daily_sales").first()[0] == 3
        by_month = spark.sql("SELECT order_ym, count(*) AS n FROM shop_swap.silver_orders GROUP BY order_ym").collect()
        assert {(r["order_ym"], r["n"]) for r in by_month} == {("202401", 1), ("202402", 1), ("202403", 1)}
        assert spark.table("shop_swap.bronze_orders").count() == 3
        # A replaced bronze drops months and batches.
        pipeline.run(spark, orders(("z", FEB)), lake.base, load="replace", **settings)
        assert _ids(spark.table("shop_swap.silver_orders")) == _ids(spark.table("shop_swap.bronze_orders")) == ["z"]
        # Rows without a date have a partition too.
        load_bronze(lake, orders(("n", None)), "append")
        _build(lake)
        names.publish(lake, "shop_swap")
        for name in ("silver_orders", "bronze_orders"):
            found = spark.table(f"shop_swap.{name}").select("order_id", MONTH_KEY).collect()
            assert {tuple(r) for r in found} == {("z", "202402"), ("n", None)}
    finally:
        names.withdraw(lake, "shop_swap")
        spark.sql("DROP DATABASE shop_swap")


def test_month_key(spark):
    found = spark.sql("SELECT DATE '2024-03-05' AS d UNION ALL SELECT NULL").select(month_key("d")).collect()
    assert {r[0] for r in found} == {202403, None}
