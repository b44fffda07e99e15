"""Shapes that must hold at any scale."""

import re

import pytest

import __spark_entry__ as contract
from orderloom.operators.cleaning import clean_orders
from orderloom.schema import BRONZE
from orderloom.sources.star_orders import StarOrders
from verification import oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in contract.queries().items() if name in oracle.build()}


@pytest.fixture(scope="module", autouse=True)
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "10000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(query(spark, SF_DIR)) for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", QUERIES)
def test_stays_in_the_jvm_without_cross_joins_or_global_windows(plans, name):
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Window", "CollectLimit"):
        assert node not in plans[name], node


def _shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange ((?:hash|range)partitioning\([^,]*|SinglePartition)", plan)


def test_row_queries_shuffle_for_look_ups_only(plans):
    assert _shuffles(plans["silver_calendar"]) == []
    assert len(_shuffles(plans["silver_flags"])) == 2  # lines and orders
    assert "Aggregate" not in plans["silver_orders"]


def test_look_ups_nobody_needs_are_not_joined(plans):
    assert "part.parquet" not in plans["gold_daily_sales"]
    assert "nation.parquet" not in plans["gold_category_metrics"]
    assert "orders.parquet" not in plans["incremental_watermark"]
    assert plans["gold_customer_segments"].count("SortMergeJoin") == 1


def test_gold_without_distinct_counts_aggregates_once(plans):
    # Two exchanges of the look-up on each side plus one for the aggregate.
    assert len(_shuffles(plans["gold_customer_segments"])) == 3
    assert len(_shuffles(plans["gold_category_metrics"])) == 5
    assert "distinct" not in plans["gold_category_metrics"]


def test_aggregates_combine_before_the_shuffle(plans):
    for name in ("gold_daily_sales", "mart_category_metrics", "mart_customer_segments", "dq_duplicate_keys"):
        assert "partial_count" in plans[name]


def test_checks_of_one_table_share_a_scan(plans):
    assert plans["dq_expectations_silver"].count("lineitem.parquet") == 1
    assert plans["report_segment_revenue_share"].count("lineitem.parquet") == 1


def test_column_tests_share_scans_between_silver_and_staging(plans):
    # Staging, daily, category, customers and city: one scan each.
    assert plans["dq_not_null"].count("lineitem.parquet") == 5
    # order_id for two models and the key made from it, and one key per mart.
    assert plans["dq_unique"].count("lineitem.parquet") == 5
    # The distinct counts expand pairs that are grouped already, not silver's rows.
    expanded = plans["dq_reconciliation"].split("Expand")[1].split("lineitem.parquet")[0]
    assert "HashAggregate(keys=[category" in expanded


def test_scan_reads_needed_columns_only(plans):
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plans["incremental_watermark"]


def test_cleaning_filters_reach_the_bronze_scan(spark, tmp_path):
    StarOrders(spark, SF_DIR, dirty=True).orders().write.parquet(str(tmp_path / "bronze"))
    plan = _plan(clean_orders(spark.read.schema(BRONZE).parquet(str(tmp_path / "bronze"))))
    assert "GreaterThan(unit_price,0.000000)" in plan and "GreaterThan(quantity,0)" in plan
    assert "Exchange" not in plan


def test_watermark_filter_is_below_the_look_ups(plans):
    plan = plans["incremental_new_rows"]
    assert plan.index("SortMergeJoin") < plan.index("Subquery")


def test_hot_look_up_key_is_split(spark, tmp_path):
    """A third of all lines point at one part; the join must not put them in one task."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    many = lines.selectExpr("*", "explode(sequence(1, 40)) AS id").selectExpr(
        "* EXCEPT (l_partkey, id)", "CASE WHEN pmod(hash(l_orderkey, id), 3) = 0 THEN 7L ELSE l_partkey END AS l_partkey"
    )
    many.repartition(16).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("orders", "part"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame = QUERIES["gold_category_metrics"](spark, str(tmp_path))
        assert sum(r["total_orders"] for r in frame.collect()) > 0
        assert "skew=true" in _plan(frame)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_missing_look_up_row_loses_no_order(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.read.parquet(f"{SF_DIR}/part.parquet").where("p_partkey > 50").write.parquet(str(tmp_path / "part.parquet"))
    orders = StarOrders(spark, str(tmp_path)).orders()
    assert orders.count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert orders.where("category IS NULL").count() > 0


@pytest.mark.parametrize("table, key", [("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"), ("part", "p_partkey")])
def test_look_up_keys_are_unique(spark, table, key):
    keys = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    assert keys.count() == keys.distinct().count() == keys.dropna().count()
