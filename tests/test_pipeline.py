"""The whole chain over stored tables, and its streaming form."""

from datetime import date
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest

from orderloom.operators import gold, marts
from orderloom.operators.cleaning import clean_orders
from orderloom.operators.quality import QualityGateError
from orderloom.operators.staging import stg_orders
from orderloom.plans import names, pipeline
from orderloom.plans.report_book import report_book
from orderloom.schema import ACCEPTED_CATEGORIES, BRONZE
from orderloom.sources.lake import Lake
from orderloom.sources.sizes import shuffle_partitions, stored_bytes
from orderloom.sources.star_orders import raw_orders
from orderloom.streaming.bronze_stream import checkpoint_folder, load_new_files

SF_DIR = "/root/testdata/sf0.001"
AS_OF = date(2002, 1, 1)
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    raw_orders(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return pipeline.read_orders(spark, path)


@pytest.fixture(scope="module")
def first_run(spark, source, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake") / "shop")
    return base, pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)


def _same_rows(left, right):
    assert left.columns == right.columns
    assert left.dtypes == right.dtypes
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_counts(spark, source, first_run):
    base, result = first_run
    lake = Lake(spark, base)
    assert result.rows_loaded == source.count() == lake.bronze().count()
    for name, rows in result.rows.items():
        assert lake.table(name).count() == rows > 0, name
    assert len(result.column_tests) == 27
    assert len(result.checks) == 8
    assert all(r["passed"] for r in result.column_tests + result.checks)


def test_tables_equal_the_lazy_queries(spark, source, first_run):
    lake = Lake(spark, first_run[0])
    silver = clean_orders(source)
    staging = stg_orders(silver)
    _same_rows(lake.silver(), silver)
    _same_rows(lake.table("gold_daily_sales"), gold.daily_sales(silver))
    _same_rows(lake.table("gold_category_metrics"), gold.category_metrics(silver))
    _same_rows(lake.table("gold_customer_segments"), gold.customer_segments(silver, AS_OF))
    _same_rows(lake.table("gold_customer_spend_tiers"), gold.customer_spend_tiers(silver))
    _same_rows(lake.table("gold_city_metrics"), gold.city_metrics(silver))
    _same_rows(lake.table("mart_daily_sales"), marts.daily_sales(staging))
    _same_rows(lake.table("mart_category_metrics"), marts.category_metrics(staging))
    _same_rows(lake.table("mart_customer_segments"), marts.customer_segments(staging, AS_OF))
    _same_rows(lake.table("mart_city_metrics"), marts.city_metrics(staging))


def test_total_revenue(spark, first_run):
    base, result = first_run
    total = Lake(spark, base).silver().agg({"total_amount": "sum"}).first()[0]
    assert result.total_revenue == total > Decimal(0)


def test_silver_scan_reads_only_what_a_mart_needs(spark, first_run):
    plan = marts.city_metrics(stg_orders(Lake(spark, first_run[0]).silver()))._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema:") :]
    assert "order_id" not in schema and "gross_amount" not in schema and "category" not in schema


def test_second_run_changes_nothing(spark, source, first_run):
    base, result = first_run
    again = pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)
    assert again.rows_loaded == 0
    assert again.rows == result.rows and again.total_revenue == result.total_revenue


def _files(lake, name):
    return {str(f): f.stat().st_mtime_ns for f in Path(lake.path(name)).rglob("*.parquet")}


def test_nothing_new_rewrites_nothing(spark, source, first_run):
    lake = Lake(spark, first_run[0])
    before = {name: _files(lake, name) for name in ("silver_orders", "mart_daily_sales", "customer_rollup", "gold_city_metrics")}
    pipeline.run(spark, source, first_run[0], as_of=AS_OF, categories=PART_TYPES)
    assert {name: _files(lake, name) for name in before} == before


def test_another_day_moves_recency_alone(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)
    lake = Lake(spark, base)
    silver = _files(lake, "silver_orders")
    later = date(2002, 1, 11)
    pipeline.run(spark, source, base, as_of=later, categories=PART_TYPES)
    assert _files(lake, "silver_orders") == silver
    _same_rows(lake.table("gold_customer_segments"), gold.customer_segments(lake.silver(), later))
    _same_rows(lake.table("mart_customer_segments"), marts.customer_segments(stg_orders(lake.silver()), later))


def test_a_new_month_touches_its_own_files(spark, source, tmp_path):
    """Loaded in two steps, with a new month and more of an old one: as if loaded at once."""
    base, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    cut = "order_date < DATE '2001-06-16'"
    pipeline.run(spark, source.where(cut), base, as_of=AS_OF, categories=PART_TYPES)
    lake = Lake(spark, base)
    before = _files(lake, "silver_orders")
    second = pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)
    after = _files(lake, "silver_orders")
    june = "order_ym=200106/"
    old = {f: t for f, t in before.items() if june not in f}
    assert old and old.items() <= after.items()
    assert any(f not in before for f in after if june in f)
    at_once = pipeline.run(spark, source, whole, as_of=AS_OF, categories=PART_TYPES)
    assert second.rows == at_once.rows and second.total_revenue == at_once.total_revenue
    for name in [n for n in at_once.rows if n != "bronze_orders"]:
        _same_rows(lake.table(name), Lake(spark, whole).table(name))


def test_stages_alone(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    done = {}
    for stage in pipeline.STAGES:
        done |= pipeline.run_stage(spark, stage, base, source, as_of=AS_OF, categories=PART_TYPES)
    assert done["bronze_orders"] == source.count() and done["column_tests"] == 27 and done["checks"] == 8
    again = pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)
    assert again.rows_loaded == 0 and again.rows.items() <= done.items()
    with pytest.raises(ValueError, match="dance"):
        pipeline.run_stage(spark, "dance", base)


def test_published_tables_stay_current(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    try:
        for condition in ("order_date < DATE '2000-01-01'", "true"):
            part = source.where(condition)
            pipeline.run(spark, part, base, as_of=AS_OF, categories=PART_TYPES, database="shop_live")
            assert spark.table("shop_live.bronze_orders").count() == part.count()
            assert spark.table("shop_live.silver_orders").count() == Lake(spark, base).silver().count()
    finally:
        names.withdraw(Lake(spark, base), "shop_live")
        spark.sql("DROP DATABASE shop_live")


def test_raw_types_of_their_own(spark, source, tmp_path):
    """Doubles, floats, wide integers and timestamps load as the declared types do."""
    plain, typed = str(tmp_path / "plain"), str(tmp_path / "typed")
    few = source.where("order_date >= DATE '2001-01-01'")
    few.write.parquet(plain)
    few.selectExpr(
        "* EXCEPT (order_date, quantity, unit_price, discount_pct, shipping_cost)",
        "CAST(order_date AS TIMESTAMP) AS ORDER_DATE",
        "CAST(quantity AS BIGINT) AS quantity",
        "CAST(unit_price AS DOUBLE) AS unit_price",
        "CAST(discount_pct AS BIGINT) AS discount_pct",
        "CAST(shipping_cost AS FLOAT) AS shipping_cost",
    ).write.parquet(typed)
    lakes = {}
    for path in (plain, typed):
        base = f"{path}-lake"
        result = pipeline.run(spark, pipeline.read_orders(spark, path), base, as_of=AS_OF, categories=PART_TYPES, expected_segments=3)
        lakes[path] = Lake(spark, base)
        streamed = Lake(spark, f"{path}-stream")
        assert load_new_files(streamed, path, f"{path}-progress").awaitTermination(120)
        _same_rows(streamed.bronze(), lakes[path].bronze())
        assert result.rows_loaded == few.count()
    _same_rows(lakes[plain].silver(), lakes[typed].silver())


def test_long_reports_come_out_whole(spark, bronze_rows, tmp_path, capsys):
    days = bronze_rows(*[{"customer_id": f"CUST-{c}", "unit_price": Decimal(p)} for c, p in enumerate(("450.00", "350.00", "20.00"))]).selectExpr(
        "* EXCEPT (order_id, order_date)", "explode(sequence(0, 499)) AS week"
    ).selectExpr("* EXCEPT (week)", "uuid() AS order_id", "date_add(DATE '2010-01-04', 7 * week) AS order_date")
    base = str(tmp_path / "lake")
    days.write.parquet(str(tmp_path / "raw"))
    assert pipeline.main(["--source", str(tmp_path / "raw"), "--base", base, "--as-of", "2024-02-01", "--reports", "--segments", "1"]) == 0
    assert "revenue_by_week" in capsys.readouterr().out
    weeks = Lake(spark, base).table("report_revenue_by_week").collect()
    assert len(weeks) == 500 and [w["week"] for w in weeks] == sorted(w["week"] for w in weeks)


def test_categories_and_segments_from_the_command_line(spark, bronze_rows, tmp_path, capsys):
    bronze_rows({"category": "Garden tools"}).write.parquet(str(tmp_path / "raw"))
    arguments = ["--source", str(tmp_path / "raw"), "--base", str(tmp_path / "lake"), "--as-of", "2024-02-01", "--segments", "1"]
    assert pipeline.main(arguments) == 1
    assert pipeline.main([*arguments, "--category", "Garden tools"]) == 0
    assert pipeline.main(["--stage", "checks", "--base", str(tmp_path / "lake"), "--segments", "1"]) == 0
    assert "checks: 8" in capsys.readouterr().out


def test_views_answer_sql_by_table_name(spark, first_run):
    lake = Lake(spark, first_run[0])
    names.register_views(lake)
    try:
        assert spark.sql("SELECT count(DISTINCT order_sk) AS n FROM stg_orders").first()["n"] == lake.silver().count()
        got = spark.sql("SELECT COUNT(*) AS n FROM SILVER_ORDERS WHERE STATUS = 'cancelled'").first()["n"]
        assert got == 0
        assert spark.sql("SELECT * FROM GOLD_CATEGORY_METRICS").count() == 6
    finally:
        names.unregister_views(lake)
    assert not {t.name for t in spark.catalog.listTables()} & {*names.STORED, names.STAGING}


def test_catalog_tables_come_and_go_without_the_files(spark, first_run):
    base, result = first_run
    lake = Lake(spark, base)
    names.publish(lake, "shop_test")
    try:
        names.publish(lake, "shop_test")  # again, over the old entries
        for name in ("bronze_orders", "silver_orders", "mart_city_metrics"):
            assert spark.table(f"shop_test.{name}").count() == lake.table(name).count() > 0
        by_month = "SELECT count(*) AS n FROM shop_test.silver_orders WHERE order_year = 1998 AND order_month = 5"
        assert spark.sql(by_month).first()["n"] == lake.silver().where("order_year = 1998 AND order_month = 5").count() > 0
    finally:
        names.withdraw(lake, "shop_test")
        spark.sql("DROP DATABASE shop_test")
    assert lake.silver().count() == result.rows["silver_orders"]


def test_summary(spark, first_run):
    base, result = first_run
    rows = {r["table_name"]: (r["layer"], r["row_count"]) for r in pipeline.summary(Lake(spark, base)).collect()}
    assert list(rows) == list(pipeline.TABLES)
    assert rows["silver_orders"] == ("SILVER", result.rows["silver_orders"])


def test_reports_over_stored_tables(spark, first_run):
    base, result = first_run
    book = report_book(Lake(spark, base))
    for title in ("category performance", "category chart", "segment revenue share", "revenue by week", "city rankings"):
        assert sum(r["total_revenue"] for r in book[title].collect()) == result.total_revenue, title
    assert sum(r["quarterly_revenue"] for r in book["revenue by quarter"].collect()) == result.total_revenue
    assert sum(r["segment_revenue"] for r in book["segment summary"].collect()) == result.total_revenue
    assert sum(r["revenue"] for r in book["top categories"].collect()) == result.total_revenue


def test_sizes(spark, first_run):
    base, _ = first_run
    silver = Lake(spark, base).path("silver_orders")
    size = stored_bytes(spark, silver)
    assert size == sum(f.stat().st_size for f in Path(silver).rglob("*.parquet")) > 0
    assert stored_bytes(spark, f"{base}/nothing_here") == 0
    assert shuffle_partitions(0, at_least=8) == 8
    assert shuffle_partitions((128 << 20) * 50 + 1, at_least=8) == 51
    assert shuffle_partitions(10**14, at_least=200) == 745_059


def test_empty_input(spark, source, tmp_path):
    """Every stage copes with no rows; only the segment check objects."""
    base = str(tmp_path / "lake")
    with pytest.raises(QualityGateError, match="all_segments_present") as failure:
        pipeline.run(spark, source.where("false"), base, as_of=AS_OF, categories=PART_TYPES)
    assert len(failure.value.failed) == 1
    result = pipeline.run(spark, source.where("false"), base, as_of=AS_OF, expected_segments=0)
    assert set(result.rows.values()) == {0} and result.total_revenue is None


def test_gate_stops_on_a_value_outside_the_list(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    with pytest.raises(QualityGateError, match="accepted_values"):
        pipeline.run(spark, source, base, as_of=AS_OF, categories=ACCEPTED_CATEGORIES)
    assert Lake(spark, base).table("mart_category_metrics").count() == 6  # left for inspection


def test_tests_and_checks_read_silver_once(spark, first_run):
    """For the unique keys; everything else is in its profile."""
    lake = Lake(spark, first_run[0])
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (pipeline.column_test_results(lake, PART_TYPES), pipeline.check_results(lake))]
    assert sum(p.count("FileScan parquet") and p.count("silver_orders/") for p in plans) == 1


def test_gate_stops_on_repeated_orders(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    pipeline.run(spark, source, base, as_of=AS_OF, categories=PART_TYPES)
    with pytest.raises(QualityGateError, match="unique"):
        pipeline.run(spark, source, base, load="append", as_of=AS_OF, categories=PART_TYPES)


def test_command_line(spark, bronze_rows, tmp_path, capsys):
    rows = [
        {"customer_id": f"CUST-{c:06d}", "unit_price": Decimal(price), "category": category, "order_date": date(2024, 1, c)}
        for c, price, count in ((1, "450.00", 5), (2, "350.00", 3), (3, "400.00", 2), (4, "20.00", 1))
        for category in ACCEPTED_CATEGORIES[:count]
    ]
    source = str(tmp_path / "raw")
    bronze_rows(*rows).write.parquet(source)
    arguments = ["--source", source, "--base", str(tmp_path / "lake"), "--as-of", "2024-02-01"]
    assert pipeline.main([*arguments, "--reports"]) == 0
    printed = capsys.readouterr().out
    assert "loaded 11 rows" in printed and "report_segment_summary/v1: 4 rows" in printed
    assert pipeline.main([*arguments, "--load", "replace"]) == 0
    assert "loaded 11 rows" in capsys.readouterr().out
    assert pipeline.main([*arguments, "--load", "append"]) == 1  # every order id now repeats
    assert "unique" in capsys.readouterr().err


# -- streaming ------------------------------------------------------------------


def _land(source, landing, condition):
    source.where(condition).select(*BRONZE.fieldNames()).coalesce(2).write.mode("append").parquet(landing)


def test_stream_loads_each_file_once(spark, source, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")

    def load():
        query = load_new_files(lake, landing, progress)
        assert query.awaitTermination(120)
        return lake.bronze().count()

    early, late = "order_date < DATE '2001-01-01'", "order_date >= DATE '2001-01-01'"
    _land(source, landing, early)
    assert load() == source.where(early).count()
    assert load() == source.where(early).count()  # nothing new
    _land(source, landing, late)
    assert load() == source.count()
    _land(source, landing, early)  # late rows arrive again: all at or below the watermark
    assert load() == source.count()
    _same_rows(lake.bronze(), source)


def test_stream_keeps_files_of_one_day(spark, bronze_rows, tmp_path):
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    for n in (1, 2):
        bronze_rows({"order_id": f"ORD-{n}"}).selectExpr("* EXCEPT (order_id)", f"'ORD-{n}' AS order_id").write.mode("append").parquet(landing)
        assert load_new_files(lake, landing, str(tmp_path / "progress"), load="append").awaitTermination(120)
    assert sorted(r["order_id"] for r in lake.bronze().collect()) == ["ORD-1", "ORD-2"]


def test_stream_progress_folder(spark):
    """In the cluster's shared folder, one per lake; beside the tables if there is none."""

    def folder(base, shared):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared or default))
        return checkpoint_folder(session, Lake(spark, base))

    assert folder("/lakes/a", None) == "/lakes/a/_bronze_stream"
    assert folder("/lakes/a", "/shared/").startswith("/shared/bronze_stream_")
    assert folder("/lakes/a", "/shared") != folder("/lakes/b", "/shared")
