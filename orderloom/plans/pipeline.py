"""The whole chain: bronze, silver, marts, gold, column tests, checks, gate.

Each stage writes its table and the next one reads it back, so a lost executor
costs the tasks it ran and never an earlier stage. Marts and gold tables are merges
and column selections of stored partial sums; they scan nothing large.

Bronze only grows and cleaning is row by row, so silver is rebuilt for the months
whose bronze files have changed, which their listing tells. What is derived from silver
month by month (partial sums, daily sales, the profile that checks read) remembers which
build of silver each month was made from, and is brought up to date for the others:
silver is read for changed months alone, whichever stage changed them. A run that finds
no change rewrites nothing but what counts days to today. ``rebuild`` makes all anew.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.operators import gold, marts, partials, quality
from orderloom.operators.cleaning import as_bronze, clean_orders
from orderloom.operators.incremental import LOAD_MODES, load_bronze
from orderloom.operators.reports import layer_row_counts
from orderloom.operators.staging import stg_orders
from orderloom.plans.column_tests import NOT_NULL, all_tests
from orderloom.plans.report_book import report_book
from orderloom.schema import ACCEPTED_CATEGORIES, SEGMENTS, SILVER
from orderloom.session import build_session
from orderloom.sources.lake import BRONZE_TABLE, SILVER_TABLE, Lake, month_key
from orderloom.sources.monthly import MONTH_KEY, MonthlyTable
from orderloom.sources.sizes import shuffle_partitions, stored_bytes

# table -> (layer, description)
TABLES = {
    BRONZE_TABLE: ("BRONZE", "order lines as loaded"),
    SILVER_TABLE: ("SILVER", "valid order lines with derived columns"),
    "gold_daily_sales": ("GOLD", "sales per day"),
    "gold_category_metrics": ("GOLD", "sales per category"),
    "gold_customer_segments": ("GOLD", "spend and segment per customer"),
    "gold_city_metrics": ("GOLD", "sales per city"),
}
MARTS = ("mart_daily_sales", "mart_category_metrics", "mart_customer_segments", "mart_city_metrics")
# All measures per customer; the mart and both gold customer tables select from it.
CUSTOMER_ROLLUP = "customer_rollup"
# Tables derived from silver month by month: exact partial sums, sales per day, and what
# row-level checks need, added up per category, city and status.
PARTIALS = "sales_partials"
DAILY = "daily_rollup"
PROFILE = "silver_profile"

# The roll-ups are independent, so their jobs are submitted together: one's last
# tasks do not leave the cluster idle before the next one starts.
JOBS_AT_ONCE = 4


@dataclass
class PipelineResult:
    rows_loaded: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    column_tests: list = field(default_factory=list)
    checks: list = field(default_factory=list)
    total_revenue: object = None


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Raw orders stored as Parquet in types of their own, in the bronze layout."""
    return as_bronze(spark.read.parquet(path))


def build_silver(lake: Lake) -> int:
    """Rebuild silver from all of bronze; returns its row count."""
    return lake.replace_silver(clean_orders(lake.bronze()), lake.bronze_marks())


def _at_once(tasks: dict[str, Callable[[], int]]) -> dict[str, int]:
    with ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
        pending = {name: jobs.submit(task) for name, task in tasks.items()}
        return {name: job.result() for name, job in pending.items()}


def _replace_all(lake: Lake, frames: dict[str, DataFrame]) -> dict[str, int]:
    return _at_once({name: partial(lake.replace, name, frame) for name, frame in frames.items()})


# -- derived from silver month by month ---------------------------------------


def _daily(staging: DataFrame) -> DataFrame:
    daily = marts.daily_sales(staging)
    return daily.withColumn(MONTH_KEY, month_key("sale_date")).hint("rebalance", MONTH_KEY)


def _profile(staging: DataFrame) -> DataFrame:
    tested = NOT_NULL[SILVER_TABLE] + NOT_NULL["stg_orders"]
    return quality.orders_profile(staging, tested, month_key("order_date")).hint("rebalance", MONTH_KEY)


#: Table -> its rows, with the month's key, from the staging rows of some months.
DERIVED: dict[str, Callable[[DataFrame], DataFrame]] = {
    PARTIALS: partials.by_month,
    DAILY: _daily,
    PROFILE: _profile,
}


@cache
def _derived_schema(spark: SparkSession, name: str) -> StructType:
    return DERIVED[name](stg_orders(spark.createDataFrame([], SILVER))).drop(MONTH_KEY).schema


def derived(lake: Lake, name: str) -> MonthlyTable:
    return lake.monthly(name, _derived_schema(lake.spark, name))


def refresh(lake: Lake, names: Iterable[str] = tuple(DERIVED), rebuild: bool = False) -> dict[str, list[str]]:
    """Bring tables derived from silver in step with it; returns the months that each one made again.

    A month is made again where silver has another build of it than the one it was
    made from; only such months of silver are read.
    """
    silver = lake.silver_months
    marks, done, tasks = silver.marks(), {}, {}
    for name in names:
        table = derived(lake, name)
        done[name] = sorted(marks) if rebuild else table.stale(marks)
        if done[name] or rebuild:
            rows = DERIVED[name](stg_orders(silver.read(done[name])))
            tasks[name] = partial(table.replace, rows, marks, None if rebuild else done[name])
    _at_once(tasks)
    return done


def _with_recency(customers: DataFrame, as_of: date) -> DataFrame:
    """Recency counted to another day than when the roll-up was stored."""
    return customers.withColumn("recency_days", F.expr(f"datediff(DATE '{as_of}', last_order_date)"))


def build_marts(lake: Lake, as_of: date, rebuild: bool = False) -> dict[str, int]:
    """The roll-ups of silver, merged from the partial sums of its months."""
    refresh(lake, rebuild=rebuild)
    sums = derived(lake, PARTIALS).read()
    rows = _replace_all(
        lake,
        {
            CUSTOMER_ROLLUP: partials.by_customer(sums, as_of),
            "mart_daily_sales": derived(lake, DAILY).read(),
            "mart_category_metrics": partials.by_category(sums),
            "mart_city_metrics": partials.by_city(sums),
        },
    )
    return rows | build_customer_marts(lake, as_of)


def build_customer_marts(lake: Lake, as_of: date) -> dict[str, int]:
    """The customer mart from the stored roll-up, with recency counted to ``as_of``."""
    name = "mart_customer_segments"
    customers = _with_recency(lake.table(CUSTOMER_ROLLUP), as_of)
    return {name: lake.replace(name, marts.customer_segments_columns(customers))}


def build_gold_segments(lake: Lake, as_of: date) -> dict[str, int]:
    name = "gold_customer_segments"
    customers = _with_recency(lake.table(CUSTOMER_ROLLUP), as_of)
    return {name: lake.replace(name, gold.customer_segments_columns(customers))}


def build_gold(lake: Lake, as_of: date) -> dict[str, int]:
    customers = lake.table(CUSTOMER_ROLLUP)
    return build_gold_segments(lake, as_of) | _replace_all(
        lake,
        {
            "gold_customer_spend_tiers": gold.customer_spend_tiers_columns(customers),
            "gold_daily_sales": gold.daily_sales_columns(lake.table("mart_daily_sales")),
            "gold_category_metrics": gold.category_metrics_columns(lake.table("mart_category_metrics")),
            "gold_city_metrics": gold.city_metrics_columns(lake.table("mart_city_metrics")),
        },
    )


def fresh_profile(lake: Lake) -> DataFrame:
    """The profile of silver as it is now."""
    refresh(lake, [PROFILE])
    return derived(lake, PROFILE).read()


def column_test_results(lake: Lake, categories: tuple[str, ...] = ACCEPTED_CATEGORIES) -> DataFrame:
    """All column tests. Silver is read for its keys only; the rest is in its profile."""
    # Staging has every silver column, so one frame serves both models.
    staging = stg_orders(lake.silver())
    tables = {SILVER_TABLE: staging, "stg_orders": staging}
    tables.update({name: lake.table(name) for name in MARTS})
    profiles = dict.fromkeys((SILVER_TABLE, "stg_orders"), fresh_profile(lake))
    return quality.run_column_tests(tables, all_tests(categories), profiles)


def check_results(lake: Lake, expected_segments: int = len(SEGMENTS)) -> DataFrame:
    profile = fresh_profile(lake)
    return quality.union_all(
        [
            quality.profiled_expectations(profile),
            quality.reconciliation(
                profile,
                lake.table("gold_category_metrics"),
                lake.table("gold_city_metrics"),
                lake.table("gold_customer_segments"),
                expected_segments,
            ),
        ]
    )


def summary(lake: Lake) -> DataFrame:
    """Row count, layer and description of every stored table."""
    return layer_row_counts(
        (layer, name, lake.table(name), description) for name, (layer, description) in TABLES.items()
    )


def build_layers(lake: Lake, as_of: date, rebuild: bool = False) -> dict[str, int]:
    """Bring silver, marts and gold in step with bronze; returns all row counts."""
    marks, silver = lake.bronze_marks(), lake.silver_months
    if rebuild or not silver.version():
        build_silver(lake)
    elif stale := silver.stale(marks):
        lake.replace_silver(clean_orders(lake.bronze_of_months(stale)), marks, stale)
    state = lake.state()
    if rebuild or state is None or state["silver"] != silver.version():
        rows = {SILVER_TABLE: lake.silver().count()} | build_marts(lake, as_of, rebuild) | build_gold(lake, as_of)
    elif state["as_of"] != as_of:
        rows = state["rows"] | build_customer_marts(lake, as_of) | build_gold_segments(lake, as_of)
    else:
        return state["rows"]
    lake.save_state(rows, as_of)
    return rows


STAGES = ("bronze", "silver", "marts", "gold", "tests", "checks")


def run(
    spark: SparkSession,
    source: DataFrame | None,
    base: str,
    load: str = "incremental",
    as_of: date | None = None,
    categories: tuple[str, ...] = ACCEPTED_CATEGORIES,
    expected_segments: int = len(SEGMENTS),
    rebuild: bool = False,
    database: str | None = None,
    partitions: int | None = None,
) -> PipelineResult:
    """Load a batch and bring everything above bronze in step under ``base``.

    ``rebuild`` makes all tables anew. ``database`` keeps catalog tables pointed at the
    new versions. ``partitions`` sets the session's shuffle partitions. Raises
    ``QualityGateError`` when a column test or check fails; the tables are left in place
    for inspection.
    """
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    # One date for all tables, also when the run passes midnight.
    as_of = as_of or spark.sql("SELECT current_date() AS today").first()["today"]
    lake = Lake(spark, base)
    result = PipelineResult()
    result.rows_loaded = load_bronze(lake, as_bronze(source), load)
    result.rows = build_layers(lake, as_of, rebuild)
    if database:
        from orderloom.plans import names

        names.publish(lake, database)
    result.column_tests = quality.gate(column_test_results(lake, categories))
    result.checks = quality.gate(check_results(lake, expected_segments))
    result.total_revenue = quality.total_revenue(lake.table("gold_category_metrics")).first()["total_revenue"]
    return result


def run_stage(
    spark: SparkSession,
    stage: str,
    base: str,
    source: DataFrame | None = None,
    load: str = "incremental",
    as_of: date | None = None,
    categories: tuple[str, ...] = ACCEPTED_CATEGORIES,
    expected_segments: int = len(SEGMENTS),
) -> dict[str, int]:
    """One stage alone over the stored tables; returns rows per table, or checks passed.

    Silver, marts and gold are rebuilt in full here. Tests and checks see silver as it
    is, also where marts and gold are older.
    """
    lake = Lake(spark, base)
    as_of = as_of or spark.sql("SELECT current_date() AS today").first()["today"]
    if stage == "bronze":
        return {BRONZE_TABLE: load_bronze(lake, as_bronze(source), load)}
    if stage == "silver":
        return {SILVER_TABLE: build_silver(lake)}
    if stage == "marts":
        return build_marts(lake, as_of, rebuild=True)
    if stage == "gold":
        return build_gold(lake, as_of)
    if stage == "tests":
        return {"column_tests": len(quality.gate(column_test_results(lake, categories)))}
    if stage == "checks":
        return {"checks": len(quality.gate(check_results(lake, expected_segments)))}
    raise ValueError(f"stage {stage!r} is none of {', '.join(STAGES)}")


def store_reports(lake: Lake) -> dict[str, int]:
    """Write every report to a table of its own; returns paths and row counts."""
    stored = {}
    for title, frame in report_book(lake).items():
        name = "report_" + title.replace(" ", "_")
        rows = lake.replace(name, frame)
        stored[lake.path(name)] = rows
    return stored


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Load a batch of orders and rebuild the tables above it.")
    parser.add_argument("--source", help="Parquet folder of raw orders (for the bronze stage and the whole run)")
    parser.add_argument("--base", required=True, help="folder that holds the tables")
    parser.add_argument("--stage", choices=(*STAGES, "all"), default="all", help="one stage alone, or all")
    parser.add_argument("--load", choices=LOAD_MODES, default="incremental", help="how the batch enters bronze")
    parser.add_argument("--rebuild", action="store_true", help="make silver and all above it anew")
    parser.add_argument("--as-of", type=date.fromisoformat, help="day recency counts to (today)")
    parser.add_argument("--category", action="append", help="an accepted category; repeat (the declared list)")
    parser.add_argument("--segments", type=int, default=len(SEGMENTS), help="number of segments that must be present")
    parser.add_argument("--publish", metavar="DATABASE", help="keep catalog tables of this database current")
    parser.add_argument("--reports", action="store_true", help="store the reports as well")
    args = parser.parse_args(argv)
    if not args.source and args.stage in ("all", "bronze"):
        parser.error("--source is needed to load bronze")
    categories = tuple(args.category or ACCEPTED_CATEGORIES)
    spark = build_session("orderloom-pipeline")
    lake = Lake(spark, args.base)
    size = stored_bytes(spark, lake.path(BRONZE_TABLE)) + (stored_bytes(spark, args.source) if args.source else 0)
    partitions = shuffle_partitions(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = read_orders(spark, args.source) if args.source else None
    try:
        if args.stage != "all":
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            done = run_stage(spark, args.stage, args.base, source, args.load, args.as_of, categories, args.segments)
            for name, rows in done.items():
                print(f"{name}: {rows}")
            return 0
        result = run(
            spark, source, args.base, args.load, args.as_of, categories, args.segments, args.rebuild, args.publish, partitions
        )
    except quality.QualityGateError as failure:
        print(f"quality gate: {failure}", file=sys.stderr)
        return 1
    print(f"loaded {result.rows_loaded} rows, total revenue {result.total_revenue}")
    summary(lake).show(len(TABLES), truncate=False)
    if args.reports:
        for path, rows in store_reports(lake).items():
            print(f"{path}: {rows} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
