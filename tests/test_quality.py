import pytest

from orderloom.operators import quality
from orderloom.operators.quality import ColumnTest
from orderloom.plans import column_tests


@pytest.fixture(scope="module")
def table(spark):
    """A third of all rows share one key; one NULL key; one odd state."""
    return spark.sql(
        """SELECT CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 1 THEN NULL ELSE CONCAT('k', id) END AS k,
                  CASE WHEN id = 5 THEN 'odd' WHEN id = 6 THEN NULL ELSE 'fine' END AS state
           FROM range(3000)"""
    )


def test_null_counts(table):
    assert {tuple(r) for r in quality.null_counts(table, ["k", "state"]).collect()} == {("k", 1), ("state", 1)}


def test_duplicate_keys_ignore_nulls(table):
    assert [tuple(r) for r in quality.duplicate_keys(table, "k").collect()] == [("hot", 1000)]
    nulls = table.where("k IS NULL")
    assert quality.duplicate_keys(nulls.unionByName(nulls), "k").count() == 0


def test_unaccepted_values_let_null_pass(table):
    assert [tuple(r) for r in quality.unaccepted_values(table, "state", ["fine"]).collect()] == [("odd", 1)]
    assert quality.unaccepted_values(table, "state", ["fine", "odd"]).count() == 0


def test_every_test_reports_a_row(table):
    tests = [
        ColumnTest("not_null", "t", "k"),
        ColumnTest("unique", "t", "k"),
        ColumnTest("accepted_values", "t", "state", ("fine", "odd")),
        ColumnTest("not_null", "clean", "k"),
        ColumnTest("unique", "clean", "k"),
    ]
    tables = {"t": table, "clean": table.where("k <> 'hot'")}
    got = {(r["test"], r["model"]): (r["failures"], r["passed"]) for r in quality.run_column_tests(tables, tests).collect()}
    assert got == {
        ("not_null", "t"): (1, False),
        ("unique", "t"): (1, False),
        ("accepted_values", "t"): (0, True),
        ("not_null", "clean"): (0, True),
        ("unique", "clean"): (0, True),
    }


def test_models_of_one_frame_share_the_work(table):
    tests = [ColumnTest(kind, model, "k") for model in ("a", "b") for kind in ("not_null", "unique")]
    tests.append(ColumnTest("accepted_values", "b", "state", ("fine",)))
    got = quality.run_column_tests({"a": table, "b": table}, tests)
    assert {(r["test"], r["model"], r["failures"]) for r in got.collect()} == {
        ("not_null", "a", 1), ("not_null", "b", 1), ("unique", "a", 1), ("unique", "b", 1), ("accepted_values", "b", 1)
    }
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2


def test_values_with_quotes(spark):
    odd = spark.sql("SELECT \"it's\" AS v")
    assert quality.unaccepted_values(odd, "v", ["it's"]).count() == 0
    assert quality.unaccepted_values(odd, "v", ["a\\b"]).count() == 1


def test_unknown_test_is_refused(table):
    with pytest.raises(ValueError, match="sorted"):
        quality.run_column_tests({"t": table}, [ColumnTest("sorted", "t", "k")])


def test_declared_tests():
    tests = column_tests.all_tests()
    kinds = [t.test for t in tests]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (17, 7, 3)
    assert len(set(tests)) == 27


def test_scalar_checks_take_any_expected_value_and_fail_on_null(table):
    got = quality.scalar_checks(
        table,
        {
            "rows": ("count(*)", 3000),
            "wrong": ("count(*)", 1),
            "nothing": ("sum(CASE WHEN k = 'none' THEN 1 END)", 0),
        },
    )
    assert {r["check_name"]: (r["got"], r["passed"]) for r in got.collect()} == {
        "rows": (3000, True),
        "wrong": (3000, False),
        "nothing": (None, False),
    }


def test_zero_totals_fail_the_strict_form_only(spark):
    free = spark.sql("SELECT 1.00BD AS unit_price, 1 AS quantity, 'c' AS customer_id, 'shipped' AS status, 0.00BD AS total_amount")
    assert all(r["passed"] for r in quality.order_expectations(free).collect())
    failed = {r["check_name"] for r in quality.order_expectations(free, strict=True).collect() if not r["passed"]}
    assert failed == {"total_above_zero"}


def test_reconciliation_sees_stale_gold(spark):
    silver = spark.sql("SELECT * FROM VALUES ('a', 'x'), ('b', 'x'), ('b', NULL) AS t(category, city)")
    categories = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(category)")
    cities = spark.sql("SELECT * FROM VALUES ('x'), ('gone') AS t(city)")
    segments = spark.sql("SELECT * FROM VALUES ('VIP'), ('New'), ('New') AS t(customer_segment)")
    got = {r["check_name"]: tuple(r)[1:] for r in quality.reconciliation(silver, categories, cities, segments).collect()}
    assert got == {
        "categories_match_silver": (2, 2, True),
        "cities_match_silver": (2, 1, False),
        "all_segments_present": (2, 4, False),
    }
    two = quality.reconciliation(silver, categories, cities, segments, expected_segments=2)
    assert {r["check_name"] for r in two.collect() if not r["passed"]} == {"cities_match_silver"}


def test_fixed_counts(spark):
    categories = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(category)")
    segments = spark.sql("SELECT * FROM VALUES ('VIP'), ('New'), ('New') AS t(customer_segment)")
    got = {r["check_name"]: tuple(r)[1:] for r in quality.fixed_counts(categories, segments, expected_segments=2).collect()}
    assert got == {"category_count": (2, 9, False), "segment_count": (2, 2, True)}


def test_gate(table):
    good = quality.scalar_checks(table, {"rows": ("count(*)", 3000)})
    assert len(quality.gate(good)) == 1
    bad = quality.scalar_checks(table, {"rows": ("count(*)", 3000), "wrong": ("count(*)", 1), "also": ("count(*)", 2)})
    with pytest.raises(quality.QualityGateError, match="wrong") as failure:
        quality.gate(bad)
    assert sorted(r["check_name"] for r in failure.value.failed) == ["also", "wrong"]
