"""Data-quality checks."""

import pytest

from forgelake.operators.metrics import dedup_counts, rows_per_date
from forgelake.operators.quality import (
    RAW_CHECKS,
    WARN,
    accepted_values,
    at_least,
    check_table,
    not_null,
    require_passed,
    unique,
)
from forgelake.plans.report import run_report


def by_check(report):
    return {(r.column_name, r.check_name): (r.failures, r.status) for r in report.collect()}


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", -1, None), ("a", None, "y"), ("b", 2, "x"), (None, 3, "z"), (None, 4, "x")],
        "k string, n int, v string",
    )


def test_failures_and_severity(table):
    report = check_table(
        "t",
        table,
        [not_null("k"), unique("k"), unique("n"), accepted_values("v", ["x", "y"], WARN), at_least("n", 0),
         not_null("n", WARN), at_least("n", -5)],
    )
    assert {(r.column_name, r.check_name, r.severity, r.failures, r.status) for r in report.collect()} == {
        ("k", "not_null", "error", 2, "fail"),
        ("k", "unique", "error", 1, "fail"),
        ("n", "unique", "error", 0, "pass"),
        ("v", "accepted_values", "warn", 1, "warn"),
        ("n", "accepted_range", "error", 1, "fail"),
        ("n", "not_null", "warn", 1, "warn"),
        ("n", "accepted_range", "error", 0, "pass"),
    }


def test_nulls_pass_accepted_values_only(raw_rows):
    report = by_check(check_table("raw", raw_rows({"event_id": "1", "event_type": None}), RAW_CHECKS))
    assert report[("event_type", "accepted_values")] == (0, "pass")
    assert report[("event_type", "not_null")] == (1, "warn")


def test_empty_table_passes(table):
    report = check_table("t", table.where("false"), [not_null("k"), unique("k"), at_least("n", 1)])
    assert {r.status for r in report.collect()} == {"pass"}


def test_only_errors_raise(table):
    require_passed(check_table("t", table, [not_null("k", WARN), unique("n")]))
    with pytest.raises(ValueError, match="t.k not_null: 2"):
        require_passed(check_table("t", table, [not_null("k")]))


def test_report_status(spark, table):
    def status(*checks):
        rows = run_report(spark, "2024-01-01", {"load": 6}, check_table("t", table, list(checks))).collect()
        assert rows[0].asDict() == {"run_date": "2024-01-01", "stage": "load", "rows": 6, "status": "done"}
        return rows[1].status

    assert status(not_null("k")) == "failed"
    assert status(not_null("k", WARN)) == "passed with warnings"
    assert status(unique("n")) == "passed"


def test_counts(table, spark):
    assert tuple(dedup_counts(table, ["k"]).first()) == (6, 3, 3)
    dated = spark.sql("SELECT DATE'2024-01-02' AS date, id FROM range(3)")
    rows = rows_per_date(dated, "2024-01-01", "2024-01-02").collect()
    assert {str(r.date): (r.rows, r.missing) for r in rows} == {
        "2024-01-01": (0, True), "2024-01-02": (3, False),
    }
