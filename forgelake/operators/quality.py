"""Data-quality checks as one report frame per table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.schemas import KNOWN_PR_ACTIONS, PR_STATUSES, WATCHED_TYPES

ERROR, WARN = "error", "warn"
REPORT_COLUMNS = ["table_name", "column_name", "check_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    column: str
    kind: str
    severity: str = ERROR
    argument: tuple | int | None = None


def not_null(column: str, severity: str = ERROR) -> Check:
    return Check(column, "not_null", severity)


def unique(column: str, severity: str = ERROR) -> Check:
    """Nulls are ignored; a failure is a value that occurs more than once."""
    return Check(column, "unique", severity)


def accepted_values(column: str, values: list[str], severity: str = ERROR) -> Check:
    """Nulls pass; a failure is a row."""
    return Check(column, "accepted_values", severity, tuple(values))


def at_least(column: str, minimum: int, severity: str = ERROR) -> Check:
    """Nulls pass; a failure is a row."""
    return Check(column, "accepted_range", severity, minimum)


RAW_CHECKS = [
    not_null("event_id"),
    unique("event_id", WARN),
    not_null("event_type", WARN),
    accepted_values("event_type", WATCHED_TYPES),
    not_null("repo_name"),
    not_null("created_at"),
    not_null("date_partition", WARN),
]
MART_CHECKS = {
    "fact_commits": [
        *[c(k) for k in ("commit_fact_key", "event_id") for c in (not_null, unique)],
        not_null("repo_name"),
        not_null("pushed_by"),
        not_null("commit_count"),
        at_least("commit_count", 0, WARN),
        not_null("pushed_at"),
        not_null("event_date"),
    ],
    "fact_prs": [
        *[c(k) for k in ("pr_fact_key", "event_id") for c in (not_null, unique)],
        not_null("repo_name"),
        not_null("pr_action"),
        accepted_values("pr_action", KNOWN_PR_ACTIONS, WARN),
        accepted_values("pr_status", PR_STATUSES),
        not_null("event_at"),
    ],
    "dim_repos": [
        *[c(k) for k in ("repo_key", "repo_name") for c in (not_null, unique)],
        not_null("language"),
        at_least("stars", 0),
    ],
    "dim_contributors": [
        *[c(k) for k in ("contributor_key", "actor") for c in (not_null, unique)],
        at_least("total_events", 1),
        at_least("repos_contributed_to", 1),
        not_null("first_seen_at"),
        not_null("last_seen_at"),
    ],
}


def _row_failures(check: Check) -> Column:
    c = F.col(check.column)
    failing = {
        "not_null": lambda: c.isNull(),
        "accepted_values": lambda: ~c.isin(list(check.argument)),
        "accepted_range": lambda: c < check.argument,
    }[check.kind]()
    return F.count_if(failing)


def row_measures(checks: list[Check]) -> list[Column]:
    """An aggregate per row check, for an observed write; see :func:`check_table`."""
    rows = [c for c in checks if c.kind != "unique"]
    return [_row_failures(c).alias(f"f{i}") for i, c in enumerate(rows)]


def _row_check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks of a table in one aggregate, turned into (index, failures) rows."""
    counts = df.agg(*row_measures(checks))
    pairs = [
        F.struct(F.lit(i).alias("i"), F.col(f"f{i}").alias("failures")) for i in range(len(checks))
    ]
    return counts.select(F.inline(F.array(*pairs)))


def _unique_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All uniqueness checks of a table in one scan: values are counted per check
    with a partial aggregate ahead of the shuffle, so a value repeated millions of
    times costs its reducer one row per map task."""
    values = [
        F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("v"))
        for i, c in enumerate(checks)
    ]
    repeated = (
        df.select(F.inline(F.array(*values)))
        .where("v IS NOT NULL")
        .groupBy("i", "v")
        .agg((F.count(F.lit(1)) > 1).alias("repeated"))
    )
    found = repeated.groupBy("i").agg(F.count_if("repeated").alias("failures"))
    return found


def check_table(
    name: str, df: DataFrame, checks: list[Check], measured: dict[str, int] | None = None
) -> DataFrame:
    """One report row per check. ``measured`` are the results of :func:`row_measures` where the
    table's own write took them; row checks then need no scan."""
    spark = df.sparkSession

    def noted(_: DataFrame, group: list[Check]) -> DataFrame:
        rows = [(i, measured.get(f"f{i}") or 0) for i in range(len(group))]
        return spark.createDataFrame(rows, "i int, failures bigint")

    parts = []
    for group, count in (
        ([c for c in checks if c.kind != "unique"], _row_check_counts if measured is None else noted),
        ([c for c in checks if c.kind == "unique"], _unique_counts),
    ):
        if not group:
            continue
        labels = spark.createDataFrame(
            [(i, name, c.column, c.kind, c.severity) for i, c in enumerate(group)],
            "i int, table_name string, column_name string, check_name string, severity string",
        )
        parts.append(labels.join(count(df, group), "i", "left"))
    failures = F.coalesce("failures", F.lit(0))
    status = F.when(failures == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("failures", failures).withColumn("status", status).select(REPORT_COLUMNS)


def check_tables(
    tables: dict[str, DataFrame],
    checks: dict[str, list[Check]],
    measured: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    taken = measured or {}
    reports = [check_table(n, tables[n], checks[n], taken.get(n)) for n in checks if n in tables]
    return reduce(DataFrame.unionByName, reports)


def require_passed(report: DataFrame) -> None:
    """Raise if an error-level check failed. Fetches at most one row per check."""
    failed = report.where("status = 'fail'").collect()
    if failed:
        listing = ", ".join(
            f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed
        )
        raise ValueError(f"data-quality checks failed: {listing}")
