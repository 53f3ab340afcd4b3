"""The ``events`` table reshaped into code-hosting events.

Every event becomes one raw row and each tenth event a second copy. The rules are
shared by both engines; they produce, on purpose, duplicate copies (later, tied,
without ingest time), copies whose newest form is invalid, null and blank actors,
unwatched types, decimal, over-long and junk numbers, times of day, years and junk times. No event is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (column, SQL expression); {iso:x} renders a timestamp as ISO text.
RULES = [
    ("event_id", "CASE WHEN n % 509 = 0 THEN NULL ELSE CAST(n AS STRING) END"),
    (
        "event_type",
        "CASE WHEN n % 97 = 0 OR (c = 1 AND n % 210 = 10) THEN NULL"
        " WHEN n % 89 = 0 THEN 'GollumEvent'"
        " WHEN et = 'click' THEN 'WatchEvent' WHEN et = 'view' THEN 'PushEvent'"
        " WHEN et = 'purchase' THEN 'PullRequestEvent'"
        " WHEN et = 'signup' AND n % 2 = 0 THEN 'ForkEvent' WHEN et = 'signup' THEN 'CreateEvent'"
        " WHEN n % 3 = 0 THEN 'IssuesEvent' WHEN n % 3 = 1 THEN 'ReleaseEvent'"
        " ELSE 'IssueCommentEvent' END",
    ),
    (
        "action",
        "CASE WHEN et = 'purchase' THEN"
        " CASE n % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'synchronize' END END",
    ),
    (
        "actor",
        "CASE WHEN n % 101 = 0 THEN NULL WHEN n % 103 = 0 THEN ''"
        " ELSE concat('user_', CAST(user_id AS STRING)) END",
    ),
    ("org", "CASE WHEN k % 4 = 0 THEN concat('org_', CAST(k % 5 AS STRING)) END"),
    (
        "repo_name",
        "CASE WHEN n % 107 = 0 THEN NULL WHEN k = 99 THEN 'orphan'"
        " ELSE concat('owner_', CAST(k % 10 AS STRING), '/repo_', CAST(k AS STRING)) END",
    ),
    (
        "language",
        "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Python' WHEN 2 THEN 'Go'"
        " WHEN 3 THEN 'Rust' ELSE 'C' END",
    ),
    (
        "stars",
        "CASE WHEN n % 113 = 0 THEN 'n/a' WHEN n % 337 = 0 THEN '1e3' WHEN n % 17 = 0 THEN"
        " concat(CAST(k * 100 + n % 50 + c AS STRING), CASE WHEN n % 2 = 0 THEN '.0' ELSE '.5' END)"
        " ELSE CAST(k * 100 + n % 50 + c AS STRING) END",
    ),
    (
        "forks",
        "CASE WHEN n % 331 = 0 THEN '99999999999999999999' ELSE CAST(k * 10 + n % 7 AS STRING) END",
    ),
    ("open_issues", "CAST(n % 13 AS STRING)"),
    ("description", "CASE WHEN k % 3 = 0 THEN NULL ELSE concat('repo ', CAST(k AS STRING)) END"),
    ("is_tracked", "(k < 10)"),
    (
        "text_content",
        "CASE WHEN et = 'view' THEN"
        " concat('fix ', CAST(n AS STRING), ' | add ', CAST(k AS STRING))"
        " WHEN et = 'purchase' AND n % 5 <> 0 THEN concat('PR ', CAST(n AS STRING))"
        " WHEN et = 'error' THEN '' END",
    ),
    (
        "commit_count",
        "CASE WHEN et = 'view' THEN CASE WHEN n % 3 = 0 THEN concat(CAST(n % 21 AS STRING), '.0')"
        " ELSE CAST(n % 21 AS STRING) END END",
    ),
    ("pr_merged", "CASE WHEN et = 'purchase' AND n % 7 <> 0 THEN (n % 3 = 1 AND n % 2 = 0) END"),
    ("pr_number", "CASE WHEN et = 'purchase' THEN CAST(k * 10 + n % 10 AS STRING) END"),
    ("issue_number", "CASE WHEN et = 'error' AND n % 3 = 0 THEN CAST(n % 500 AS STRING) END"),
    (
        "ref_type",
        "CASE WHEN et = 'signup' AND n % 2 = 1 THEN"
        " CASE WHEN n % 4 = 1 THEN 'branch' ELSE 'tag' END END",
    ),
    ("ref_name", "CASE WHEN et = 'signup' AND n % 2 = 1 THEN concat('ref-', CAST(k AS STRING)) END"),
    (
        "created_at",
        "CASE WHEN n % 109 = 0 THEN 'garbage' WHEN n % 311 = 0 THEN '10:30' WHEN n % 313 = 0 THEN '2024' WHEN n % 211 = 0 THEN '1999-12-31T23:00:00Z'"
        " ELSE {iso:ts} END",
    ),
    (
        "ingested_at",
        "CASE WHEN c = 1 AND n % 20 = 0 THEN NULL"
        " WHEN c = 1 AND n % 30 = 10 THEN {iso:ts + INTERVAL '1' DAY}"
        " ELSE {iso:ts + INTERVAL '5' SECOND} END",
    ),
    ("date_partition", "CAST(ts AS DATE)"),
]

# The run's processing time, fixed so both engines agree.
PROCESSED_AT = "2024-02-01 00:30:00"
AS_OF = "2024-01-30"

_ISO = {
    "spark": lambda x: f"date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "duckdb": lambda x: f"strftime({x}, '%Y-%m-%dT%H:%M:%SZ')",
}


def _render(expression: str, dialect: str) -> str:
    head, token, rest = expression.partition("{iso:")
    if not token:
        return expression
    inner, _, tail = rest.partition("}")
    return head + _ISO[dialect](inner) + _render(tail, dialect)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flat events, ``c`` being the copy index; one scan, copies made in place."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id AS n",
        "CAST(ts AS TIMESTAMP) AS ts",
        "user_id",
        "event_type AS et",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
        "explode(IF(event_id % 10 = 0, array(0, 1), array(0))) AS c",
    )
    return base.selectExpr(*[f"{_render(e, 'spark')} AS {name}" for name, e in RULES], "c")


RAW_SQL = (
    "base AS (SELECT event_id AS n, ts, user_id, event_type AS et,"
    " CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events),\n"
    "copies AS (SELECT *, 0 AS c FROM base UNION ALL SELECT *, 1 AS c FROM base WHERE n % 10 = 0),\n"
    "raw AS (SELECT "
    + ", ".join(f"{_render(e, 'duckdb')} AS {name}" for name, e in RULES)
    + ", c FROM copies)"
)
