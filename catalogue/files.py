"""Queries that write zones, tables or extracts and read them back."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.adapter import AS_OF, PROCESSED_AT, RAW_SQL, raw_events
from catalogue.models import (
    CONTRIBUTORS_SQL,
    ENRICHED_SQL,
    REPOS_SQL,
    STG_SQL,
    enriched,
    stg,
)
from catalogue.payloads import api_events
from catalogue.records import FALLBACK, RECORDS_SQL, records, topics_as_json
from catalogue.registry import query, written
from forgelake.functions import int_or_null
from forgelake.operators.enrich import coerce_types
from forgelake.operators.quality import MART_CHECKS, RAW_CHECKS, check_table, check_tables
from forgelake.plans import batch, exports, marts
from forgelake.plans.publish import publish
from forgelake.plans.report import run_report as build_report
from forgelake.schemas import COUNT_COLUMNS, RAW_TABLE
from forgelake.settings import Settings, scratch_dir
from forgelake.sinks.files import append_raw, overwrite_partitions, write_csv, write_exports
from forgelake.sinks.warehouse import (
    by_name,
    create_tables,
    load_rows,
    raw_table_name,
    require_bigint,
    widened,
)
from forgelake.sources.files import (
    dates_touched_since,
    read_parquet_tree,
    read_processed_dates,
    read_raw_dates,
    read_seed_csv,
    with_path_column,
)
from forgelake.sources.tables import lower_columns, read_table

FIRST, LAST = "1999-01-01", "2100-01-01"


def _fallback():
    return F.lit(FALLBACK).cast("timestamp")


def _processed_at():
    return F.lit(PROCESSED_AT).cast("timestamp")


def workspace(spark: SparkSession, label: str) -> Settings:
    """Settings of a lake of its own, databases included."""
    root = scratch_dir(spark, label)
    tag = PurePosixPath(root).name.replace("-", "_")
    return replace(
        Settings(root=root),
        raw_database=f"raw_{tag}",
        staging_database=f"staging_{tag}",
        mart_database=f"mart_{tag}",
    )


_ROUTED_SQL = f"""{RECORDS_SQL},
routed AS (
  SELECT *, strftime(ifnull(TRY_CAST(created_at AS TIMESTAMP), TIMESTAMP '{FALLBACK}'),
    '%Y-%m-%d') AS date,
    strftime(ifnull(TRY_CAST(created_at AS TIMESTAMP), TIMESTAMP '{FALLBACK}'), '%H') AS hour
  FROM records)"""


@query(
    f"WITH {ENRICHED_SQL} SELECT event_id, event_type, nullif(action, '') AS action,"
    " nullif(actor, '') AS actor, org, repo_name, language,"
    + ",".join(f" TRY_CAST({c} AS BIGINT) AS {c}" for c in COUNT_COLUMNS)
    + ", description, is_tracked, nullif(text_content, '') AS text_content, pr_merged, is_merge,"
    " has_text, nullif(pr_state, '') AS pr_state, created_at, ingested_at FROM enriched"
)
def seed_csv_scan(spark, sf_dir):
    seed = enriched(spark, sf_dir).drop("c", "ref_type", "ref_name", "processed_at", "date_partition")
    path = write_csv(seed, scratch_dir(spark, "seed") + "/csv")
    return read_seed_csv(spark, path, seed.columns)


@query(
    f"WITH {_ROUTED_SQL} SELECT * REPLACE (ifnull(event_type, 'Unknown') AS event_type)"
    " FROM routed WHERE date BETWEEN '2024-01-03' AND '2024-01-05'"
)
def raw_date_scan(spark, sf_dir):
    raw_zone = workspace(spark, "rawscan").raw_zone
    append_raw(records(spark, sf_dir), raw_zone, _fallback())
    return topics_as_json(read_raw_dates(spark, raw_zone, "2024-01-03", "2024-01-05"))


@query(
    f"WITH {RAW_SQL} SELECT event_id, repo_name, CASE WHEN c = 0 THEN org END AS org FROM raw"
)
def parquet_tree_union(spark, sf_dir):
    raw = raw_events(spark, sf_dir).select("event_id", "repo_name", "org", "c")
    root = scratch_dir(spark, "tree")
    raw.where("c = 0").drop("c").write.parquet(f"{root}/a/first")
    raw.where("c = 1").drop("c", "org").write.parquet(f"{root}/b/c/second")
    return read_parquet_tree(spark, root, raw.drop("c").schema)


@query(f"WITH {RAW_SQL} SELECT event_id, c, event_type FROM raw")
def path_value_scan(spark, sf_dir):
    raw = raw_events(spark, sf_dir).select("event_id", "c", "event_type")
    root = scratch_dir(spark, "paths") + "/data"
    raw.write.partitionBy("event_type").parquet(root)
    files = read_parquet_tree(spark, root, raw.drop("event_type").schema)
    return with_path_column(files, "event_type")


@query(f"WITH {RAW_SQL} SELECT event_id, actor, c FROM raw")
def lower_case_columns(spark, sf_dir):
    raw = raw_events(spark, sf_dir).select("event_id", "actor", "c")
    return lower_columns(written(raw.toDF(*[c.upper() for c in raw.columns]), "upper"))


@query(
    f"WITH {REPOS_SQL} SELECT repo_name, repo_owner, language, stars, forks, open_issues,"
    " total_events, total_pushes, total_pr_events, total_stars, unique_contributors, is_tracked,"
    " last_seen_at FROM repos ORDER BY total_events DESC, repo_name LIMIT 200"
)
def csv_round_trip(spark, sf_dir):
    top = exports.top_repos(marts.dim_repos(stg(spark, sf_dir)))
    path = write_csv(top, scratch_dir(spark, "csv") + "/dim_repos", single_file=True)
    return spark.read.schema(top.schema).option("header", True).option("escape", '"').csv(path)


def _unnamed_by_id(rows: DataFrame, named: str, *kept: str) -> DataFrame:
    """Rows without an id are taken for copies of one; which one stays is not determined, so of it
    only ``kept`` is compared."""
    blank = [F.col(c) if c in kept else F.when(F.expr(named), F.col(c)).alias(c) for c in rows.columns]
    return rows.select(*blank)


_PROCESSED_SQL = f"""{_ROUTED_SQL},
kept AS (
  SELECT * REPLACE (ifnull(event_type, 'Unknown') AS event_type) FROM routed QUALIFY row_number() OVER (
    PARTITION BY date, event_id ORDER BY ingested_at DESC NULLS LAST) = 1)"""


@query(
    f"WITH {_PROCESSED_SQL} SELECT event_id, repo_name, actor, date, event_type,"
    " ifnull(commit_count, 0) AS commit_count, ifnull(pr_number, 0) AS pr_number,"
    " event_type = 'PullRequestEvent' AND ifnull(pr_merged, FALSE) AS is_merge,"
    " ifnull(text_content, '') <> '' AS has_text,"
    " CASE WHEN event_type <> 'PullRequestEvent' THEN '' WHEN pr_merged THEN 'merged'"
    " WHEN action = 'closed' THEN 'closed' ELSE 'open' END AS pr_state,"
    " TRY_CAST(created_at AS TIMESTAMP) AS created_at,"
    f" TIMESTAMP '{PROCESSED_AT}' AS processed_at FROM kept WHERE event_id IS NOT NULL"
    " UNION ALL SELECT NULL, NULL, NULL, date, NULL, NULL, NULL, NULL, NULL, NULL, NULL,"
    f" TIMESTAMP '{PROCESSED_AT}' FROM kept WHERE event_id IS NULL"
)
def processed_backfill(spark, sf_dir):
    """A range of dates processed, then some of them again: nothing is doubled."""
    lake = workspace(spark, "backfill")
    append_raw(records(spark, sf_dir), lake.raw_zone, _fallback())
    batch.process_dates(spark, lake, FIRST, LAST, _processed_at())
    batch.process_dates(spark, lake, "2024-01-05", "2024-01-08", _processed_at())
    rows = read_processed_dates(spark, lake.processed_zone, FIRST, LAST).select(
        "event_id", "repo_name", "actor", "date", "event_type", "commit_count", "pr_number",
        "is_merge", "has_text", "pr_state", "created_at", "processed_at",
    )
    return _unnamed_by_id(rows, "event_id IS NOT NULL", "event_id", "date", "processed_at")


@query(
    f"WITH {RAW_SQL}, first_day AS (SELECT min(date_partition) AS d FROM raw)"
    " SELECT event_id, c, stars, CAST(date_partition AS VARCHAR) AS date_partition,"
    " date_partition = (SELECT d FROM first_day) AS reloaded FROM raw"
)
def partition_overwrite(spark, sf_dir):
    """All dates written, then the first one again with a mark: only it changes."""
    path = scratch_dir(spark, "overwrite") + "/data"
    rows = raw_events(spark, sf_dir).select("event_id", "c", "stars", "date_partition")
    overwrite_partitions(rows.withColumn("reloaded", F.lit(False)), path, ["date_partition"])
    first = rows.agg(F.min("date_partition").alias("date_partition"))
    again = rows.join(first, "date_partition", "left_semi")
    overwrite_partitions(again.withColumn("reloaded", F.lit(True)), path, ["date_partition"])
    return spark.read.parquet(path)


def _loadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows that meet the raw table's NOT NULL columns."""
    rows = coerce_types(enriched(spark, sf_dir))
    return rows.where("event_id IS NOT NULL AND repo_name IS NOT NULL")


_LOADED_SQL = f"""{ENRICHED_SQL},
loaded AS (
  SELECT event_id, event_type, action, actor, org, repo_name, CAST(NULL AS VARCHAR) AS repo_owner,
    language, {", ".join(f"ifnull(TRY_CAST({c} AS BIGINT), 0) AS {c}" for c in COUNT_COLUMNS)},
    description, is_tracked, CAST(NULL AS VARCHAR) AS topics, text_content,
    ifnull(pr_merged, FALSE) AS pr_merged, ref_type, ref_name, is_merge, has_text, pr_state,
    TRY_CAST(created_at AS TIMESTAMP) AS created_at,
    TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at, processed_at,
    CAST(date_partition AS VARCHAR) AS date_partition
  FROM enriched)"""


@query(
    f"WITH {_LOADED_SQL} SELECT * FROM loaded WHERE event_id IS NOT NULL AND repo_name IS NOT NULL"
)
def partition_replace_idempotent(spark, sf_dir):
    """The same dates loaded twice into the raw table."""
    lake = workspace(spark, "load")
    create_tables(spark, lake)
    for _ in range(2):
        load_rows(_loadable(spark, sf_dir), raw_table_name(lake))
    return read_table(spark, raw_table_name(lake))


@query(f"WITH {_LOADED_SQL} SELECT * REPLACE (CAST(NULL AS VARCHAR) AS org) FROM loaded")
def load_by_name(spark, sf_dir):
    """Upper-case names in reverse order, one column missing and one too many."""
    rows = coerce_types(enriched(spark, sf_dir)).drop("org")
    shuffled = rows.select(*[F.col(c).alias(c.upper()) for c in reversed(rows.columns)])
    return by_name(shuffled, RAW_TABLE)


@query(
    f"WITH {RAW_SQL} SELECT event_id, c,"
    + ",".join(f" TRY_CAST({c} AS BIGINT) AS {c}" for c in COUNT_COLUMNS)
    + " FROM raw"
)
def widened_scan(spark, sf_dir):
    """Counts stored as INT read as BIGINT without a rewrite."""
    narrow = raw_events(spark, sf_dir).select(
        "event_id", "c", *[int_or_null(c).cast("int").alias(c) for c in COUNT_COLUMNS]
    )
    path = scratch_dir(spark, "narrow") + "/data"
    narrow.write.parquet(path)
    wide = spark.read.schema(widened(narrow.schema)).parquet(path)
    require_bigint(wide)
    return wide


@query(
    f"WITH {RAW_SQL}, kept AS (SELECT * REPLACE (ifnull(event_type, '') AS event_type)"
    " FROM raw WHERE event_id IS NOT NULL AND c = 0) SELECT event_id, event_type,"
    " ifnull(actor, '') AS actor, ifnull(repo_name, '') AS repo_name,"
    " event_type = 'PullRequestEvent' AND ifnull(pr_merged, FALSE) AS is_merge,"
    " CASE WHEN event_type = 'PullRequestEvent' THEN CASE WHEN pr_merged THEN 'merged'"
    " ELSE 'open' END END AS pr_state, CAST(0 AS BIGINT) AS stars, '[]' AS topics,"
    " ref_type, '2024-03-01' AS date FROM kept UNION ALL SELECT '', NULL, NULL, NULL, NULL, NULL, NULL, NULL,"
    " NULL, '2024-03-01' WHERE EXISTS (SELECT 1 FROM raw WHERE event_id IS NULL)"
)
def daily_fetch(spark, sf_dir):
    """Landed API pages to the processed zone of one date, fetched twice."""
    lake = workspace(spark, "daily")
    api_events(spark, sf_dir).write.json(lake.zone("landing"))
    for _ in range(2):
        batch.fetch_date(spark, lake, lake.zone("landing"), "2024-03-01")
    rows = read_processed_dates(spark, lake.processed_zone, "2024-03-01").select(
        "event_id", "event_type", "actor", "repo_name", "is_merge", "pr_state", "stars", "topics",
        "ref_type", "date",
    )
    return _unnamed_by_id(rows, "event_id <> ''", "event_id", "date")


_MART_COUNTS_SQL = (
    "SELECT 'fact_commits' AS mart, count(*) AS rows FROM stg WHERE event_type = 'PushEvent'"
    " UNION ALL SELECT 'fact_prs', count(*) FROM stg WHERE event_type = 'PullRequestEvent'"
    " UNION ALL SELECT 'dim_repos', count(DISTINCT repo_name) FROM stg"
    " UNION ALL SELECT 'dim_contributors', count(DISTINCT actor) FROM stg"
    " WHERE actor NOT IN ('', '[unknown]')"
)


@query(f"WITH {STG_SQL} {_MART_COUNTS_SQL}")
def published_marts(spark, sf_dir):
    published = publish(enriched(spark, sf_dir), workspace(spark, "marts"), ["c"])
    counts = [
        df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"))
        for name, df in published.items()
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@query(f"WITH {CONTRIBUTORS_SQL} SELECT * FROM contributors")
def published_contributors(spark, sf_dir):
    """The table form, rolled up from the rollup both dimensions share."""
    return publish(enriched(spark, sf_dir), workspace(spark, "actors"), ["c"])["dim_contributors"]


def _check_sql(table: str, column: str, check: str, severity: str, failing: str, source: str) -> str:
    bad = "warn" if severity == "warn" else "fail"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name,"
        f" '{severity}' AS severity, n AS failures,"
        f" CASE WHEN n = 0 THEN 'pass' ELSE '{bad}' END AS status"
        f" FROM (SELECT {failing} AS n FROM {source})"
    )


def _checks_sql(table: str, checks, source: str) -> list[str]:
    parts = []
    for c in checks:
        if c.kind == "unique":
            failing = "count(*)"
            src = (
                f"(SELECT {c.column} FROM {source} WHERE {c.column} IS NOT NULL"
                f" GROUP BY 1 HAVING count(*) > 1)"
            )
        else:
            src = source
            condition = {
                "not_null": lambda: f"{c.column} IS NULL",
                "accepted_values": lambda: f"{c.column} NOT IN ("
                + ", ".join(f"'{v}'" for v in c.argument)
                + ")",
                "accepted_range": lambda: f"{c.column} < {c.argument}",
            }[c.kind]()
            failing = f"count(*) FILTER ({condition})"
        parts.append(_check_sql(table, c.column, c.kind, c.severity, failing, src))
    return parts


_COMMITS_SQL = (
    "fact_commits AS (SELECT md5(event_id) AS commit_fact_key, event_id, repo_name,"
    " actor AS pushed_by, commit_count, created_at AS pushed_at, event_date FROM stg"
    " WHERE event_type = 'PushEvent')"
)
_PRS_SQL = (
    "fact_prs AS (SELECT md5(event_id) AS pr_fact_key, event_id, repo_name, action AS pr_action,"
    " CASE WHEN is_merge THEN 'merged' WHEN action = 'closed' THEN 'closed' ELSE 'open' END"
    " AS pr_status, created_at AS event_at FROM stg WHERE event_type = 'PullRequestEvent')"
)
_CONTRIBUTORS_CTE = CONTRIBUTORS_SQL[len(STG_SQL) :]
_ALL_MARTS_SQL = f"{REPOS_SQL}{_CONTRIBUTORS_CTE}, {_COMMITS_SQL}, {_PRS_SQL}"
_SOURCES = {
    "fact_commits": "fact_commits",
    "fact_prs": "fact_prs",
    "dim_repos": "repos",
    "dim_contributors": "contributors",
}


@query(
    f"WITH {_ALL_MARTS_SQL} "
    + " UNION ALL ".join(
        _checks_sql("raw_events", RAW_CHECKS, "raw")
        + [s for m in MART_CHECKS for s in _checks_sql(m, MART_CHECKS[m], _SOURCES[m])]
    )
)
def dq_report(spark, sf_dir):
    """Checks of the raw rows and of the published marts."""
    raw = enriched(spark, sf_dir)
    measured: dict[str, dict[str, int]] = {}
    published = publish(raw, workspace(spark, "checks"), ["c"], measured)
    return check_table("raw_events", raw, RAW_CHECKS).unionByName(
        check_tables(published, MART_CHECKS, measured)
    )


_DAILY_PUSHES_SQL = (
    "SELECT event_date, language FROM stg WHERE event_type = 'PushEvent'"
    f" AND event_date >= DATE '{AS_OF}' - 14 GROUP BY ALL"
)


@query(
    f"WITH {STG_SQL}, loaded AS (SELECT count(*) AS n FROM enriched WHERE event_id IS NOT NULL"
    f" AND repo_name IS NOT NULL), days AS ({_DAILY_PUSHES_SQL}),"
    f" marts AS ({_MART_COUNTS_SQL}) SELECT '2024-02-01' AS run_date, stage, rows, status FROM ("
    " SELECT 'load' AS stage, n AS rows, 'done' AS status FROM loaded"
    " UNION ALL SELECT mart, rows, 'done' FROM marts"
    " UNION ALL SELECT 'daily_pushes', count(*), 'done' FROM days"
    f" UNION ALL SELECT 'checks', {sum(len(c) for c in MART_CHECKS.values())}, 'passed')"
)
def run_report(spark, sf_dir):
    """Load, models, extracts and checks in a row, reported by stage."""
    lake = workspace(spark, "report")
    create_tables(spark, lake)
    load_rows(_loadable(spark, sf_dir), raw_table_name(lake))
    loaded = read_table(spark, raw_table_name(lake))
    published = publish(loaded, lake)
    paths = write_exports(exports.export_bundle(published, as_of=AS_OF), lake.zone("exports"))
    pushes = spark.read.option("header", True).csv(paths["fact_commits"])
    sized = {"load": loaded, **published, "daily_pushes": pushes}
    counts = {stage: df.count() for stage, df in sized.items()}
    checks = check_tables(published, MART_CHECKS)
    return build_report(spark, "2024-02-01", counts, checks)


@query(
    f"WITH {_ROUTED_SQL} SELECT DISTINCT date FROM routed WHERE language = 'Rust'"
)
def touched_dates(spark, sf_dir):
    """Dates reached by a second, late delivery."""
    raw_zone = workspace(spark, "touched").raw_zone
    rows = records(spark, sf_dir)
    append_raw(rows.where("language IS DISTINCT FROM 'Rust'"), raw_zone, _fallback())
    since = dt.datetime.now(dt.timezone.utc)
    append_raw(rows.where("language = 'Rust'"), raw_zone, _fallback())
    return dates_touched_since(spark, raw_zone, since)
