"""Record-level queries over the adapted events: casts, lookups, counters, messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.adapter import RAW_SQL, raw_events
from catalogue.models import ENRICHED_SQL, enriched
from catalogue.registry import query
from forgelake.functions import (
    date_or_null,
    flag,
    int_or_null,
    int_or_zero,
    owner_or_blank,
    path_safe,
    repo_owner,
    surrogate_key,
    timestamp_or_null,
)
from forgelake.operators import enrich as enrichment
from forgelake.operators.lookup import (
    only_tracked,
    tracked_flag as is_listed,
    with_repo_meta,
    with_tracked_flag,
)
from forgelake.operators.metrics import ingest_counts, rows_per_date
from forgelake.operators.normalise import watched
from forgelake.schemas import EVENT, UNKNOWN_TYPE, WATCHED_TYPES
from forgelake.sinks.kafka import keyed_messages
from forgelake.streaming import ingest

TRACKED = ["owner_1/repo_1", "owner_2/repo_12", "owner_9/repo_99", "orphan"]
FALLBACK = "2024-02-15 07:45:00"
_TRACKED_SQL = ", ".join(f"'{r}'" for r in TRACKED)
_WATCHED_SQL = ", ".join(f"'{t}'" for t in WATCHED_TYPES)
_COUNTS = ["stars", "forks", "open_issues", "commit_count", "pr_number", "issue_number"]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapted events as the 23-column stream record."""
    raw = raw_events(spark, sf_dir)
    return raw.select(
        *[
            int_or_null(f.name).alias(f.name) if f.name in _COUNTS
            else owner_or_blank(F.col("repo_name")).alias(f.name) if f.name == "repo_owner"
            else F.array("language", "description").alias(f.name) if f.name == "topics"
            else F.col(f.name)
            for f in EVENT
        ]
    )


def topics_as_json(df: DataFrame) -> DataFrame:
    """The array column as JSON text, which both engines hand out alike."""
    return df.withColumn("topics", F.to_json("topics", {"ignoreNullFields": "false"}))


# The same record in SQL, topics as JSON text.
RECORDS_SQL = f"""{RAW_SQL},
records AS (
  SELECT event_id, event_type, action, actor, org, repo_name,
    CASE WHEN repo_name LIKE '%/%' THEN split_part(repo_name, '/', 1) ELSE '' END AS repo_owner,
    language, {", ".join(f"TRY_CAST({c} AS BIGINT) AS {c}" for c in _COUNTS[:3])}, description,
    CAST(to_json([language, description]) AS VARCHAR) AS topics,
    text_content, {", ".join(f"TRY_CAST({c} AS BIGINT) AS {c}" for c in _COUNTS[3:])}, pr_merged,
    ref_type, ref_name, is_tracked, created_at, ingested_at
  FROM raw)"""


@query(
    f"WITH {ENRICHED_SQL} SELECT event_id, c,"
    + ", ".join(f" ifnull(TRY_CAST({x} AS BIGINT), 0) AS {x}" for x in _COUNTS)
    + ", is_tracked, ifnull(pr_merged, FALSE) AS pr_merged, is_merge, has_text,"
    " TRY_CAST(created_at AS TIMESTAMP) AS created_at,"
    " TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at, processed_at,"
    " CASE WHEN description IS NULL THEN '[]'"
    " ELSE CAST(to_json([language, description]) AS VARCHAR) END AS topics FROM enriched"
)
def coerce_types(spark, sf_dir):
    topics = F.when(F.col("description").isNotNull(), F.array("language", "description"))
    coerced = enrichment.coerce_types(enriched(spark, sf_dir).withColumn("topics", topics))
    return coerced.select(
        "event_id", "c", *_COUNTS, "is_tracked", "pr_merged", "is_merge", "has_text",
        "created_at", "ingested_at", "processed_at", "topics",
    )


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, TRY_CAST(stars AS BIGINT) AS stars,"
    " ifnull(TRY_CAST(stars AS BIGINT), 0) AS stars_or_zero,"
    " TRY_CAST(created_at AS TIMESTAMP) AS created,"
    " CAST(TRY_CAST(created_at AS DATE) AS VARCHAR) AS created_on,"
    " ifnull(pr_merged, FALSE) AS merged, split_part(repo_name, '/', 1) AS owner,"
    " CASE WHEN repo_name LIKE '%/%' THEN split_part(repo_name, '/', 1) ELSE '' END"
    " AS owner_or_blank FROM raw"
)
def safe_casts(spark, sf_dir):
    return raw_events(spark, sf_dir).select(
        "event_id",
        "c",
        int_or_null("stars").alias("stars"),
        int_or_zero("stars").alias("stars_or_zero"),
        timestamp_or_null("created_at").alias("created"),
        date_or_null("created_at").alias("created_on"),
        flag(F.col("pr_merged").cast("string")).alias("merged"),
        repo_owner(F.col("repo_name")).alias("owner"),
        owner_or_blank(F.col("repo_name")).alias("owner_or_blank"),
    )


@query(
    f"WITH {RAW_SQL}, keyed AS (SELECT event_id, actor, c,"
    " ifnull(event_id, '_dbt_utils_surrogate_key_null_') AS e,"
    " ifnull(actor, '_dbt_utils_surrogate_key_null_') AS a FROM raw)"
    " SELECT event_id, actor, c, md5(e) AS one, md5(e || '-' || a || '-' || c) AS three FROM keyed"
)
def surrogate_keys(spark, sf_dir):
    return raw_events(spark, sf_dir).select(
        "event_id", "actor", "c",
        surrogate_key("event_id").alias("one"),
        surrogate_key("event_id", "actor", "c").alias("three"),
    )


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, repo_name,"
    f" ifnull(repo_name IN ({_TRACKED_SQL}), FALSE) AS is_tracked FROM raw"
)
def tracked_flag(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return raw.select(
        "event_id", "c", "repo_name", is_listed(F.col("repo_name"), TRACKED).alias("is_tracked")
    )


_LISTED_SQL = "listed AS (SELECT DISTINCT repo_name FROM raw WHERE language = 'Rust')"


def _listed(raw: DataFrame) -> DataFrame:
    return raw.where("language = 'Rust'").select("repo_name")


@query(
    f"WITH {RAW_SQL}, {_LISTED_SQL} SELECT event_id, c, repo_name,"
    " EXISTS (SELECT 1 FROM listed l WHERE l.repo_name = raw.repo_name) AS is_tracked FROM raw"
)
def tracked_table_flag(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return with_tracked_flag(raw, _listed(raw)).select("event_id", "c", "repo_name", "is_tracked")


@query(
    f"WITH {RAW_SQL}, {_LISTED_SQL} SELECT event_id, c, repo_name, created_at FROM raw"
    " WHERE repo_name IN (SELECT repo_name FROM listed WHERE repo_name IS NOT NULL)"
)
def tracked_only(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return only_tracked(raw, _listed(raw)).select("event_id", "c", "repo_name", "created_at")


META_SQL = """meta AS (
  SELECT repo_name, CASE WHEN max(language) = 'C' THEN NULL ELSE max(language) END AS language,
    max(TRY_CAST(stars AS BIGINT)) AS stars, max(TRY_CAST(forks AS BIGINT)) AS forks,
    max(TRY_CAST(open_issues AS BIGINT)) AS open_issues, max(description) AS description,
    CAST(to_json([max(language)]) AS VARCHAR) AS topics
  FROM raw WHERE language IS NOT NULL AND repo_name IS NOT NULL GROUP BY repo_name)"""
META_COLUMNS_SQL = (
    "CASE WHEN m.repo_name IS NULL THEN 'Unknown' ELSE m.language END AS language,"
    " ifnull(m.stars, 0) AS stars, ifnull(m.forks, 0) AS forks,"
    " ifnull(m.open_issues, 0) AS open_issues, ifnull(m.description, '') AS description"
)


def repo_meta(raw: DataFrame) -> DataFrame:
    """Metadata of most repositories; some have none, some no language."""
    known = raw.where("language IS NOT NULL AND repo_name IS NOT NULL")
    language = F.max("language")
    return known.groupBy("repo_name").agg(
        F.when(language != "C", language).alias("language"),
        *[F.max(int_or_null(c)).alias(c) for c in ("stars", "forks", "open_issues")],
        F.max("description").alias("description"),
        F.array(language).alias("topics"),
    )


@query(
    f"WITH {RAW_SQL}, {META_SQL} SELECT event_id, c, raw.repo_name, {META_COLUMNS_SQL}"
    " FROM raw LEFT JOIN meta m ON m.repo_name = raw.repo_name"
)
def repo_meta_lookup(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    slim = raw.select("event_id", "c", "repo_name")
    return with_repo_meta(slim, repo_meta(raw), unique=True).select(
        "event_id", "c", "repo_name", "meta.language", "meta.stars", "meta.forks",
        "meta.open_issues", "meta.description",
    )


@query(
    f"WITH {RAW_SQL}, {META_SQL} SELECT event_id, c, raw.repo_name, {META_COLUMNS_SQL}"
    " FROM raw LEFT JOIN meta m ON m.repo_name = raw.repo_name"
)
def repo_meta_lookup_salted(spark, sf_dir):
    """The form a stream uses, where nothing re-plans a skewed join, with older rows of metadata
    beside the ones that count."""
    raw = raw_events(spark, sf_dir)
    slim = raw.select("event_id", "c", "repo_name")
    new = repo_meta(raw).withColumn("fetched_at", F.lit("2024-02-02"))
    old = new.withColumns({"stars": F.lit(10**6), "language": F.lit("Zig"), "fetched_at": F.lit("2024-02-01")})
    return with_repo_meta(slim, new.unionByName(old), salts=8, newest_by="fetched_at").select(
        "event_id", "c", "repo_name", "meta.language", "meta.stars", "meta.forks",
        "meta.open_issues", "meta.description",
    )


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, event_type FROM raw WHERE event_type IN ({_WATCHED_SQL})"
)
def watched_filter(spark, sf_dir):
    return watched(raw_events(spark, sf_dir), "event_type").select("event_id", "c", "event_type")


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, repo_name, org, created_at FROM raw"
    " UNION ALL SELECT event_id, c, repo_name, NULL, created_at FROM raw WHERE is_tracked"
)
def union_sources(spark, sf_dir):
    raw = raw_events(spark, sf_dir).select(
        "event_id", "c", "repo_name", "org", "created_at", "is_tracked"
    )
    feed = raw.where("is_tracked").drop("org")
    return ingest.union_sources(raw, feed).drop("is_tracked")


@query(
    f"WITH {RAW_SQL}, timed AS (SELECT *, ifnull(TRY_CAST(created_at AS TIMESTAMP),"
    f" TIMESTAMP '{FALLBACK}') AS seen_at FROM raw) SELECT event_id, c, event_type, created_at,"
    " strftime(seen_at, '%Y-%m-%d') AS date, strftime(seen_at, '%H') AS hour FROM timed"
)
def route_partitions(spark, sf_dir):
    raw = raw_events(spark, sf_dir).select("event_id", "c", "event_type", "created_at")
    return enrichment.with_raw_partitions(raw, F.lit(FALLBACK).cast("timestamp"))


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, ifnull(event_type, 'Unknown') AS label,"
    " replace(repo_name, '/', '_') AS path FROM raw"
)
def partition_labels(spark, sf_dir):
    return raw_events(spark, sf_dir).select(
        "event_id", "c",
        F.coalesce("event_type", F.lit(UNKNOWN_TYPE)).alias("label"),
        path_safe(F.col("repo_name")).alias("path"),
    )


@query(
    f"WITH {RAW_SQL}, firsts AS (SELECT * FROM raw QUALIFY row_number() OVER ("
    " PARTITION BY ifnull(event_id, '') ORDER BY c, created_at, event_type NULLS FIRST) = 1)"
    f" SELECT count(*) FILTER (ifnull(event_type IN ({_WATCHED_SQL}), FALSE)) AS sent,"
    " (SELECT count(*) FROM raw) - count(*) AS skipped_dup,"
    f" count(*) FILTER (NOT ifnull(event_type IN ({_WATCHED_SQL}), FALSE)) AS skipped_type"
    " FROM firsts"
)
def ingest_counters(spark, sf_dir):
    return ingest_counts(raw_events(spark, sf_dir), [F.col("c"), F.col("created_at")])


@query(
    f"WITH {RAW_SQL}, days AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30',"
    " DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS d),"
    " found AS (SELECT date_partition AS d, count(*) AS n FROM raw GROUP BY 1)"
    " SELECT CAST(days.d AS VARCHAR) AS date, ifnull(n, 0) AS rows, n IS NULL AS missing"
    " FROM days LEFT JOIN found ON found.d = days.d"
)
def partition_rows(spark, sf_dir):
    raw = raw_events(spark, sf_dir).withColumnRenamed("date_partition", "date")
    return rows_per_date(raw, "2023-12-30", "2024-02-03")


@query(
    f"WITH {RECORDS_SQL} SELECT nullif(repo_name, '') AS key, CAST(to_json({{"
    + ", ".join(f"'{c}': {'[language, description]' if c == 'topics' else c}" for c in EVENT.names)
    + "}) AS VARCHAR) AS value FROM records"
)
def keyed_json_messages(spark, sf_dir):
    return keyed_messages(records(spark, sf_dir))


def damaged_messages(rows: DataFrame) -> DataFrame:
    """Records as JSON messages, those of one type cut short in the middle."""
    messages = rows.select("*", F.to_json(F.struct("*")).alias("json"))
    cut = F.expr("substring(json, 1, CAST(length(json) / 2 AS INT))")
    damaged = F.when(F.col("event_type") == "GollumEvent", cut).otherwise(F.col("json"))
    return messages.select(damaged.alias("value"))


@query(
    f"WITH {RECORDS_SQL} SELECT * FROM records"
    " WHERE event_type IS NOT NULL AND event_type <> 'GollumEvent'"
)
def parse_json_messages(spark, sf_dir):
    return topics_as_json(ingest.parse_messages(damaged_messages(records(spark, sf_dir))))


@query(
    f"WITH {RAW_SQL} SELECT count(*) AS rejected, count(*) FILTER (event_type = 'GollumEvent')"
    " AS malformed FROM raw WHERE event_type IS NULL OR event_type = 'GollumEvent'"
)
def rejected_messages(spark, sf_dir):
    rejected = ingest.rejected_messages(damaged_messages(records(spark, sf_dir)))
    return rejected.agg(
        F.count(F.lit(1)).alias("rejected"),
        F.count_if(~F.endswith("value", F.lit("}"))).alias("malformed"),
    )


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice,"
    " l_discount, l_tax FROM lineitem"
)
def whole_number_retype(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return enrichment.whole_numbers_to_bigint(lines)
