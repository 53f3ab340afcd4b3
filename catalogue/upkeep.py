"""Queries over tables that are kept up to date: incremental publishing, ledgers, migration,
rejects and exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.adapter import AS_OF, RAW_SQL, raw_events
from catalogue.files import FIRST, LAST, _fallback, _LOADED_SQL, _ROUTED_SQL, workspace
from catalogue.models import enriched
from catalogue.records import RECORDS_SQL, _WATCHED_SQL, damaged_messages, records, topics_as_json
from catalogue.registry import ORACLE, query, written
from forgelake.functions import int_or_null
from forgelake.operators.enrich import coerce_types
from forgelake.plans import exports
from forgelake.plans.incremental import breakdown_of, publish_incremental
from forgelake.plans.publish import publish
from forgelake.schemas import COUNT_COLUMNS
from forgelake.settings import Settings
from forgelake.sinks.files import write_exports
from forgelake.sinks.ledger import BatchLedger, dates_noted_since, stream_counts
from forgelake.sinks.warehouse import (
    LoadRejected,
    create_databases,
    create_tables,
    load_rows,
    raw_table_name,
    replace_partitions,
    require_bigint,
    widen_table,
)
from forgelake.sources.files import read_raw_dates, stream_text
from forgelake.sources.tables import read_table
from forgelake.streaming.ingest import ingest_messages, parse_messages, parsed, write_raw_batches, write_raw_zone


def _loaded_twice(spark: SparkSession, sf_dir: str, label: str) -> tuple[dict[str, DataFrame], Settings]:
    """Marts after a first load in which some dates lack rows and hold others under wrong
    names, times and counts, and a second load of these dates. Second copies lie three days behind."""
    lake = workspace(spark, label)
    late = F.when(F.col("c") == 1, F.date_add("date_partition", 3)).otherwise(F.col("date_partition"))
    raw = written(enriched(spark, sf_dir).withColumn("date_partition", late), f"{label}-raw")
    touched = F.col("date_partition").between("2024-01-08", "2024-01-12")
    wrong = {
        "actor": F.concat(F.col("actor"), F.lit("-old")),
        "repo_name": F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit("moved/away")).otherwise(F.col("repo_name")),
        "created_at": F.when(F.col("event_id").cast("bigint") % 5 == 0, F.lit("2024-01-29T00:00:00Z")).otherwise(F.col("created_at")),
        "commit_count": F.lit("7"),
    }
    first = raw.where(~touched).unionByName(raw.where(touched & (F.col("event_id").cast("bigint") % 4 > 0)).withColumns(wrong))
    publish_incremental(written(first, f"{label}-first"), lake, tie_break=["c"])
    days = [str(dt.date(2024, 1, d)) for d in range(8, 13)]
    return publish_incremental(raw, lake, days, ["c"]), lake


@query(ORACLE["dim_repos"])
def publish_incremental_repos(spark, sf_dir):
    return _loaded_twice(spark, sf_dir, "increp")[0]["dim_repos"]


@query(ORACLE["pr_status_repo_pairs"])
def publish_incremental_breakdown(spark, sf_dir):
    """The status breakdown from the state that the second load merged into."""
    _, lake = _loaded_twice(spark, sf_dir, "incpr")
    return breakdown_of(spark.table(f"{lake.mart_database}.pr_state"), as_of=AS_OF)


@query(ORACLE["dim_repos"])
def published_repos(spark, sf_dir):
    return publish(enriched(spark, sf_dir), workspace(spark, "repos"), ["c"])["dim_repos"]


@query(ORACLE["fact_commits"])
def published_commits(spark, sf_dir):
    return publish(enriched(spark, sf_dir), workspace(spark, "commits"), ["c"])["fact_commits"]


@query(ORACLE["fact_prs"])
def published_prs(spark, sf_dir):
    return publish(enriched(spark, sf_dir), workspace(spark, "prs"), ["c"])["fact_prs"]


@query(
    " UNION ALL ".join(
        f"SELECT '{extract}' AS extract, concat_ws('|', {columns}) AS line FROM ({ORACLE[name]})"
        for extract, name, columns in (
            (
                "dim_repos",
                "top_repos_200",
                "repo_name, repo_owner, language, stars, forks, open_issues, total_events, total_pushes,"
                " total_pr_events, total_stars, unique_contributors, is_tracked",
            ),
            (
                "dim_contributors",
                "top_contributors_100",
                "actor, total_events, repos_contributed_to, push_events, pr_events, prs_merged,"
                " total_commits, primary_language, most_recent_repo",
            ),
            ("fact_commits", "daily_pushes_by_language", "event_date, language, push_events, total_commits"),
            ("fact_prs", "pr_status_breakdown", "pr_status, events, unique_prs"),
        )
    )
)
def export_bundle(spark, sf_dir):
    """The four named files, read back."""
    lake = workspace(spark, "bundle")
    bundle = exports.export_bundle(publish(enriched(spark, sf_dir), lake, ["c"]), as_of=AS_OF)
    paths = write_exports(bundle, lake.zone("exports"))
    found = None
    for name, path in paths.items():
        columns = [c for c in bundle[name].columns if not c.endswith("_at")]
        rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        line = F.concat_ws("|", *columns).alias("line")
        rows = rows.select(F.lit(name).alias("extract"), line)
        found = rows if found is None else found.union(rows)
    return found


@query(
    f"WITH {RAW_SQL} SELECT event_id, c, CAST(date_partition AS VARCHAR) AS date_partition,"
    + ",".join(f" TRY_CAST({c} AS BIGINT) AS {c}" for c in COUNT_COLUMNS)
    + " FROM raw"
)
def widened_table(spark, sf_dir):
    """A partitioned table written with INT counts, widened in place, twice."""
    lake = workspace(spark, "widen")
    create_databases(spark, lake, lake.raw_database)
    # Counts beyond an INT, one in the data, cannot have been stored in one.
    narrow = raw_events(spark, sf_dir).select(
        "event_id", "c", *[int_or_null(c).try_cast("int").alias(c) for c in COUNT_COLUMNS], "date_partition"
    )
    table = f"{lake.raw_database}.narrow"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (date_partition) LOCATION '{lake.zone('narrow')}'")
    replace_partitions(narrow.hint("rebalance", "date_partition"), table)
    assert sorted(widen_table(spark, table, lake.zone("wide"))) == sorted(COUNT_COLUMNS)
    assert widen_table(spark, table, lake.zone("wider")) == []
    require_bigint(spark.table(table))
    return spark.table(table)


@query(
    f"WITH {_LOADED_SQL} SELECT event_id, repo_name, event_type, CAST(date_partition AS VARCHAR) AS date_partition,"
    " concat_ws(',', CASE WHEN event_id IS NULL THEN 'event_id' END,"
    " CASE WHEN repo_name IS NULL THEN 'repo_name' END) AS missing, CAST(0 AS BIGINT) AS loaded"
    " FROM loaded WHERE event_id IS NULL OR repo_name IS NULL"
)
def load_rejects(spark, sf_dir):
    """All rows offered to the raw table: those without a value it must have, and how many rows
    were loaded beside them, which is none."""
    lake = workspace(spark, "rejects")
    create_tables(spark, lake)
    rejects, table = lake.zone("rejected"), raw_table_name(lake)
    try:
        load_rows(coerce_types(enriched(spark, sf_dir)), table, rejects)
    except LoadRejected:
        pass
    loaded = F.lit(spark.table(table).count()).alias("loaded")
    rows = spark.read.parquet(rejects)
    missing = F.array_join("missing_columns", ",").alias("missing")
    return rows.select("event_id", "repo_name", "event_type", F.col("date_partition").cast("string"), missing, loaded)


def _messages(spark: SparkSession, sf_dir: str, lake: Settings, part: int) -> None:
    """One of two deliveries of messages."""
    rows = records(spark, sf_dir).where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part)
    damaged_messages(rows).write.mode("append").text(lake.zone("landing"))


def _ingested(spark: SparkSession, sf_dir: str, label: str) -> Settings:
    """Messages in two runs of the stream, the first run repeated from a lost checkpoint."""
    lake = workspace(spark, label)
    ledger = BatchLedger(spark, lake.ledger, "messages")

    def run(checkpoint: str) -> None:
        ingest_messages(
            stream_text(spark, lake.zone("landing")), lake.raw_zone, lake.zone("quarantine"),
            lake.zone(checkpoint), ledger, trigger=None, fallback=_fallback(),
        ).awaitTermination()

    _messages(spark, sf_dir, lake, 0)
    run("lost")
    run("checkpoint")
    _messages(spark, sf_dir, lake, 1)
    run("checkpoint")
    return lake


@query(f"WITH {_ROUTED_SQL} SELECT * FROM routed WHERE event_type IS NOT NULL AND event_type <> 'GollumEvent'")
def stream_replayed(spark, sf_dir):
    """The raw zone after a batch was written twice."""
    lake = _ingested(spark, sf_dir, "replay")
    return topics_as_json(read_raw_dates(spark, lake.raw_zone, FIRST, LAST))


@query(
    f"WITH {RAW_SQL} SELECT count(*) AS rejected, count(*) FILTER (event_type = 'GollumEvent')"
    " AS malformed FROM raw WHERE event_type IS NULL OR event_type = 'GollumEvent'"
)
def stream_quarantine(spark, sf_dir):
    lake = _ingested(spark, sf_dir, "quarantine")
    return spark.read.text(lake.zone("quarantine")).agg(
        F.count(F.lit(1)).alias("rejected"), F.count_if(~F.endswith("value", F.lit("}"))).alias("malformed")
    )


@query(
    f"WITH {RECORDS_SQL} SELECT 'messages' AS stream, count(*) AS messages,"
    " count(*) FILTER (event_type <> 'GollumEvent') AS rows,"
    f" count(*) FILTER (event_type IN ({_WATCHED_SQL})) AS watched,"
    " count(*) FILTER (event_type IS NULL) AS untyped,"
    " count(*) FILTER (event_type = 'GollumEvent') AS malformed, CAST(2 AS BIGINT) AS batches FROM records"
)
def stream_counters(spark, sf_dir):
    """Counters over a restart and a repeated batch, errors included."""
    return stream_counts(spark, _ingested(spark, sf_dir, "counters").ledger)


@query(f"WITH {_ROUTED_SQL} SELECT DISTINCT date FROM routed WHERE language = 'Rust'")
def ledger_dates(spark, sf_dir):
    """Dates reached by late deliveries, from the ledger of a stream."""
    lake = workspace(spark, "noted")
    ledger = BatchLedger(spark, lake.ledger, "late")
    rows = records(spark, sf_dir)
    since = None
    for late in (False, True):
        part = rows.where((F.coalesce("language", F.lit("")) == "Rust") == late)
        part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(lake.zone("landing"))
        since = dt.datetime.now(dt.timezone.utc)
        events = parsed(stream_text(spark, lake.zone("landing")))
        write_raw_batches(
            events, lake.raw_zone, lake.zone("checkpoint"), trigger=None, fallback=_fallback(), ledger=ledger
        ).awaitTermination()
    return dates_noted_since(spark, lake.ledger, since)


@query(
    f"WITH {_ROUTED_SQL} SELECT * FROM routed WHERE event_type IS NOT NULL AND event_type <> 'GollumEvent'"
)
def stream_timed(spark, sf_dir):
    """The native sink under a timed trigger, stopped by its handle when all is written."""
    lake = workspace(spark, "timed")
    damaged_messages(records(spark, sf_dir)).write.text(lake.zone("landing"))
    events = parse_messages(stream_text(spark, lake.zone("landing")))
    stream = write_raw_zone(
        events, lake.raw_zone, lake.zone("checkpoint"), trigger="1 second", fallback=_fallback()
    )
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return topics_as_json(read_raw_dates(spark, lake.raw_zone, FIRST, LAST))
