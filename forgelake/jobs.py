"""Command line: one subcommand per stage of the daily run.

    python -m forgelake.jobs process --date 2024-01-31
    python -m forgelake.jobs process --date 2024-01-01 --until 2024-01-31

Settings come from upper-cased environment keys (FORGELAKE_ROOT, FORGELAKE_KAFKA_SERVERS, ...).
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgelake.operators.metrics import rows_per_date
from forgelake.operators.quality import (
    MART_CHECKS,
    RAW_CHECKS,
    check_table,
    check_tables,
    require_passed,
)
from forgelake.plans import batch, exports
from forgelake.plans.incremental import publish_incremental
from forgelake.plans.publish import publish
from forgelake.plans.report import run_report
from forgelake.schemas import RAW_TABLE
from forgelake.session import STREAM_CONF, session
from forgelake.settings import Settings
from forgelake.sinks.files import write_exports
from forgelake.sinks.kafka import write_kafka_stream
from forgelake.sinks.ledger import BatchLedger, stream_counts
from forgelake.sinks.warehouse import create_tables, raw_table_name
from forgelake.sources.files import read_processed_dates, read_seed_csv, stream_api_events
from forgelake.sources.kafka import stream_kafka
from forgelake.sources.tables import raw_source, read_table
from forgelake.streaming.ingest import ingest_messages, normalised_stream, write_raw_batches
from forgelake.streaming.progress import RunningCounters, observed


def _stream_ready(spark: SparkSession, settings: Settings) -> None:
    if settings.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(settings.state_partitions))


def _until_stopped(spark: SparkSession, *queries: StreamingQuery, counters: RunningCounters | None = None) -> None:
    """Wait for the queries; when one fails the others are stopped and its error is raised."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(1)  # raises the query's error
                if q.exception() is not None:
                    raise q.exception()
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()
        if counters is not None:
            spark.streams.removeListener(counters)


def stream(spark: SparkSession, settings: Settings, messages: DataFrame | None = None) -> dict[str, int]:
    """Topic to raw zone until stopped, what cannot be read to the quarantine; returns the
    stream's counters over all its runs. ``messages`` stands in for the topic."""
    _stream_ready(spark, settings)
    if messages is None:
        limits = {"max_offsets_per_trigger": settings.max_offsets or None}
        messages = stream_kafka(spark, settings.kafka_servers, settings.kafka_topic, **limits)
    ledger = BatchLedger(spark, settings.ledger, "messages")
    query = ingest_messages(
        messages,
        settings.raw_zone,
        settings.zone("quarantine"),
        settings.zone("checkpoints/raw"),
        ledger,
        settings.trigger or None,
    )
    _until_stopped(spark, query)
    return counters(spark, settings, "messages")


def counters(spark: SparkSession, settings: Settings, stream_name: str) -> dict[str, int]:
    """Totals of a stream over all its batches, restarts included."""
    rows = stream_counts(spark, settings.ledger).where(F.col("stream") == stream_name).collect()
    return {k: v for r in rows for k, v in r.asDict().items() if k != "stream"}


def landed_events(
    spark: SparkSession, settings: Settings, landed: str, meta: str | None = None
) -> DataFrame:
    """Stream of records from landed API pages, with metadata from table ``meta``."""
    table = read_table(spark, meta) if meta else None
    return normalised_stream(
        stream_api_events(spark, landed, settings.max_files or None),
        settings.tracked_repos,
        table,
        settings.dedup_delay,
        newest_by="fetched_at" if table is not None and "fetched_at" in table.columns else None,
    )


def ingest(
    spark: SparkSession, settings: Settings, landed: str, meta: str | None = None
) -> dict[str, int]:
    """Landed API pages to raw zone until stopped, with no broker between."""
    _stream_ready(spark, settings)
    events = landed_events(spark, settings, landed, meta)
    ledger = BatchLedger(spark, settings.ledger, "landed")
    checkpoint = settings.zone("checkpoints/ingest")
    query = write_raw_batches(events, settings.raw_zone, checkpoint, settings.trigger or None, ledger=ledger)
    _until_stopped(spark, query)
    return counters(spark, settings, "landed")


def produce(
    spark: SparkSession, settings: Settings, landed: str, meta: str | None = None
) -> dict[str, int]:
    """Landed API pages to topic until stopped; returns the counters of this run."""
    _stream_ready(spark, settings)
    running = RunningCounters()
    spark.streams.addListener(running)
    query = write_kafka_stream(
        observed(landed_events(spark, settings, landed, meta)),
        settings.kafka_servers,
        settings.kafka_topic,
        settings.zone("checkpoints/topic"),
        settings.trigger,
    )
    _until_stopped(spark, query, counters=running)
    return running.totals


def dry_run(spark: SparkSession, settings: Settings, start: str, end: str) -> DataFrame:
    """Processed rows per date, dates without any flagged."""
    rows = read_processed_dates(spark, settings.processed_zone, start, end)
    return rows_per_date(rows, start, end)


def build_models(
    spark: SparkSession,
    settings: Settings,
    seed: DataFrame | None = None,
    measured: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Models over the raw table, or over a development seed."""
    return publish(raw_source(spark, raw_table_name(settings), seed), settings, measured=measured)


def update_models(
    spark: SparkSession, settings: Settings, start: str, end: str | None = None
) -> dict[str, DataFrame]:
    """Models brought up to date with loaded dates, without rereading the others."""
    loaded = read_table(spark, raw_table_name(settings))
    days = [str(dt.date.fromisoformat(start) + dt.timedelta(days=i)) for i in range(_days(start, end))]
    return publish_incremental(loaded, settings, days)


def _days(start: str, end: str | None) -> int:
    return (dt.date.fromisoformat(end or start) - dt.date.fromisoformat(start)).days + 1


def saved_marts(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{settings.mart_database}.{name}") for name in MART_CHECKS}


def run_checks(
    spark: SparkSession, settings: Settings, measured: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """Checks of the raw table and the marts; ``measured`` by the marts' writes, if they were
    just written."""
    raw = read_table(spark, raw_table_name(settings))
    return check_table("raw_events", raw, RAW_CHECKS).unionByName(
        check_tables(saved_marts(spark, settings), MART_CHECKS, measured)
    )


def export(spark: SparkSession, settings: Settings, days: int | None = None) -> dict[str, str]:
    bundle = exports.export_bundle(
        saved_marts(spark, settings), settings.export_days if days is None else days
    )
    return write_exports(bundle, settings.zone("exports"))


def daily(
    spark: SparkSession,
    settings: Settings,
    start: str,
    end: str | None = None,
    landed: str | None = None,
    incremental: bool = False,
) -> DataFrame:
    """Process (or fetch from ``landed`` pages), load, model and check. The report has the
    rows of every stage and mart; its status is that of the checks. ``incremental`` brings
    the models up to date with these dates instead of building them anew."""
    create_tables(spark, settings)
    if landed:
        counts = batch.fetch_date(spark, settings, landed, start)
    else:
        counts = batch.process_dates(spark, settings, start, end)
    counts |= batch.load_dates(spark, settings, start, end)
    measured: dict[str, dict[str, int]] = {}
    if incremental:
        marts = update_models(spark, settings, start, end)
    else:
        marts = build_models(spark, settings, measured=measured)
    for name, mart in marts.items():
        counts[name] = mart.count()  # from file footers
    return run_report(spark, start, counts, run_checks(spark, settings, measured))


def require_success(report: DataFrame) -> None:
    """Raise if the run's checks failed."""
    if not report.where("status = 'failed'").isEmpty():
        raise ValueError("data-quality checks failed; see the report of the checks stage")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="forgelake", description=__doc__.splitlines()[0])
    stages = p.add_subparsers(dest="stage", required=True)
    stages.add_parser("stream", help="topic to raw zone, until stopped")
    for name, text in (
        ("ingest", "landed API pages to raw zone, until stopped"),
        ("produce", "landed API pages to topic, until stopped"),
    ):
        s = stages.add_parser(name, help=text)
        s.add_argument("--landed", required=True, help="folder of event JSON lines")
        s.add_argument("--meta", help="table of repository metadata")
    for name, text in (
        ("process", "raw zone to processed zone"),
        ("load", "processed zone to raw table"),
        ("daily", "process, load, model, check and report"),
    ):
        s = stages.add_parser(name, help=text)
        s.add_argument("--date", default=batch.yesterday(), help="first date, default yesterday")
        s.add_argument("--until", help="last date of a backfill, inclusive")
        if name == "daily":
            s.add_argument("--incremental", action="store_true", help="bring models up to date")
            s.add_argument("--landed", help="start from landed API pages instead of the raw zone")
        if name == "load":
            s.add_argument("--setup-only", action="store_true", help="create tables, load nothing")
            s.add_argument("--dry-run", action="store_true", help="show rows per date, load nothing")
    late = stages.add_parser("reprocess", help="process every date that got files since a time")
    late.add_argument("--since", required=True, help="ISO time with zone")
    fetch = stages.add_parser("fetch", help="landed API pages to processed zone")
    fetch.add_argument("--date", help="label of the output partition, default today")
    fetch.add_argument("--landed", required=True, help="folder of event JSON lines")
    models = stages.add_parser("models", help="staging views and mart tables")
    models.add_argument("--seed", help="CSV to run over instead of the raw table")
    stages.add_parser("checks", help="data-quality report; fails on error-level failures")
    out = stages.add_parser("export", help="CSV extracts")
    out.add_argument("--days", type=int, help="trailing days of daily extracts")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    settings = Settings.from_mapping(os.environ)
    conf = STREAM_CONF if args.stage in ("stream", "ingest", "produce") else {}
    spark = session(f"forgelake-{args.stage}", **conf)
    if args.stage == "stream":
        print(stream(spark, settings))
    elif args.stage == "ingest":
        print(ingest(spark, settings, args.landed, args.meta))
    elif args.stage == "produce":
        print(produce(spark, settings, args.landed, args.meta))
    elif args.stage == "process":
        print(batch.process_dates(spark, settings, args.date, args.until))
    elif args.stage == "reprocess":
        print(batch.reprocess_since(spark, settings, dt.datetime.fromisoformat(args.since)))
    elif args.stage == "fetch":
        print(batch.fetch_date(spark, settings, args.landed, args.date))
    elif args.stage == "load":
        if args.dry_run:
            dry_run(spark, settings, args.date, args.until or args.date).show(truncate=False)
            return
        create_tables(spark, settings)
        if not args.setup_only:
            print(batch.load_dates(spark, settings, args.date, args.until))
    elif args.stage == "models":
        seed = read_seed_csv(spark, args.seed, RAW_TABLE.names) if args.seed else None
        build_models(spark, settings, seed)
    elif args.stage == "checks":
        report = run_checks(spark, settings)
        report.show(100, truncate=False)
        require_passed(report)
    elif args.stage == "export":
        print(export(spark, settings, args.days))
    elif args.stage == "daily":
        report = daily(spark, settings, args.date, args.until, args.landed, args.incremental).cache()
        report.show(100, truncate=False)
        require_success(report)


if __name__ == "__main__":
    main()
