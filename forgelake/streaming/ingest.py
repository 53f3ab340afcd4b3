"""The ingest stream: messages or API events to the partitioned raw zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgelake.operators.enrich import with_raw_partitions
from forgelake.operators.lookup import with_repo_meta
from forgelake.operators.normalise import normalise
from forgelake.schemas import EVENT, WATCHED_TYPES
from forgelake.sinks.files import RAW_PARTITIONS, append_raw, delete_files, rebalanced, routed_raw
from forgelake.sinks.ledger import BatchLedger, clear_batch
from forgelake.streaming.dedup import dedup_stream

_ADAPTIVE = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.streaming.stateless.enabled")


def parsed(messages: DataFrame) -> DataFrame:
    """The 23 typed columns of each message's JSON; malformed messages are all null.

    Unpacked by a generator, below which no filter is pushed: on a plain projection
    a filter on a parsed column would parse every message a second time.
    """
    record = F.from_json(F.col("value").cast("string"), EVENT)
    return messages.select(F.inline(F.array(record)))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Parsed events with a type; malformed and untyped messages fall away."""
    return parsed(messages).where(F.col("event_type").isNotNull())


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The raw text :func:`parse_messages` leaves out, for a quarantine sink."""
    text = F.col("value").cast("string")
    untyped = F.from_json(text, EVENT)["event_type"].isNull()
    return messages.where(untyped).select(text.alias("value"))


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Feeds as one, matched by name; a column one feed lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def normalised_stream(
    events: DataFrame,
    tracked: list[str],
    meta: DataFrame | None = None,
    delay: str = "1 day",
    salts: int = 16,
    now: Column | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """API events to published records: metadata joined in, first copy of each id
    kept, then unwatched types dropped. Copies go before types are judged, and the
    records are flattened first so that the narrow form is what gets shuffled."""
    if meta is not None:
        events = with_repo_meta(events, meta, F.col("repo.name"), salts, newest_by)
    flat = normalise(events, tracked, now, only_watched=False)
    return dedup_stream(flat, delay, salts).where(F.col("event_type").isin(WATCHED_TYPES))


def _scheduled(writer, trigger: str | None):
    """``None`` drains what is there and stops."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def gathered(routed: DataFrame, files: int) -> DataFrame:
    """Rows of one raw partition in at most ``files`` tasks, for streams without adaptive execution
    that would size their writers."""
    salt = F.pmod(F.xxhash64(*routed.columns), F.lit(files))
    return routed.repartition(*RAW_PARTITIONS, salt)


def _sized_by_spark(spark: SparkSession) -> bool:
    """Whether adaptive execution, which Spark has in streams without state from 4.1 on, plans the batches."""
    try:
        # Without a default of one's own the setting's default is returned.
        return all(spark.conf.get(k) == "true" for k in _ADAPTIVE)
    except Exception as missing:  # noqa: BLE001 - a version that does not know it
        if "SQL_CONF_NOT_FOUND" not in str(missing):
            raise
        return False


def write_raw_zone(
    events: DataFrame,
    raw_zone: str,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    fallback: Column | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """Append to ``raw/date=/hour=/event_type=``, exactly once.

    Rows go to the partition of their event time whenever they arrive, and to that
    of the arrival time when it is unreadable; there is no watermark, so none is
    too late. Rows are gathered by partition first, so that a batch adds one file to most;
    adaptive execution divides a hot one among tasks. Where it does not plan streams, or with
    ``files``, a batch adds at most so many files to each (4), as many tasks share a hot one.
    """
    routed = with_raw_partitions(events, fallback)
    if files is None and _sized_by_spark(events.sparkSession):
        routed = rebalanced(routed, RAW_PARTITIONS)
    else:
        routed = gathered(routed, files or 4)
    writer = (
        routed.writeStream.format("parquet")
        .option("path", raw_zone)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*RAW_PARTITIONS)
    )
    return _scheduled(writer, trigger).start()


def write_raw_batches(
    events: DataFrame,
    raw_zone: str,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    fallback: Column | None = None,
    ledger: BatchLedger | None = None,
) -> StreamingQuery:
    """Append batch by batch with untyped events kept under a label. With a ledger a batch that is
    written again after a failure replaces its own files; without, its rows are there twice
    and the daily run removes the copies."""

    def write(batch: DataFrame, number: int) -> None:
        if ledger is None:
            append_raw(batch, raw_zone, fallback)
        else:
            append_batch(batch, raw_zone, ledger, number, fallback)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _scheduled(writer, trigger).start()


def append_batch(
    events: DataFrame,
    raw_zone: str,
    ledger: BatchLedger,
    number: int,
    fallback: Column | None = None,
    counts: dict[str, int] | None = None,
) -> int:
    """Write one batch to the raw zone in place of what an earlier run of it wrote; returns the
    rows written."""
    clear_batch(ledger, raw_zone, number)
    routed = routed_raw(events, fallback).persist()  # read for its places, then written
    try:
        places = routed.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("rows"))
        ledger.begin(number, places)
        rows = append_raw(routed, raw_zone, fallback, ledger.basename(number))
        ledger.finish(number, {"rows": rows} if counts is None else counts)
    finally:
        routed.unpersist()
    return rows


def ingest_messages(
    messages: DataFrame,
    raw_zone: str,
    quarantine: str,
    checkpoint: str,
    ledger: BatchLedger,
    trigger: str | None = "30 seconds",
    fallback: Column | None = None,
) -> StreamingQuery:
    """Messages to the raw zone, what cannot be read to the quarantine as lines of text, and their
    counts to the ledger: one query that reads each message once, and every batch exactly once
    in all three places."""
    text, typed = F.col("value").cast("string"), F.col("event_type").isNotNull()

    def write(batch: DataFrame, number: int) -> None:
        record = F.from_json(text, EVENT)
        read = batch.select(text.alias("_text"), F.inline(F.array(record))).persist()
        try:
            none = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in EVENT.names))
            watched = F.coalesce(F.col("event_type").isin(WATCHED_TYPES), F.lit(False))
            counts = read.agg(
                F.count(F.lit(1)).alias("messages"),
                F.count_if(typed).alias("rows"),
                F.count_if(watched).alias("watched"),
                F.count_if(~typed & ~none).alias("untyped"),
                F.count_if(none).alias("malformed"),
            ).first()
            name = ledger.basename(number)
            delete_files(batch.sparkSession, f"{quarantine}/{name}-*")
            rejected = read.where(~typed & F.col("_text").isNotNull()).select(F.col("_text").alias("value"))
            rejected.write.mode("append").option("mapreduce.output.basename", name).text(quarantine)
            append_batch(read.where(typed).drop("_text"), raw_zone, ledger, number, fallback, counts.asDict())
        finally:
            read.unpersist()

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _scheduled(writer, trigger).start()
