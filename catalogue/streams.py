"""Streaming queries over files written from the test tables, run until drained and
compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.adapter import raw_events
from catalogue.files import FIRST, LAST, _ROUTED_SQL, _fallback, workspace
from catalogue.payloads import API_SQL, NOW, WATCHED_SQL, api_events
from catalogue.records import TRACKED, damaged_messages, records, repo_meta, topics_as_json
from catalogue.registry import query, written
from forgelake.schemas import EVENT, RAW_API
from forgelake.sources.files import read_raw_dates, stream_api_events, stream_text
from forgelake.streaming.dedup import dedup_stream
from forgelake.streaming.ingest import (
    normalised_stream,
    parse_messages,
    parsed,
    union_sources,
    write_raw_batches,
    write_raw_zone,
)


def _drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()


@query(
    f"WITH {_ROUTED_SQL} SELECT * FROM routed"
    " WHERE event_type IS NOT NULL AND event_type <> 'GollumEvent'"
)
def stream_ingest(spark, sf_dir):
    """JSON messages, some cut short, to the raw zone."""
    lake = workspace(spark, "stream")
    arriving = records(spark, sf_dir).repartitionByRange("created_at")
    damaged_messages(arriving).write.text(lake.zone("landing"))
    events = parse_messages(stream_text(spark, lake.zone("landing"), max_files_per_trigger=4))
    write_raw_zone(
        events, lake.raw_zone, lake.zone("checkpoint"), trigger=None, fallback=_fallback()
    ).awaitTermination()
    return topics_as_json(read_raw_dates(spark, lake.raw_zone, FIRST, LAST))


@query(
    f"WITH {_ROUTED_SQL} SELECT * REPLACE (ifnull(event_type, 'Unknown') AS event_type)"
    " FROM routed"
)
def stream_batch_append(spark, sf_dir):
    """The batch-by-batch sink, untyped events under their label."""
    lake = workspace(spark, "append")
    messages = records(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    messages.write.text(lake.zone("landing"))
    write_raw_batches(
        parsed(stream_text(spark, lake.zone("landing"))),
        lake.raw_zone,
        lake.zone("checkpoint"),
        trigger=None,
        fallback=_fallback(),
    ).awaitTermination()
    return topics_as_json(read_raw_dates(spark, lake.raw_zone, FIRST, LAST))


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type FROM events"
)
def stream_dedup(spark, sf_dir):
    """Every event arrives three times: twice in the first run of the stream and once
    more after a restart from its checkpoint."""
    lake = workspace(spark, "dedup")
    landing, out = lake.zone("landing"), lake.zone("unique")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"), "user_id", "event_type"
    )
    for delivery in (events.union(events), events):
        delivery.write.mode("append").json(landing)
        unique = dedup_stream(spark.readStream.schema(events.schema).json(landing), salts=4)
        _drain(unique, out, lake.zone("checkpoint"))
    return spark.read.schema(events.schema).parquet(out)


@query(
    f"WITH {API_SQL} SELECT event_id, event_type, action, actor, org, repo_name, repo_owner,"
    " language, stars, forks, open_issues, description, text_content, commit_count, pr_merged,"
    " pr_number, issue_number, ref_type, ref_name, is_tracked, topics FROM flat"
    f" WHERE c = 0 AND event_id <> '' AND event_type IN ({WATCHED_SQL})"
)
def stream_normalise(spark, sf_dir):
    """Two feeds of API events with repository metadata: first copies of watched types.

    The second copies arrive after a restart, on the other feed.
    """
    lake = workspace(spark, "normalise")
    meta = written(repo_meta(raw_events(spark, sf_dir)), "meta")
    feeds = [lake.zone("landing/public"), lake.zone("landing/tracked")]
    empty = spark.createDataFrame([], RAW_API)
    for feed in feeds:
        empty.write.json(feed)
    for copy, feed in enumerate(feeds):
        api_events(spark, sf_dir, copy).write.mode("append").json(feed)
        both = union_sources(*[stream_api_events(spark, f) for f in feeds])
        flat = normalised_stream(both, TRACKED, meta, salts=4, now=F.lit(NOW))
        _drain(flat, lake.zone("published"), lake.zone("checkpoint"))
    rows = spark.read.schema(EVENT).parquet(lake.zone("published"))
    # One event without an id stays, which one is not determined, nor then if its type is watched.
    return topics_as_json(rows.where("event_id <> ''")).drop("created_at", "ingested_at")
