"""Batches that are written again, their ledger and counters, and gathered sinks."""

import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from forgelake import jobs
from forgelake.schemas import EVENT
from forgelake.sinks.ledger import BatchLedger, dates_noted_since, ledger_exists, stream_counts
from forgelake.sources.files import read_raw_dates, stream_text
from forgelake.streaming.ingest import append_batch, gathered, ingest_messages, parse_messages, write_raw_zone

EVERY = ("1999-01-01", "2100-01-01")


def record(event_id, **more):
    return {
        "event_id": event_id, "event_type": "PushEvent", "repo_name": "o/r",
        "created_at": "2024-01-02T03:04:05Z", "ingested_at": "2024-01-02T03:05:00Z", **more,
    }


def deliver(folder, *records):
    os.makedirs(folder, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with open(f"{folder}/{time.time_ns()}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def ids(spark, lake):
    return sorted(r.event_id for r in read_raw_dates(spark, lake.raw_zone, *EVERY).collect())


def events(spark, *records):
    rows = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return parse_messages(rows)


def test_a_batch_written_again_replaces_its_files(spark, lake):
    ledger = BatchLedger(spark, lake.ledger, "test")
    append_batch(events(spark, record("1"), record("2", created_at="2024-01-05T00:00:00Z")), lake.raw_zone, ledger, 0)
    append_batch(events(spark, record("3")), lake.raw_zone, ledger, 1)
    # Other rows, other hours: what the first run wrote goes wherever it lay.
    append_batch(events(spark, record("1", created_at="2024-01-09T10:00:00Z"), record("4")), lake.raw_zone, ledger, 0)
    assert ids(spark, lake) == ["1", "3", "4"]
    other = BatchLedger(spark, lake.ledger, "other")
    append_batch(events(spark, record("5")), lake.raw_zone, other, 0)
    assert ids(spark, lake) == ["1", "3", "4", "5"]
    (row,) = stream_counts(spark, lake.ledger).where("stream = 'test'").collect()
    assert (row.batches, row["rows"]) == (2, 3)


def test_a_batch_that_failed_half_way_leaves_nothing_behind(spark, lake, monkeypatch):
    ledger = BatchLedger(spark, lake.ledger, "test")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(BatchLedger, "finish", lost)
        with pytest.raises(RuntimeError):
            append_batch(events(spark, record("1")), lake.raw_zone, ledger, 0)
    assert not ledger_exists(spark, lake.ledger)
    append_batch(events(spark, record("1")), lake.raw_zone, ledger, 0)
    assert ids(spark, lake) == ["1"] and ledger_exists(spark, lake.ledger)


def test_names_of_streams():
    with pytest.raises(ValueError):
        BatchLedger(None, "/x", "a/b")


def test_ledger_names_the_dates_of_late_batches(spark, lake):
    ledger = BatchLedger(spark, lake.ledger, "test")
    assert dates_noted_since(spark, lake.ledger, dt.datetime.now(dt.timezone.utc)).count() == 0
    append_batch(events(spark, record("1")), lake.raw_zone, ledger, 0)
    since = dt.datetime.now(dt.timezone.utc)
    append_batch(events(spark, record("2", created_at="2023-12-31T00:00:00Z")), lake.raw_zone, ledger, 1)
    assert [str(r.date) for r in dates_noted_since(spark, lake.ledger, since).collect()] == ["2023-12-31"]
    east = since.astimezone(dt.timezone(dt.timedelta(hours=9)))
    assert dates_noted_since(spark, lake.ledger, east).count() == 1
    assert jobs.batch.reprocess_since(spark, lake, since) == {"raw_rows": 1, "processed_rows": 1}


def test_stream_job_over_a_restart(spark, tmp_path, lake):
    from dataclasses import replace

    lake, landing = replace(lake, trigger=""), str(tmp_path / "in")
    deliver(landing, record("1"), "no json", record("2", event_type=None), record("3", event_type="OddEvent"))
    first = jobs.stream(spark, lake, stream_text(spark, landing))
    assert first == {"batches": 1, "messages": 4, "rows": 2, "watched": 1, "untyped": 1, "malformed": 1}
    deliver(landing, record("4"), "{")
    second = jobs.stream(spark, lake, stream_text(spark, landing))
    assert second == {"batches": 2, "messages": 6, "rows": 3, "watched": 2, "untyped": 1, "malformed": 2}
    assert ids(spark, lake) == ["1", "3", "4"]
    assert spark.read.text(lake.zone("quarantine")).count() == 3
    # The same messages from an older checkpoint: nothing is there or counted twice.
    ledger = BatchLedger(spark, lake.ledger, "messages")
    ingest_messages(
        stream_text(spark, landing), lake.raw_zone, lake.zone("quarantine"), lake.zone("lost"), ledger, None
    ).awaitTermination()
    assert spark.read.text(lake.zone("quarantine")).count() >= 3
    assert sorted(set(ids(spark, lake))) == ["1", "3", "4"]


def test_a_failing_query_ends_the_job(spark, tmp_path):
    deliver(str(tmp_path / "in"), record("1"))

    def fail(*_):
        raise RuntimeError("lost")

    stream = stream_text(spark, str(tmp_path / "in")).writeStream.option("checkpointLocation", str(tmp_path / "c"))
    with pytest.raises(Exception, match="lost"):
        jobs._until_stopped(spark, stream.foreachBatch(fail).start())


def test_a_batch_adds_few_files_to_a_partition(spark, tmp_path, lake):
    landing = str(tmp_path / "in")
    for i in range(3):
        deliver(landing, *[record(f"{i}-{j}", created_at=f"2024-01-02T0{j % 3}:00:00Z") for j in range(300)])
    events = parse_messages(stream_text(spark, landing)).repartition(16)
    write_raw_zone(events, lake.raw_zone, lake.zone("check"), trigger=None, files=2).awaitTermination()
    folders = glob.glob(f"{lake.raw_zone}/date=*/hour=*/event_type=*")
    assert len(folders) == 3
    assert all(len(glob.glob(f"{f}/*.parquet")) <= 2 for f in folders)
    assert len(ids(spark, lake)) == 900


def test_a_batch_adds_one_file_to_a_small_partition(spark, tmp_path, lake):
    landing = str(tmp_path / "in")
    for i in range(3):
        deliver(landing, *[record(f"{i}-{j}", created_at=f"2024-01-02T0{j % 3}:00:00Z") for j in range(300)])
    events = parse_messages(stream_text(spark, landing)).repartition(16)
    write_raw_zone(events, lake.raw_zone, lake.zone("check"), trigger=None).awaitTermination()
    folders = glob.glob(f"{lake.raw_zone}/date=*/hour=*/event_type=*")
    assert [len(glob.glob(f"{f}/*.parquet")) for f in folders] == [1, 1, 1]
    assert len(ids(spark, lake)) == 900


def test_hot_partition_is_shared(spark):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"), F.lit("d").alias("date"), F.lit("h").alias("hour"), F.lit("t").alias("event_type")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stream
    sizes = gathered(rows, 4).rdd.glom().map(len).filter(bool).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 1 < len(sizes) <= 4 and max(sizes) < 3500


def test_timed_trigger_runs_and_stops(spark, tmp_path, lake):
    landing = str(tmp_path / "in")
    deliver(landing, record("1"))
    query = write_raw_zone(parse_messages(stream_text(spark, landing)), lake.raw_zone, lake.zone("c"), "1 second")
    try:
        query.processAllAvailable()
        deliver(landing, record("2"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert not query.isActive and ids(spark, lake) == ["1", "2"]
    assert spark.read.schema(EVENT).parquet(lake.raw_zone).count() == 2
