"""Streams over files, drained, restarted and compared with batch."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from forgelake import jobs
from forgelake.schemas import EVENT, RAW_API
from forgelake.sources.files import (
    dates_touched_since,
    read_raw_date,
    read_raw_dates,
    stream_api_events,
    stream_text,
)
from forgelake.streaming.dedup import dedup_stream
from forgelake.streaming.ingest import (
    normalised_stream,
    parse_messages,
    parsed,
    rejected_messages,
    union_sources,
    write_raw_batches,
    write_raw_zone,
)
from forgelake.streaming.progress import RunningCounters, observed

EVERY = ("1999-01-01", "2100-01-01")


def deliver(folder, *records, name=None):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / f"{name or time.time_ns()}.json").write_text("\n".join(lines) + "\n")
    time.sleep(0.02)  # the file source orders files by modification time, in milliseconds


def record(event_id, **more):
    return {
        "event_id": event_id, "event_type": "PushEvent", "repo_name": "o/r",
        "created_at": "2024-01-02T03:04:05Z", "ingested_at": "2024-01-02T03:05:00Z", **more,
    }


def drain(df, path, checkpoint):
    (
        df.writeStream.format("parquet").option("path", str(path))
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
        .start().awaitTermination()
    )


@pytest.mark.parametrize("salts", [1, 4])
def test_first_copy_wins_across_batches_and_restarts(spark, tmp_path, salts):
    landing, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"

    def run():
        drain(dedup_stream(parse_messages(stream_text(spark, str(landing), 1)), salts=salts), out, check)

    deliver(landing, record("1"), record("1"), record("2"), record("n", created_at=None))
    deliver(landing, record("1", stars=9), record("3"), record("n", created_at=None))
    run()
    deliver(landing, record("2"), record("n"), record("late", created_at="2023-12-30T00:00:00Z",
                                                     ingested_at="2023-12-30T00:00:01Z"))
    run()
    deliver(landing, record("4"), record("late"), record("1"))
    run()
    rows = spark.read.schema(EVENT).parquet(str(out)).collect()
    assert sorted(r.event_id for r in rows) == ["1", "2", "3", "4", "late", "n"]
    assert {r.event_id: r.stars for r in rows}["1"] is None


def test_a_hot_id_comes_out_once(spark, tmp_path):
    landing = tmp_path / "in"
    for i in range(4):
        same = [record("hot")] * 300
        deliver(landing, *same, *[record(f"{i}-{j}") for j in range(600)], name=f"f{i}")
    drain(dedup_stream(parse_messages(stream_text(spark, str(landing)))), tmp_path / "out", tmp_path / "c")
    rows = spark.read.schema(EVENT).parquet(str(tmp_path / "out"))
    assert rows.count() == rows.select("event_id").distinct().count() == 2401


def test_malformed_messages_do_not_stop_the_stream(spark, tmp_path, lake):
    landing = tmp_path / "in"
    deliver(landing, "not json", record("1"), json.dumps(record("2"))[:40], record("3", event_type=None),
            record("4", stars="many"))
    events = parse_messages(stream_text(spark, str(landing)))
    write_raw_zone(events, lake.raw_zone, lake.zone("check"), trigger=None).awaitTermination()
    rows = {r.event_id: r for r in read_raw_dates(spark, lake.raw_zone, *EVERY).collect()}
    assert sorted(rows) == ["1", "4"] and rows["4"].stars is None
    text = spark.read.text(str(landing))
    assert rejected_messages(text).count() == 3


def test_rows_go_to_the_partition_of_their_event_time(spark, tmp_path, lake):
    landing = tmp_path / "in"

    def run():
        events = parse_messages(stream_text(spark, str(landing)))
        fallback = F.lit("2024-01-05 06:00:00").cast("timestamp")
        write_raw_zone(events, lake.raw_zone, lake.zone("check"), None, fallback).awaitTermination()

    deliver(landing, record("1"), record("bad", created_at="garbage"))
    run()
    deliver(landing, record("late", created_at="2023-12-31T23:00:00Z"))
    run()
    rows = read_raw_dates(spark, lake.raw_zone, *EVERY).collect()
    assert {r.event_id: (str(r.date), r.hour) for r in rows} == {
        "1": ("2024-01-02", "03"), "bad": ("2024-01-05", "06"), "late": ("2023-12-31", "23"),
    }
    assert "_dt" not in rows[0].asDict()
    assert [r.event_id for r in read_raw_date(spark, lake.raw_zone, "2023-12-31").collect()] == ["late"]


def test_late_rows_mark_their_date_as_touched(spark, tmp_path, lake):
    landing = tmp_path / "in"

    def run():
        events = parse_messages(stream_text(spark, str(landing)))
        write_raw_zone(events, lake.raw_zone, lake.zone("check"), trigger=None).awaitTermination()

    deliver(landing, record("1"), record("2", created_at="2024-01-03T00:00:00Z"))
    run()
    time.sleep(0.05)
    since = dt.datetime.now(dt.timezone.utc)
    deliver(landing, record("late"))
    run()
    touched = dates_touched_since(spark, lake.raw_zone, since).collect()
    assert [str(r.date) for r in touched] == ["2024-01-02"]


def test_landed_pages_to_records(spark, tmp_path, lake):
    landing = tmp_path / "in"
    page = {"id": "1", "type": "WatchEvent", "repo": {"name": "golang/go"}, "created_at": "2024-01-01T00:00:00Z"}
    deliver(landing, page, page)
    records = jobs.landed_events(spark, lake, str(landing))
    drain(records, tmp_path / "out", tmp_path / "check")
    (row,) = spark.read.schema(EVENT).parquet(str(tmp_path / "out")).collect()
    assert (row.event_id, row.is_tracked, row.language) == ("1", True, "Unknown")
    assert dt.datetime.fromisoformat(row.ingested_at).utcoffset() == dt.timedelta(0)


def test_batch_sink_labels_untyped_events(spark, tmp_path, lake):
    landing = tmp_path / "in"
    deliver(landing, record("1"), record("2", event_type=None))
    events = parsed(stream_text(spark, str(landing)))
    write_raw_batches(events, lake.raw_zone, lake.zone("check"), trigger=None).awaitTermination()
    rows = read_raw_dates(spark, lake.raw_zone, *EVERY).collect()
    assert {r.event_id: r.event_type for r in rows} == {"1": "PushEvent", "2": "Unknown"}


def test_two_feeds_with_metadata(spark, tmp_path):
    public, tracked = tmp_path / "public", tmp_path / "tracked"

    def event(id_, kind="WatchEvent", repo="o/r"):
        return {"id": id_, "type": kind, "repo": {"name": repo}, "created_at": "2024-01-01T00:00:00Z"}

    deliver(public, event("1"), event("2", "OddEvent"), event("3", repo="x/y"))
    deliver(tracked, event("1"), event("4"))
    meta = spark.createDataFrame(
        [("o/r", "Go", 7, 0, 0, [], "")],
        "repo_name string, language string, stars bigint, forks bigint, open_issues bigint,"
        " topics array<string>, description string",
    )
    feeds = union_sources(*[stream_api_events(spark, str(f)) for f in (public, tracked)])
    drain(normalised_stream(feeds, ["o/r"], meta), tmp_path / "out", tmp_path / "check")
    rows = spark.read.schema(EVENT).parquet(str(tmp_path / "out")).collect()
    assert {r.event_id: (r.stars, r.language, r.is_tracked) for r in rows} == {
        "1": (7, "Go", True), "3": (0, "Unknown", False), "4": (7, "Go", True),
    }
    assert feeds.schema == RAW_API


def test_running_counters(spark, tmp_path):
    landing = tmp_path / "in"
    deliver(landing, record("1"), record("2", event_type="OddEvent"))
    deliver(landing, record("3", event_type=None))
    counters = RunningCounters()
    spark.streams.addListener(counters)
    try:
        drain(observed(parsed(stream_text(spark, str(landing), 1))), tmp_path / "out", tmp_path / "check")
        for _ in range(100):
            if counters.totals.get("rows") == 3:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    assert counters.totals == {"rows": 3, "watched": 1, "untyped": 1}
    assert counters.batches >= 2
