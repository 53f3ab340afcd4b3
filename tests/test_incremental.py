"""Incremental publishing equals a full rebuild, and reads no more than it must."""

import random
import re

import pytest
from pyspark.sql import functions as F

from forgelake.functions import date_or_null
from forgelake.plans import incremental
from forgelake.plans.exports import pr_breakdown
from forgelake.plans.incremental import merge_state, publish_incremental, state_of, winners
from forgelake.plans.publish import publish
from forgelake.plans.staging import stg_events

MARTS = ["fact_commits", "fact_prs", "dim_repos", "dim_contributors"]
KINDS = ["PushEvent", "PullRequestEvent", "WatchEvent", "ForkEvent"]


def loads(rng, days, events):
    """Rows of each date_partition: events with copies in several, some moved or broken."""
    out = {d: [] for d in days}
    for i in range(events):
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            day = rng.choice(days)
            out[day].append({
                "event_id": str(i),
                "event_type": rng.choice(KINDS) if rng.random() < 0.95 else None,
                "actor": rng.choice(["a", "b", "c", "", None]),
                "repo_name": rng.choice(["o/x", "o/y", "p/z"]),
                "stars": str(rng.randrange(100)),
                "commit_count": str(rng.randrange(9)),
                "pr_number": str(rng.randrange(4)),
                "action": rng.choice(["opened", "closed"]),
                "created_at": rng.choice([f"2024-01-0{rng.randrange(1, 6)}T0{rng.randrange(9)}:00:00Z", "junk"]) if rng.random() < 0.1 else f"2024-01-0{i % 5 + 1}T0{i % 9}:00:00Z",
                "ingested_at": f"2024-02-01T00:{rng.randrange(60):02d}:{rng.randrange(60):02d}Z",
                "date_partition": day,
            })
    return out


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def frame(raw_rows, held):
    df = raw_rows(*[r for rows in held.values() for r in rows])
    return df.withColumn("date_partition", date_or_null("date_partition"))


@pytest.fixture
def other(lake, tmp_path):
    from dataclasses import replace

    return replace(lake, root=str(tmp_path / "full"), staging_database=lake.staging_database + "_f", mart_database=lake.mart_database + "_f")


def test_equals_a_full_rebuild_after_every_load(spark, lake, other, raw_rows):
    rng = random.Random(1)
    days = [f"2024-01-0{d}" for d in range(1, 5)]
    held = loads(rng, days, 60)
    publish_incremental(frame(raw_rows, held), lake)
    for step in range(3):
        touched = rng.sample(days, 2)
        fresh = loads(rng, days, 60)
        for d in touched:
            held[d] = fresh[d] if step < 2 else []
        raw = frame(raw_rows, held)
        got = publish_incremental(raw, lake, touched)
        want = publish(raw, other)
        for name in MARTS:
            assert got[name].columns and set(got[name].columns) == set(want[name].columns)
            assert rows_of(got[name]) == rows_of(want[name]), (step, name)
        stg = stg_events(raw)
        table = spark.table(f"{lake.staging_database}.stg_events")
        assert rows_of(table) == rows_of(stg)
        state = spark.table(f"{lake.mart_database}.pr_state")
        whole = pr_breakdown(want["fact_prs"], 10, "2024-01-05", per_repo=True)
        assert rows_of(incremental.breakdown_of(state, 10, "2024-01-05")) == rows_of(whole)


@pytest.mark.parametrize("broken", ["_write_state", "_drop_states"])
def test_can_be_repeated_after_a_failure(spark, lake, other, raw_rows, monkeypatch, broken):
    rng = random.Random(9)
    days = ["2024-01-01", "2024-01-02"]
    held = loads(rng, days, 25)
    publish_incremental(frame(raw_rows, held), lake)
    held["2024-01-02"] = loads(rng, days, 25)["2024-01-02"]
    raw = frame(raw_rows, held)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, broken, fail)
        with pytest.raises(RuntimeError):
            publish_incremental(raw, lake, ["2024-01-02"])
    got, want = publish_incremental(raw, lake, ["2024-01-02"]), publish(raw, other)
    for name in MARTS:
        assert rows_of(got[name]) == rows_of(want[name]), name


def test_state_takes_back_what_was_replaced(spark, raw_rows):
    def state(*rows):
        return state_of(stg_events(raw_rows(*rows)))

    def row(i, hour, **more):
        return {"event_id": str(i), "created_at": f"2024-01-01T0{hour}:00:00Z", "stars": str(hour), **more}

    base = [row(1, 1), row(2, 2), row(3, 3)]
    # The newest is replaced by itself with other values, the first by an earlier one.
    merged, lost = merge_state(state(*base), state(row(3, 3, stars="7"), row(1, 0)), state(row(3, 3), row(1, 1)))
    assert lost.isEmpty()
    assert rows_of(merged.drop("lost")) == rows_of(state(row(1, 0), row(2, 2), row(3, 3, stars="7")))
    # The newest goes without another in its place.
    _, lost = merge_state(state(*base), state(*base).limit(0), state(row(3, 3)))
    assert [tuple(r) for r in lost.collect()] == [("o/r", "bob")]
    # The last event goes: so does the group.
    merged, lost = merge_state(state(row(1, 1)), state(row(1, 1, actor="eve")), state(row(1, 1)))
    assert [r.actor for r in merged.collect()] == ["eve"] and lost.isEmpty()


def physical(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_old_copies_are_not_shuffled(spark, lake, raw_rows):
    held = loads(random.Random(3), ["2024-01-01", "2024-01-02"], 10)
    publish_incremental(frame(raw_rows, held), lake)
    copies = spark.table(f"{lake.staging_database}.event_copies")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.createDataFrame([("1",)], "event_id string")
        text = physical(winners(copies, ids))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in text
    assert text.count("Exchange") == 1
    exchange = text.index("Exchange")
    assert "event_copies" not in text[exchange:] and "FileScan" not in text[exchange:]


def test_untouched_partitions_are_not_read(spark, lake, raw_rows):
    held = loads(random.Random(4), ["2024-01-01", "2024-01-02"], 10)
    publish_incremental(frame(raw_rows, held), lake)
    stg = spark.table(f"{lake.staging_database}.stg_events")
    text = physical(stg.where(incremental._in("event_date", ["2024-01-03"])))
    assert re.search(r"PartitionFilters: \[.*event_date.*2024-01-03|PartitionFilters: \[.*event_date#\d+ (IN|=)", text)


def test_rows_without_date_are_refused(spark, lake, raw_rows):
    with pytest.raises(ValueError):
        publish_incremental(raw_rows({"event_id": "1", "date_partition": None}), lake)


def test_nothing_to_publish(spark, lake, raw_rows):
    empty = raw_rows({"event_id": "1"}).limit(0)
    assert all(df.isEmpty() for df in publish_incremental(empty, lake).values())
