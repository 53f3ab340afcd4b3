"""Both normaliser profiles on nested events."""

import pytest
from pyspark.sql import functions as F

from forgelake.operators.lookup import with_repo_meta
from forgelake.operators.metrics import ingest_counts
from forgelake.operators.normalise import normalise, normalise_daily
from forgelake.plans.batch import daily_rows
from forgelake.schemas import EVENT, REPO_META


def now():
    return F.lit("2024-01-01T00:00:00+00:00")



def event(kind="PushEvent", **more):
    return {
        "id": "1", "type": kind, "actor": {"login": "bob"}, "repo": {"name": "o/r"},
        "created_at": "2024-01-01T00:00:00Z", "payload": {}, **more,
    }


def push(**payload):
    return event(payload=payload)


def messages(n):
    return [{"message": f"m{i}"} for i in range(n)]


@pytest.mark.parametrize(
    "payload, stream, daily",
    [
        ({"size": 40, "commits": messages(20)}, 40, 20),
        ({"size": 0, "commits": messages(3)}, 3, 3),
        ({"commits": messages(2)}, 2, 2),
        ({}, 0, 0),
    ],
)
def test_commit_count(api_rows, payload, stream, daily):
    df = api_rows(push(**payload))
    assert normalise(df, [], now()).first().commit_count == stream
    assert normalise_daily(df, now()).first().commit_count == daily


def test_record_shape(api_rows):
    got = normalise(api_rows(event()), ["o/r"], now()).schema
    assert {f.name: f.dataType for f in got} == {f.name: f.dataType for f in EVENT}


def test_unwatched_types(api_rows):
    df = api_rows(event("GollumEvent"), event("ForkEvent"))
    assert [r.event_type for r in normalise(df, [], now()).collect()] == ["ForkEvent"]
    assert normalise_daily(df, now()).count() == 2


def test_text_is_clipped_then_stripped(api_rows):
    body = "é" * 600
    row = normalise(api_rows(event("IssuesEvent", payload={"issue": {"title": " t", "body": body}})), [], now()).first()
    assert row.text_content == (" t " + body)[:500].strip()


def test_release_and_comment(api_rows):
    df = api_rows(
        event("ReleaseEvent", id="r", payload={"action": "a", "release": {"name": "v1", "body": None}}),
        event("IssueCommentEvent", id="c", payload={"comment": {"body": "x" * 400}}),
        event("CreateEvent", id="b", payload={"ref": "main", "ref_type": "branch"}),
    )
    rows = {r.event_id: r for r in normalise(df, [], now()).collect()}
    assert (rows["r"].text_content, rows["r"].action) == ("v1", "a")
    assert len(rows["c"].text_content) == 300
    assert (rows["b"].ref_name, rows["b"].ref_type, rows["c"].ref_name) == ("main", "branch", "")


def test_missing_parts_take_defaults(api_rows):
    row = normalise(api_rows({"type": "WatchEvent"}), [], now()).first()
    assert (row.event_id, row.actor, row.org, row.repo_name, row.repo_owner) == ("", "", "", "", "")
    assert row.created_at == row.ingested_at == "2024-01-01T00:00:00+00:00"


def test_tracked(api_rows):
    df = api_rows(event(), event(id="2", repo={"name": "x/y"}))
    assert {r.event_id: r.is_tracked for r in normalise(df, ["o/r"], now()).collect()} == {
        "1": True, "2": False,
    }


@pytest.mark.parametrize("salts", [1, 4])
def test_repo_meta(spark, api_rows, salts):
    meta = spark.createDataFrame(
        [("o/r", None, 5, 1, 2, ["t"], "d" * 300)], REPO_META
    )
    df = with_repo_meta(
        api_rows(event(), event(id="2", repo={"name": "x/y"})), meta, F.col("repo.name"), salts
    )
    rows = {r.event_id: r for r in normalise(df, [], now()).collect()}
    known, unknown = rows["1"], rows["2"]
    assert (known.language, known.stars, known.topics, len(known.description)) == (None, 5, ["t"], 200)
    assert (unknown.language, unknown.stars, unknown.topics, unknown.description) == ("Unknown", 0, [], "")


def test_daily_rows(api_rows):
    pr = event("PullRequestEvent", id="p", payload={
        "action": "closed", "pull_request": {"title": "t", "body": "b", "merged": True, "number": 3}})
    rows = daily_rows(api_rows(event(), event(), pr), "2024-02-03", now()).collect()
    assert len(rows) == 2
    got = {r.event_id: r for r in rows}["p"]
    assert (got.pr_state, got.is_merge, got.has_text, got.pr_number) == ("merged", True, True, 3)
    assert (got.stars, got.topics, str(got.date), got.language) == (0, "[]", "2024-02-03", None)


def test_ingest_counts(spark):
    df = spark.createDataFrame(
        [("1", "PushEvent", 0), ("1", "PushEvent", 1), ("2", "Odd", 0), ("2", "PushEvent", 1), ("3", None, 0)],
        "event_id string, event_type string, c int",
    )
    assert tuple(ingest_counts(df, [F.col("c")]).first()) == (1, 2, 2)
