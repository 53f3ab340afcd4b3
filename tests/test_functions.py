"""One handwritten case per column rule."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from forgelake import functions as fn
from forgelake.schemas import REPO_META


def value(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def text(s):
    return F.lit(s).cast("string")


@pytest.mark.parametrize(
    "given_, want",
    [("12", 12), ("n/a", None), (None, None), ("-3", -3), ("9999999999", 9999999999)],
)
def test_int_or_null(spark, given_, want):
    assert value(spark, fn.int_or_null(text(given_))) == want


def test_int_or_zero(spark):
    assert value(spark, fn.int_or_zero(text("n/a"))) == 0


def test_times_keep_their_own_date(spark):
    stamp = "2024-01-01T23:30:00-05:00"
    assert value(spark, fn.date_or_null(text(stamp))) == dt.date(2024, 1, 1)
    utc = value(spark, F.date_format(fn.timestamp_or_null(text(stamp)), "yyyy-MM-dd HH:mm"))
    assert utc == "2024-01-02 04:30"
    assert value(spark, fn.timestamp_or_null(text("garbage"))) is None
    assert value(spark, fn.date_or_null(text("garbage"))) is None


def test_microseconds_survive(spark):
    stamp = fn.timestamp_or_null(text("2024-01-01T00:00:00.123456Z"))
    assert value(spark, F.date_format(stamp, "SSSSSS")) == "123456"


@pytest.mark.parametrize("given_, want", [("true", True), ("false", False), (None, False), ("x", False)])
def test_flag(spark, given_, want):
    assert value(spark, fn.flag(text(given_))) is want


def test_owners(spark):
    assert value(spark, fn.repo_owner(text("a/b"))) == "a"
    assert value(spark, fn.repo_owner(text("solo"))) == "solo"
    assert value(spark, fn.owner_or_blank(text("solo"))) == ""
    assert value(spark, fn.owner_or_blank(text("a/b"))) == "a"


def test_clip_counts_code_points(spark):
    body = "é😀" * 400
    clipped = value(spark, fn.title_and_body(text("t"), text(body)))
    assert clipped == ("t " + body)[:500]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x85\xa0  　ab", max_size=12), max_size=20))
def test_strip_is_pythons(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in rows.select(fn.strip(F.col("t")).alias("s")).collect()]
    assert got == [t.strip() for t in texts]


def test_title_and_body_without_parts(spark):
    assert value(spark, fn.title_and_body(text(None), text("b"))) == " b"
    assert value(spark, fn.title_and_body(text("t"), text(None))) == "t "


def commits(*messages):
    return F.array(*[F.struct(text(m).alias("message")) for m in messages])


def test_commit_text(spark):
    seven = commits("a", None, "c", "d", "e", "f", "g")
    assert value(spark, fn.commit_text(seven)) == "a |  | c | d | e"
    assert value(spark, fn.commit_text(commits("x" * 150), each=100, total=500)) == "x" * 100
    assert len(value(spark, fn.commit_text(commits(*["y" * 150] * 5), each=100, total=500))) == 500
    empty = F.lit(None).cast("array<struct<message:string>>")
    assert value(spark, fn.commit_text(empty)) == ""


def test_topics_text(spark):
    topics = F.lit(None).cast(REPO_META["topics"].dataType)
    assert value(spark, fn.topics_text(topics)) == "[]"
    assert value(spark, fn.topics_text(F.array(F.lit("a"), F.lit('b"')))) == '["a","b\\""]'


@pytest.mark.parametrize(
    "path, want",
    [
        ("file:/x/event_type=PushEvent.parquet", "PushEvent"),
        ("file:/x/event_type=PushEvent/part-0.parquet", "PushEvent"),
        ("file:/x/event_type=__HIVE_DEFAULT_PARTITION__/part-0.parquet", None),
        ("file:/x/part-0.parquet", None),
    ],
)
def test_path_value(spark, path, want):
    assert value(spark, fn.path_value(text(path), "event_type")) == want


def test_path_safe(spark):
    assert value(spark, fn.path_safe(text("a/b/c"))) == "a_b_c"


@pytest.mark.parametrize(
    "kind, merged, action, state, merge",
    [
        ("PullRequestEvent", True, "closed", "merged", True),
        ("PullRequestEvent", False, "closed", "closed", False),
        ("PullRequestEvent", None, "closed", "closed", False),
        ("PullRequestEvent", None, "labeled", "open", False),
        ("PullRequestEvent", False, None, "open", False),
        ("PushEvent", True, "closed", "", False),
        (None, True, "closed", "", False),
    ],
)
def test_pr_rules(spark, kind, merged, action, state, merge):
    m = F.lit(merged).cast("boolean")
    assert value(spark, fn.bulk_pr_state(text(kind), m, text(action))) == state
    assert value(spark, fn.is_merge(text(kind), m)) is merge


def test_daily_pr_state(spark):
    def state(kind, merged, api):
        return value(spark, fn.daily_pr_state(text(kind), F.lit(merged).cast("boolean"), text(api)))

    assert state("PullRequestEvent", True, "closed") == "merged"
    assert state("PullRequestEvent", None, "closed") == "closed"
    assert state("PullRequestEvent", False, None) == "open"
    assert state("PushEvent", False, "closed") is None


def test_pr_status(spark):
    assert value(spark, fn.pr_status(F.lit(True), text("closed"))) == "merged"
    assert value(spark, fn.pr_status(F.lit(False), text("closed"))) == "closed"
    assert value(spark, fn.pr_status(F.lit(False), text("labeled"))) == "open"


def test_surrogate_key(spark):
    import hashlib

    row = spark.createDataFrame([("7", None)], "a string, b string")
    got = row.select(fn.surrogate_key("a").alias("x"), fn.surrogate_key("a", "b").alias("y")).first()
    assert got.x == hashlib.md5(b"7").hexdigest()
    assert got.y == hashlib.md5(b"7-_dbt_utils_surrogate_key_null_").hexdigest()


def test_has_text(spark):
    assert value(spark, fn.has_text(text(" "))) is True
    assert value(spark, fn.has_text(text(""))) is False
    assert value(spark, fn.has_text(text(None))) is False
