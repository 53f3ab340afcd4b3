"""Staging models: the typed, deduplicated event set and its per-type slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgelake.functions import (
    date_or_null,
    flag,
    int_or_null,
    int_or_zero,
    repo_owner,
    timestamp_or_null,
)
from forgelake.operators.dedup import newest_copy
from forgelake.schemas import PULL_REQUEST, PUSH, UNKNOWN_ACTOR, UNKNOWN_LANGUAGE, WATCH

EARLIEST, LATEST = "2000-01-01", "2100-01-01"


def _or(column: str, default: str = "") -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def later_load_wins(schema: StructType | None = None) -> list[Column]:
    """Among copies ingested at one instant the one loaded last wins, then a hash over
    columns the dimensions need anyway, so that no wide text is read to settle ties."""
    kind = {f.name: f.dataType for f in schema or []}
    return [
        timestamp_or_null("processed_at", kind.get("processed_at")).desc_nulls_last(),
        date_or_null("date_partition", kind.get("date_partition")).desc_nulls_last(),
        F.xxhash64("event_type", "actor", "repo_name", "created_at", "stars", "commit_count"),
    ]


def stg_events(
    raw: DataFrame,
    tie_break: list[Column | str] | None = None,
    earliest: str = EARLIEST,
    latest: str = LATEST,
) -> DataFrame:
    """One typed row per event.

    Validity is judged on the surviving copy: an event whose newest copy is
    invalid disappears even if an older copy was valid.
    """
    identified = raw.where(F.col("event_id").isNotNull())
    newest = newest_copy(identified, tie_break=tie_break or later_load_wins(raw.schema))
    kind = {f.name: f.dataType for f in raw.schema}

    def typed(rule, column: str) -> Column:
        return rule(column, kind[column])

    created_on, created_at = typed(date_or_null, "created_at"), typed(timestamp_or_null, "created_at")
    valid = newest.where(
        F.col("event_type").isNotNull()
        & F.col("repo_name").isNotNull()
        & created_at.isNotNull()
        & created_on.between(F.lit(earliest).cast("date"), F.lit(latest).cast("date"))
    )
    return valid.select(
        F.col("event_id"),
        F.col("event_type"),
        _or("action").alias("action"),
        _or("actor", UNKNOWN_ACTOR).alias("actor"),
        _or("org").alias("org"),
        F.col("repo_name"),
        repo_owner(F.col("repo_name")).alias("repo_owner"),
        _or("language", UNKNOWN_LANGUAGE).alias("language"),
        typed(int_or_zero, "stars").alias("stars"),
        typed(int_or_zero, "forks").alias("forks"),
        typed(int_or_zero, "open_issues").alias("open_issues"),
        _or("description").alias("description"),
        typed(flag, "is_tracked").alias("is_tracked"),
        _or("text_content").alias("text_content"),
        typed(int_or_zero, "commit_count").alias("commit_count"),
        typed(flag, "pr_merged").alias("pr_merged"),
        typed(int_or_null, "pr_number").alias("pr_number"),
        typed(int_or_null, "issue_number").alias("issue_number"),
        _or("ref_type").alias("ref_type"),
        _or("ref_name").alias("ref_name"),
        typed(flag, "is_merge").alias("is_merge"),
        typed(flag, "has_text").alias("has_text"),
        _or("pr_state").alias("pr_state"),
        created_at.alias("created_at"),
        created_on.alias("event_date"),
        F.hour(created_at).alias("event_hour"),
        typed(timestamp_or_null, "ingested_at").alias("ingested_at"),
        typed(timestamp_or_null, "processed_at").alias("processed_at"),
        typed(date_or_null, "date_partition").alias("date_partition"),
    )


def _slice(stg: DataFrame, event_type: str, columns: list[str], renames: dict[str, str]) -> DataFrame:
    kept = stg.where(F.col("event_type") == event_type)
    return kept.select(*[F.col(c).alias(renames.get(c, c)) for c in columns])


_HEAD = ["event_id", "repo_name", "repo_owner", "language", "actor", "org"]
_TAIL = [
    "stars", "forks", "is_tracked", "created_at",
    "event_date", "event_hour", "ingested_at", "processed_at",
]


def stg_push(stg: DataFrame) -> DataFrame:
    return _slice(
        stg,
        PUSH,
        [*_HEAD, "commit_count", "text_content", *_TAIL],
        {"actor": "pushed_by", "text_content": "commit_messages", "created_at": "pushed_at"},
    )


def stg_pr(stg: DataFrame) -> DataFrame:
    return _slice(
        stg,
        PULL_REQUEST,
        [
            *_HEAD, "action", "pr_number", "pr_merged", "is_merge", "pr_state",
            "text_content", "has_text", *_TAIL,
        ],
        {
            "actor": "pr_actor",
            "action": "pr_action",
            "text_content": "pr_title_body",
            "created_at": "event_at",
        },
    )


def stg_watch(stg: DataFrame) -> DataFrame:
    return _slice(
        stg, WATCH, [*_HEAD, *_TAIL], {"actor": "starred_by", "created_at": "starred_at"}
    )
