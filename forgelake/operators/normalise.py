"""Nested API events to flat records.

Two profiles exist: the stream profile keeps watched types and carries repository
metadata, the daily profile keeps every type and has none. Both are plain
projections, so they fuse with the scan into one stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions import (
    clip,
    commit_text,
    daily_pr_state,
    has_text,
    is_merge,
    owner_or_blank,
    strip,
    title_and_body,
)
from forgelake.operators.lookup import tracked_flag
from forgelake.schemas import (
    CREATE,
    ISSUE_COMMENT,
    ISSUES,
    PULL_REQUEST,
    PUSH,
    RELEASE,
    UNKNOWN_LANGUAGE,
    WATCHED_TYPES,
)

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def iso_now() -> Column:
    """The batch's time as ISO text, as the record carries it."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), ISO_UTC)


def watched(df: DataFrame, column: str = "type") -> DataFrame:
    return df.where(F.col(column).isin(WATCHED_TYPES))


def _default(path: str, value="") -> Column:
    return F.coalesce(F.col(path), F.lit(value))


def _identity(now: Column) -> dict[str, Column]:
    repo = _default("repo.name")
    return {
        "event_id": _default("id"),
        "event_type": _default("type"),
        "actor": _default("actor.login"),
        "org": _default("org.login"),
        "repo_name": repo,
        "repo_owner": owner_or_blank(repo),
        "ingested_at": now,
    }


def normalise(
    df: DataFrame, tracked: list[str], now: Column | None = None, only_watched: bool = True
) -> DataFrame:
    """Stream profile. Metadata columns, when the caller joined them in beforehand as
    ``meta``, come along; otherwise they take their defaults."""
    now = iso_now() if now is None else now
    if only_watched:
        df = watched(df)
    kind = F.col("type")
    commits = F.col("payload.commits")
    size = _default("payload.size", 0)
    listed = F.coalesce(F.array_size(commits), F.lit(0))

    text = (
        F.when(kind == PUSH, commit_text(commits))
        .when(
            kind == PULL_REQUEST,
            title_and_body(F.col("payload.pull_request.title"), F.col("payload.pull_request.body")),
        )
        .when(
            kind == ISSUES,
            title_and_body(F.col("payload.issue.title"), F.col("payload.issue.body")),
        )
        .when(
            kind == RELEASE,
            title_and_body(F.col("payload.release.name"), F.col("payload.release.body")),
        )
        .when(kind == ISSUE_COMMENT, clip(_default("payload.comment.body"), 300))
        .otherwise(F.lit(""))
    )
    action = _default("payload.action")
    release_action = F.coalesce(F.col("payload.release.action"), action)
    identity = _identity(now)
    return df.select(
        identity["event_id"].alias("event_id"),
        identity["event_type"].alias("event_type"),
        F.when(kind == RELEASE, release_action).otherwise(action).alias("action"),
        identity["actor"].alias("actor"),
        identity["org"].alias("org"),
        identity["repo_name"].alias("repo_name"),
        identity["repo_owner"].alias("repo_owner"),
        *_metadata(df),
        strip(text).alias("text_content"),
        F.when(kind == PUSH, F.when(size != 0, size).otherwise(listed))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("commit_count"),
        F.when(kind == PULL_REQUEST, _default("payload.pull_request.merged", False))
        .otherwise(F.lit(False))
        .alias("pr_merged"),
        F.when(kind == PULL_REQUEST, F.col("payload.pull_request.number")).alias("pr_number"),
        F.when(kind == ISSUES, F.col("payload.issue.number")).alias("issue_number"),
        F.when(kind == CREATE, _default("payload.ref_type")).otherwise("").alias("ref_type"),
        F.when(kind == CREATE, _default("payload.ref")).otherwise("").alias("ref_name"),
        tracked_flag(identity["repo_name"], tracked).alias("is_tracked"),
        F.coalesce(F.col("created_at"), now).alias("created_at"),
        now.alias("ingested_at"),
    )


def _metadata(df: DataFrame) -> list[Column]:
    if "meta" not in df.columns:
        return [
            F.lit(UNKNOWN_LANGUAGE).alias("language"),
            F.lit(0).cast("bigint").alias("stars"),
            F.lit(0).cast("bigint").alias("forks"),
            F.lit(0).cast("bigint").alias("open_issues"),
            F.lit("").alias("description"),
            F.array().cast("array<string>").alias("topics"),
        ]
    names = ["language", "stars", "forks", "open_issues", "description", "topics"]
    return [F.col("meta")[n].alias(n) for n in names]


def normalise_daily(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Daily profile: no metadata, counts from the payload alone, state as the API
    gives it."""
    now = iso_now() if now is None else now
    kind = F.col("type")
    commits = F.col("payload.commits")
    merged = F.when(
        kind == PULL_REQUEST, _default("payload.pull_request.merged", False)
    ).otherwise(F.lit(False))
    text = strip(
        F.when(kind == PUSH, commit_text(commits, each=100, total=500))
        .when(
            kind == PULL_REQUEST,
            title_and_body(F.col("payload.pull_request.title"), F.col("payload.pull_request.body")),
        )
        .when(
            kind == ISSUES,
            title_and_body(F.col("payload.issue.title"), F.col("payload.issue.body")),
        )
        .otherwise(F.lit(""))
    )
    identity = _identity(now)
    no_count = F.lit(None).cast("bigint")
    return df.select(
        identity["event_id"].alias("event_id"),
        identity["event_type"].alias("event_type"),
        _default("payload.action").alias("action"),
        identity["actor"].alias("actor"),
        identity["org"].alias("org"),
        identity["repo_name"].alias("repo_name"),
        identity["repo_owner"].alias("repo_owner"),
        F.lit(None).cast("string").alias("language"),
        no_count.alias("stars"),
        no_count.alias("forks"),
        no_count.alias("open_issues"),
        F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("is_tracked"),
        F.lit("[]").alias("topics"),
        text.alias("text_content"),
        F.when(kind == PUSH, F.coalesce(F.array_size(commits), F.lit(0)))
        .cast("bigint")
        .alias("commit_count"),
        merged.alias("pr_merged"),
        F.when(kind == PULL_REQUEST, F.col("payload.pull_request.number")).alias("pr_number"),
        F.when(kind == ISSUES, F.col("payload.issue.number")).alias("issue_number"),
        F.col("payload.ref_type").alias("ref_type"),
        F.col("payload.ref").alias("ref_name"),
        is_merge(kind, merged).alias("is_merge"),
        has_text(text).alias("has_text"),
        daily_pr_state(kind, merged, F.col("payload.pull_request.state")).alias("pr_state"),
        F.col("created_at"),
        now.alias("ingested_at"),
        now.alias("processed_at"),
    )
