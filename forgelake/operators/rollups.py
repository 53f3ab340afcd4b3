"""Activity rollups behind the dimensions.

Both dimensions are rolled up from one grain, (repository, actor). That grain
makes each distinct count a plain count, replaces the join with the newest row by
a maximum, and spreads a repository or bot holding a large share of all events
over as many keys as it has counterparts; both shuffles carry partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.schemas import (
    FORK,
    ISSUE_COMMENT,
    ISSUES,
    PULL_REQUEST,
    PUSH,
    RELEASE,
    UNKNOWN_ACTOR,
    WATCH,
)

_COUNTED = {
    "pushes": PUSH,
    "prs": PULL_REQUEST,
    "issues": ISSUES,
    "watches": WATCH,
    "forks_made": FORK,
    "comments": ISSUE_COMMENT,
    "releases": RELEASE,
}
# What each dimension wants of the newest event.
REPO_SNAPSHOT = ["language", "stars", "forks", "open_issues", "description", "is_tracked"]
CONTRIBUTOR_SNAPSHOT = ["language"]


def activity_by_repo_actor(
    stg: DataFrame, snapshot: list[str] | None = None, more: list[Column] | None = None
) -> DataFrame:
    """All additive measures per (repo_name, actor) and, as ``newest``, the
    ``snapshot`` columns of the newest event; the event id breaks ties in time.

    ``stg`` is unique on event_id, so counting rows counts events. Without a
    snapshot only fixed-width measures remain, which aggregate by hash alone. ``more``
    are further aggregates.
    """
    newest = []
    if snapshot is not None:
        newest = [F.max(F.struct("created_at", "event_id", *snapshot)).alias("newest")]
    return stg.groupBy("repo_name", "actor").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("created_at").alias("first_at"),
        *[F.count_if(F.col("event_type") == t).alias(n) for n, t in _COUNTED.items()],
        F.sum("commit_count").alias("commits"),
        F.count_if("is_merge").alias("merges"),
        *newest,
        *(more or []),
    )


def repo_rollup(pairs: DataFrame) -> DataFrame:
    """Per repository; the placeholder actor is no contributor, the blank one is."""
    return pairs.groupBy("repo_name").agg(
        F.sum("events").alias("total_events"),
        F.min("first_at").alias("first_seen_at"),
        F.sum("watches").alias("total_stars"),
        F.sum("forks_made").alias("total_forks_events"),
        F.sum("pushes").alias("total_pushes"),
        F.sum("prs").alias("total_pr_events"),
        F.count_if(F.col("actor") != UNKNOWN_ACTOR).alias("unique_contributors"),
        F.max("newest").alias("newest"),
    )


def is_contributor(actor: Column) -> Column:
    return actor.isNotNull() & (actor != "") & (actor != UNKNOWN_ACTOR)


def contributor_rollup(pairs: DataFrame) -> DataFrame:
    """Per named actor."""
    named = pairs.where(is_contributor(F.col("actor")))
    newest = F.struct("newest.created_at", "newest.event_id", "newest.language", "repo_name")
    return named.groupBy("actor").agg(
        F.sum("events").alias("total_events"),
        F.count(F.lit(1)).alias("repos_contributed_to"),
        F.min("first_at").alias("first_seen_at"),
        F.sum("pushes").alias("push_events"),
        F.sum("prs").alias("pr_events"),
        F.sum("issues").alias("issue_events"),
        F.sum("watches").alias("watch_events"),
        F.sum("forks_made").alias("fork_events"),
        F.sum("comments").alias("comment_events"),
        F.sum("releases").alias("release_events"),
        F.sum("commits").alias("total_commits"),
        F.sum("merges").alias("prs_merged"),
        F.max(newest).alias("newest"),
    )
