"""Mart models: two facts and two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions import pr_status, repo_owner, surrogate_key
from forgelake.operators.rollups import (
    CONTRIBUTOR_SNAPSHOT,
    REPO_SNAPSHOT,
    activity_by_repo_actor,
    contributor_rollup,
    repo_rollup,
)
from forgelake.plans.staging import stg_pr, stg_push


def fact_commits(stg: DataFrame) -> DataFrame:
    """One row per push."""
    return stg_push(stg).select(surrogate_key("event_id").alias("commit_fact_key"), "*")


def fact_prs(stg: DataFrame) -> DataFrame:
    """One row per pull-request event; the status is taken from the action and the
    merge flag, not from the batch job's state."""
    status = pr_status(F.col("is_merge"), F.col("pr_action"))
    prs = stg_pr(stg).withColumn("pr_status", status).drop("pr_state")
    return prs.select(surrogate_key("event_id").alias("pr_fact_key"), "*")


def dim_repos(stg: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row per repository: its newest snapshot and its activity.

    Pass ``pairs`` when :func:`activity_by_repo_actor` is already materialised with
    the repository snapshot.
    """
    repos = repo_rollup(activity_by_repo_actor(stg, REPO_SNAPSHOT) if pairs is None else pairs)
    return repos.select(
        surrogate_key("repo_name").alias("repo_key"),
        "repo_name",
        repo_owner(F.col("repo_name")).alias("repo_owner"),
        "newest.language",
        "newest.stars",
        "newest.forks",
        "newest.open_issues",
        "newest.description",
        "newest.is_tracked",
        F.col("newest.created_at").alias("last_seen_at"),
        "total_events",
        "first_seen_at",
        F.col("newest.created_at").alias("latest_event_at"),
        "total_stars",
        "total_forks_events",
        "total_pushes",
        "total_pr_events",
        "unique_contributors",
    )


def dim_contributors(stg: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row per named actor."""
    if pairs is None:
        pairs = activity_by_repo_actor(stg, CONTRIBUTOR_SNAPSHOT)
    actors = contributor_rollup(pairs)
    return actors.select(
        surrogate_key("actor").alias("contributor_key"),
        "actor",
        "total_events",
        "repos_contributed_to",
        "first_seen_at",
        F.col("newest.created_at").alias("last_seen_at"),
        "push_events",
        "pr_events",
        "issue_events",
        "watch_events",
        "fork_events",
        "comment_events",
        "release_events",
        "total_commits",
        "prs_merged",
        F.col("newest.language").alias("primary_language"),
        F.col("newest.repo_name").alias("most_recent_repo"),
    )
