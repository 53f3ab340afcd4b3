"""Dashboard extracts over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.rollups import is_contributor

TOP_REPOS, TOP_CONTRIBUTORS, EXPORT_DAYS = 200, 100, 14


def trailing_days(df: DataFrame, days: int, as_of: str | None = None) -> DataFrame:
    """Rows whose ``event_date`` is at most ``days`` before ``as_of`` (today by default)."""
    end: Column = F.lit(as_of).cast("date") if as_of else F.current_date()
    return df.where(F.col("event_date") >= F.date_sub(end, days))


def top_repos(dim_repos: DataFrame, n: int = TOP_REPOS) -> DataFrame:
    return (
        dim_repos.select(
            "repo_name", "repo_owner", "language", "stars", "forks", "open_issues",
            "total_events", "total_pushes", "total_pr_events", "total_stars",
            "unique_contributors", "is_tracked", "last_seen_at",
        )
        .orderBy(F.desc("total_events"), "repo_name")
        .limit(n)
    )


def top_contributors(dim_contributors: DataFrame, n: int = TOP_CONTRIBUTORS) -> DataFrame:
    return (
        dim_contributors.select(
            "actor", "total_events", "repos_contributed_to", "push_events", "pr_events",
            "prs_merged", "total_commits", "primary_language", "most_recent_repo",
            "first_seen_at", "last_seen_at",
        )
        .orderBy(F.desc("total_events"), "actor")
        .limit(n)
    )


def daily_pushes(
    fact_commits: DataFrame, days: int = EXPORT_DAYS, as_of: str | None = None
) -> DataFrame:
    """Pushes and commits per day and language."""
    recent = trailing_days(fact_commits, days, as_of)
    return recent.groupBy("event_date", "language").agg(
        F.count(F.lit(1)).alias("push_events"), F.sum("commit_count").alias("total_commits")
    )


def pr_breakdown(
    fact_prs: DataFrame,
    days: int = EXPORT_DAYS,
    as_of: str | None = None,
    per_repo: bool = False,
) -> DataFrame:
    """Events and distinct pull-request numbers per status.

    ``fact_prs`` is unique on event_id, so its rows are counted. Numbers repeat
    across repositories; ``per_repo`` adds the count of distinct (repository,
    number) pairs. The three statuses are too few to shuffle on, so rows are first
    reduced to one per (status, number) or (status, repository, number).
    """
    recent = trailing_days(fact_prs, days, as_of)
    if not per_repo:
        return recent.groupBy("pr_status").agg(
            F.count(F.lit(1)).alias("events"), F.count_distinct("pr_number").alias("unique_prs")
        )
    numbers = recent.groupBy("pr_status", "pr_number", "repo_name").agg(
        F.count(F.lit(1)).alias("events")
    )
    return breakdown_per_repo(numbers)


def breakdown_per_repo(numbers: DataFrame) -> DataFrame:
    """Per status, from events per (status, number, repository)."""
    numbers = numbers.groupBy("pr_status", "pr_number").agg(
        F.sum("events").alias("events"), F.count("pr_number").alias("pairs")
    )
    return numbers.groupBy("pr_status").agg(
        F.sum("events").alias("events"),
        F.count("pr_number").alias("unique_prs"),
        F.sum("pairs").alias("unique_repo_prs"),
    )


def kpi_totals(pairs: DataFrame) -> DataFrame:
    """Headline totals, from :func:`activity_by_repo_actor`."""
    actor = F.col("actor")
    return pairs.agg(
        F.coalesce(F.sum("pushes"), F.lit(0)).alias("push_events"),
        F.count_distinct(F.when(is_contributor(actor), actor)).alias("contributors"),
        F.count_distinct("repo_name").alias("repos"),
        F.coalesce(F.sum("prs"), F.lit(0)).alias("pr_events"),
    )


def stars_vs_activity(dim_repos: DataFrame) -> DataFrame:
    return dim_repos.select("repo_name", "language", "stars", "total_events")


def export_bundle(
    marts: dict[str, DataFrame], days: int = EXPORT_DAYS, as_of: str | None = None
) -> dict[str, DataFrame]:
    """The four extracts, by file name."""
    return {
        "dim_repos": top_repos(marts["dim_repos"]),
        "dim_contributors": top_contributors(marts["dim_contributors"]),
        "fact_commits": daily_pushes(marts["fact_commits"], days, as_of).orderBy("event_date"),
        "fact_prs": pr_breakdown(marts["fact_prs"], days, as_of),
    }
