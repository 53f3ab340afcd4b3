"""Build every model once and publish it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from forgelake.operators.quality import MART_CHECKS, row_measures
from forgelake.operators.rollups import REPO_SNAPSHOT, activity_by_repo_actor
from forgelake.plans.marts import dim_contributors, dim_repos, fact_commits, fact_prs
from forgelake.plans.staging import stg_events, stg_pr, stg_push, stg_watch
from forgelake.settings import Settings
from forgelake.sinks.warehouse import create_databases, save_mart


def staged(stg: DataFrame, settings: Settings) -> DataFrame:
    """Write staging once, so that the models reading it do not repeat the
    deduplication. The deduplication's own partitioning is kept, sparing a second
    shuffle of every column; rows are sorted by type within each file, which lets the
    per-type slices skip the other types' pages."""
    path = settings.zone(f"{settings.staging_database}/stg_events")
    stg.sortWithinPartitions("event_type").write.mode("overwrite").parquet(path)
    return stg.sparkSession.read.schema(stg.schema).parquet(path)


def staging_views(stg: DataFrame) -> dict[str, DataFrame]:
    views = {
        "stg_events": stg,
        "stg_push": stg_push(stg),
        "stg_pr": stg_pr(stg),
        "stg_watch": stg_watch(stg),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def publish(
    raw: DataFrame,
    settings: Settings,
    tie_break: list[Column | str] | None = None,
    measured: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Staging views and mart tables from the raw rows; returns the marts.

    The dimensions share one written rollup per (repository, actor). Facts are
    partitioned by event date, which the trailing-window extracts prune on. ``measured``
    receives the failures of each mart's row checks, counted while it is written.
    """
    spark = raw.sparkSession
    create_databases(spark, settings, settings.staging_database, settings.mart_database)
    stg = staged(stg_events(raw, tie_break), settings)
    staging_views(stg)
    pairs = save_mart(activity_by_repo_actor(stg, REPO_SNAPSHOT), "activity_by_repo_actor", settings)
    marts = {
        "fact_commits": (fact_commits(stg), ["event_date"]),
        "fact_prs": (fact_prs(stg), ["event_date"]),
        "dim_repos": (dim_repos(stg, pairs), None),
        "dim_contributors": (dim_contributors(stg, pairs), None),
    }
    saved = {}
    for name, (df, partitions) in marts.items():
        seen = Observation()
        saved[name] = save_mart(df, name, settings, partitions, seen, row_measures(MART_CHECKS[name]))
        if measured is not None:
            measured[name] = seen.get
    return saved
