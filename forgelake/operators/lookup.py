"""Joins with small side inputs: tracked repositories and repository metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions import clip
from forgelake.schemas import UNKNOWN_LANGUAGE


def tracked_flag(repo_name: Column, tracked: list[str]) -> Column:
    """Membership in a configured list; a null name is not tracked."""
    return F.coalesce(repo_name.isin(tracked), F.lit(False))


def with_tracked_flag(df: DataFrame, tracked: DataFrame, key: str = "repo_name") -> DataFrame:
    """Membership in a table of names, for lists too long for a configuration value."""
    names = tracked.select(F.col(key), F.lit(True).alias("_hit")).distinct()
    joined = df.drop("is_tracked").join(names, key, "left")
    return joined.withColumn("is_tracked", F.coalesce("_hit", F.lit(False))).drop("_hit")


def only_tracked(df: DataFrame, tracked: DataFrame, key: str = "repo_name") -> DataFrame:
    return df.join(tracked.select(key).distinct(), key, "left_semi")


def _one_per_repo(meta: DataFrame, wanted: list[str], newest_by: str | None) -> DataFrame:
    if newest_by is not None:
        rows = meta.groupBy("repo_name").agg(F.max(F.struct(newest_by, *wanted)).alias("_row"))
        return rows.select("repo_name", *(f"_row.{c}" for c in wanted))
    several = F.concat(F.lit("several rows of metadata and no order for "), F.col("repo_name"))
    rows = meta.groupBy("repo_name").agg(F.first(F.struct(*wanted)).alias("_row"), F.count(F.lit(1)).alias("_rows"))
    row = F.when(F.col("_rows") > 1, F.raise_error(several).cast(rows.schema["_row"].dataType)).otherwise(F.col("_row"))
    return rows.select("repo_name", row.alias("_row")).select("repo_name", *(f"_row.{c}" for c in wanted))


def with_repo_meta(
    df: DataFrame,
    meta: DataFrame,
    repo_name: Column | None = None,
    salts: int = 1,
    newest_by: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Attach ``meta``, a struct of the repository's metadata or of its defaults.

    Of several rows of ``meta`` for one ``repo_name`` the one with the greatest ``newest_by``
    counts, ties falling to the greater values. Without such a column several rows are an
    error; metadata declared ``unique`` is joined as it is. No broadcast is forced: the planner
    broadcasts it only while its size stays under the session's threshold. Beyond
    that, batch plans rely on adaptive skew-join splitting; a stream has no
    adaptive re-plan, so ``salts`` > 1 spreads a hot repository over that many
    tasks at the price of repeating each metadata row as often.
    """
    name = F.col("repo_name") if repo_name is None else repo_name
    wanted = ["stars", "forks", "open_issues", "language", "description", "topics"]
    meta = meta.where(F.col("repo_name").isNotNull())
    if not unique:
        meta = _one_per_repo(meta, wanted, newest_by)
    side = meta.select(
        F.col("repo_name").alias("_meta_repo"),
        F.struct(
            F.col("language"),
            F.coalesce("stars", F.lit(0)).cast("bigint").alias("stars"),
            F.coalesce("forks", F.lit(0)).cast("bigint").alias("forks"),
            F.coalesce("open_issues", F.lit(0)).cast("bigint").alias("open_issues"),
            clip(F.coalesce("description", F.lit("")), 200).alias("description"),
            F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        ).alias("_meta"),
    )
    match = name == F.col("_meta_repo")
    if salts > 1:
        side = side.withColumn("_meta_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts))
        df = df.withColumn("_salt", salt.cast("int"))
        match = match & (F.col("_salt") == F.col("_meta_salt"))
    absent = F.struct(
        F.lit(UNKNOWN_LANGUAGE).alias("language"),
        F.lit(0).cast("bigint").alias("stars"),
        F.lit(0).cast("bigint").alias("forks"),
        F.lit(0).cast("bigint").alias("open_issues"),
        F.lit("").alias("description"),
        F.array().cast("array<string>").alias("topics"),
    )
    return (
        df.join(side, match, "left")
        .withColumn("meta", F.coalesce("_meta", absent))
        .drop("_meta", "_meta_repo", "_meta_salt", "_salt")
    )
