"""Row counts as data: ingest counters, before/after counts, presence per date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from forgelake.schemas import WATCHED_TYPES


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows as they flow past, instead of in a job of their own. The count is in
    ``observation.get["rows"]`` once the frame has been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def dedup_counts(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows before and after removing copies, null keys counting as one key."""
    per_key = df.groupBy(*(keys or ["event_id"])).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_removed"),
    )


def ingest_counts(df: DataFrame, arrival: list[Column]) -> DataFrame:
    """What the ingest would publish: copies are skipped before types are judged, and
    the first copy in ``arrival`` order decides."""
    first = F.min(F.struct(*arrival, F.col("event_type").alias("event_type")))
    per_id = df.groupBy(F.coalesce("event_id", F.lit("")).alias("event_id")).agg(
        F.count(F.lit(1)).alias("copies"), first["event_type"].alias("event_type")
    )
    kept = F.coalesce(F.col("event_type").isin(WATCHED_TYPES), F.lit(False))
    return per_id.agg(
        F.count_if(kept).alias("sent"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("skipped_dup"),
        F.count_if(~kept).alias("skipped_type"),
    )


def rows_per_date(df: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """Rows of every date in the range, dates without any flagged as missing."""
    dates = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(column)
    )
    found = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    counted = dates.join(found, column, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return counted.withColumn("missing", F.col("rows") == 0)
