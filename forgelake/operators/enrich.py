"""Batch enrichment and type coercion of flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from forgelake.functions import (
    bulk_pr_state,
    date_or_null,
    flag,
    has_text,
    int_or_zero,
    is_merge,
    timestamp_or_null,
    topics_text,
)
from forgelake.schemas import COUNT_COLUMNS, FLAG_COLUMNS, TIME_COLUMNS


def enrich(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add ``is_merge``, ``has_text``, ``pr_state`` and ``processed_at``."""
    kind, merged = F.col("event_type"), F.col("pr_merged")
    return df.withColumns(
        {
            "is_merge": is_merge(kind, merged),
            "has_text": has_text(F.col("text_content")),
            "pr_state": bulk_pr_state(kind, merged, F.col("action")),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
        }
    )


def coerce_types(df: DataFrame) -> DataFrame:
    """Counts to BIGINT with 0 for null or junk, flags to BOOLEAN with false for null,
    times to TIMESTAMP with null for junk, topic arrays to JSON text."""
    rules = [(COUNT_COLUMNS, int_or_zero), (FLAG_COLUMNS, flag), (TIME_COLUMNS, timestamp_or_null)]
    changes = {c: rule(c, df.schema[c].dataType) for names, rule in rules for c in names if c in df.columns}
    if "topics" in df.columns:
        is_array = isinstance(df.schema["topics"].dataType, ArrayType)
        topics = F.col("topics")
        changes["topics"] = topics_text(topics) if is_array else F.coalesce(topics, F.lit("[]"))
    return df.withColumns(changes)


def with_date_partition(df: DataFrame, date: Column | str) -> DataFrame:
    """Label rows with the run's date, given or a column's, unless they already carry one."""
    if "date_partition" in df.columns:
        return df.withColumn("date_partition", date_or_null("date_partition", df.schema["date_partition"].dataType))
    return df.withColumn("date_partition", F.lit(date).cast("date"))


def with_raw_partitions(df: DataFrame, fallback: Column | None = None) -> DataFrame:
    """``date`` and ``hour`` of the event, or of ``fallback`` when its time is unreadable."""
    when = F.coalesce(
        timestamp_or_null("created_at", df.schema["created_at"].dataType),
        F.current_timestamp() if fallback is None else fallback,
    )
    return df.withColumns(
        {"date": F.date_format(when, "yyyy-MM-dd"), "hour": F.date_format(when, "HH")}
    )


def whole_numbers_to_bigint(df: DataFrame) -> DataFrame:
    """Retype each floating column that holds only whole numbers or nulls.

    The new schema depends on the data, so this runs one aggregate over the
    floating columns and fetches its single row.
    """
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    if not floats:
        return df
    whole = df.agg(
        *[F.coalesce(F.bool_and(_is_whole(F.col(c))), F.lit(True)).alias(c) for c in floats]
    ).first()
    return df.withColumns(
        {c: F.when(~F.isnan(c), F.col(c)).cast("bigint") for c in floats if whole[c]}
    )


def _is_whole(c: Column) -> Column:
    """Null for a missing value, false for anything BIGINT cannot hold exactly."""
    return F.when(~F.isnan(c), (c == F.rint(c)) & (F.abs(c) < 2.0**63))
