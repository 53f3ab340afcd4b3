"""Keeping one copy per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgelake.functions import timestamp_or_null


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key under ``order``.

    Planned as a group limit on both sides of the shuffle: each map task sends at
    most one row per key, so a key holding a large share of all rows costs its
    reducer one row per map task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where("_rank = 1").drop("_rank")


def newest_copy(
    df: DataFrame,
    keys: list[str] | None = None,
    tie_break: list[Column | str] | None = None,
) -> DataFrame:
    """The most recently ingested copy of each event; copies without an ingest time
    come last.

    Full ties fall to ``tie_break``. By default that is a hash of the whole row,
    which makes reruns agree but reads every column: pass something narrower where
    few columns are wanted downstream.
    """
    ties = tie_break or [F.xxhash64(*df.columns)]
    newest = timestamp_or_null("ingested_at", df.schema["ingested_at"].dataType).desc_nulls_last()
    return latest_per_key(df, keys or ["event_id"], [newest, *ties])


def any_copy(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One arbitrary copy per key, aggregated before the shuffle."""
    return df.dropDuplicates(keys or ["event_id"])
