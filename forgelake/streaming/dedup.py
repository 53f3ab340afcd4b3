"""Deduplication of a stream with state bounded by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(
    df: DataFrame, delay: str = "1 day", salts: int = 16, key: str = "event_id"
) -> DataFrame:
    """The first copy of each id to arrive; an id is remembered for ``delay``.

    The watermark runs on the micro-batch's own time, which never goes back, so no
    row is ever late: an event created days ago still passes. A stream cannot
    aggregate ahead of its shuffle, so with ``salts`` > 1 copies are first removed
    per (id, salt): an id holding much of the stream is spread over that many tasks
    and reaches the second pass as at most ``salts`` rows. The salt hashes the task's
    number with the row, so equal copies spread too and a rerun task salts alike.
    Each pass keeps its own state; ``salts=1`` keeps one, for streams whose ids are
    known to be spread.
    """
    arriving = df.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    if salts > 1:
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts))
        arriving = (
            arriving.withColumn("_salt", salt)
            .dropDuplicatesWithinWatermark([key, "_salt"])
            .drop("_salt")
        )
    return arriving.dropDuplicatesWithinWatermark([key]).drop("_arrived")
