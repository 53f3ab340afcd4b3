"""What each batch of a stream wrote, so that a repeated batch replaces its own files.

A batch's files carry the stream's name and the batch's number in their names. The ledger first
notes the folders a batch is about to write to, then, when it is done, its dates and counts. A batch
that comes again, after a failure or from an older checkpoint, deletes the files
of its name from the folders noted and writes anew: however often it runs, its rows are
there once. Entries are partitioned by the day they were written, which readers prune on.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.sinks.files import delete_files

_STARTED = "date string, hour string, rows bigint"
_DONE = f"stream string, batch bigint, {_STARTED}, written_at timestamp, day date"
COUNTERS = ["messages", "rows", "watched", "untyped", "malformed"]
_COUNTS = "stream string, batch bigint, " + ", ".join(f"{c} bigint" for c in COUNTERS) + ", written_at timestamp, day date"


class BatchLedger:
    """The ledger of one stream under ``root``."""

    def __init__(self, spark: SparkSession, root: str, stream: str) -> None:
        if not re.fullmatch(r"[a-z0-9_]+", stream):
            raise ValueError(f"a stream's name is of a-z, 0-9 and _, not {stream!r}")
        self.spark, self.root, self.stream = spark, root.rstrip("/"), stream

    def basename(self, batch: int) -> str:
        """First part of the batch's file names."""
        return f"{self.stream}-{batch:012d}"

    def _started(self, batch: int) -> str:
        return f"{self.root}/started/{self.basename(batch)}"

    def folders(self, batch: int) -> list[tuple[str, str]]:
        """Dates and hours an earlier run of the batch was about to write to: as many as a batch
        has hours."""
        started = self.spark.read.schema(_STARTED).option("pathGlobFilter", "*.json")
        try:
            rows = started.json(self._started(batch)).select("date", "hour").distinct().collect()
        except Exception as missing:  # noqa: BLE001 - the reader has no test for a folder
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return []
        return [(r.date, r.hour) for r in rows]

    def begin(self, batch: int, places: DataFrame) -> None:
        """Note ``date, hour, rows`` of what is about to be written."""
        places.select("date", "hour", "rows").coalesce(1).write.mode("overwrite").json(self._started(batch))

    def finish(self, batch: int, counts: dict[str, int]) -> None:
        """Note that the batch is written."""
        now = dt.datetime.now(dt.timezone.utc)
        stamp = F.lit(now.isoformat()).cast("timestamp")
        entry = [F.lit(self.stream).alias("stream"), F.lit(batch).cast("bigint").alias("batch")]
        written = self.spark.read.schema(_STARTED).json(self._started(batch))
        written = written.select(*entry, "date", "hour", "rows", stamp.alias("written_at"))
        counted = [F.lit(counts.get(c, 0)).cast("bigint").alias(c) for c in COUNTERS]
        totals = self.spark.range(1).select(*entry, *counted, stamp.alias("written_at"))
        day = f"day={now.date()}/{self.basename(batch)}"
        for df, kind in ((written, "done"), (totals, "counts")):
            df.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{kind}/{day}")


def _entries(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    """All entries; none if nothing was ever written."""
    base = f"{root.rstrip('/')}/{kind}"
    try:
        found = spark.read.schema(schema).option("basePath", base).parquet(f"{base}/day=*/*")
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)
    return found


def ledger_exists(spark: SparkSession, root: str) -> bool:
    return not _entries(spark, root, "done", _DONE).isEmpty()


def dates_noted_since(spark: SparkSession, root: str, since: dt.datetime) -> DataFrame:
    """Event dates that batches finished after ``since`` (with a time zone) wrote to, late ones
    included, read from the ledger instead of the zone's files."""
    since = since.astimezone(dt.timezone.utc)
    entries = _entries(spark, root, "done", _DONE).where(F.col("day") >= F.lit(str(since.date())).cast("date"))
    late = entries.where(F.col("written_at") > F.lit(since.isoformat()).cast("timestamp"))
    return late.select(F.col("date").cast("date").alias("date")).distinct()


def stream_counts(spark: SparkSession, root: str) -> DataFrame:
    """Totals of each stream over all its batches. A batch written again counts as it was last."""
    entries = _entries(spark, root, "counts", _COUNTS)
    last = F.max(F.struct("written_at", *COUNTERS)).alias("last")
    batches = entries.groupBy("stream", "batch").agg(last).select("stream", "last.*")
    sums = [F.sum(c).alias(c) for c in COUNTERS]
    return batches.groupBy("stream").agg(F.count(F.lit(1)).alias("batches"), *sums)


def clear_batch(ledger: BatchLedger, zone: str, batch: int) -> int:
    """Delete what an earlier run of the batch wrote to ``zone``; returns the files deleted."""
    name = ledger.basename(batch)
    gone = 0
    for date, hour in ledger.folders(batch):
        gone += delete_files(ledger.spark, f"{zone}/date={date}/hour={hour}/*/{name}-*")
    return gone
