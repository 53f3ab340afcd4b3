"""Running counters of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from forgelake.schemas import WATCHED_TYPES


def observed(df: DataFrame, name: str = "ingest") -> DataFrame:
    """Count rows, watched rows and untyped rows as they pass."""
    kept = F.coalesce(F.col("event_type").isin(WATCHED_TYPES), F.lit(False))
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kept).alias("watched"),
        F.count_if(F.col("event_type").isNull()).alias("untyped"),
    )


class RunningCounters(StreamingQueryListener):
    """Totals of the observed metrics over the batches of one run; register on the session, and
    remove it afterwards. The ledger keeps counters over restarts."""

    def __init__(self, name: str = "ingest"):
        self.name = name
        self.batches = 0
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches += 1
        for key, value in row.asDict().items():
            self.totals[key] = self.totals.get(key, 0) + (value or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
