"""The run report: one row per stage with its count and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_report(
    spark: SparkSession, run_date: str, counts: dict[str, int], checks: DataFrame
) -> DataFrame:
    """Observed row counts per stage, then one row for the checks. The status is the
    run's own: failed if any error-level check failed."""
    stages = spark.createDataFrame(
        [(run_date, stage, rows, "done") for stage, rows in counts.items()],
        "run_date string, stage string, rows bigint, status string",
    )
    verdict = checks.agg(
        F.lit(run_date).alias("run_date"),
        F.lit("checks").alias("stage"),
        F.count(F.lit(1)).alias("rows"),
        F.when(F.count_if(F.col("status") == "fail") > 0, "failed")
        .when(F.count_if(F.col("status") == "warn") > 0, "passed with warnings")
        .otherwise("passed")
        .alias("status"),
    )
    return stages.unionByName(verdict)
