"""Partitioned Parquet and CSV writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators.enrich import whole_numbers_to_bigint, with_raw_partitions
from forgelake.operators.metrics import counted
from forgelake.schemas import BLANK_TYPE, UNKNOWN_TYPE
from forgelake.settings import scratch_dir

RAW_PARTITIONS = ["date", "hour", "event_type"]


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any Hadoop file system. DataFrames cannot delete, so this asks the
    classic session's JVM; Spark Connect has no such handle."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def delete_files(spark: SparkSession, pattern: str) -> int:
    """Delete the files that match a glob; returns how many."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in system.globStatus(target) or []]
    for path in found:
        system.delete(path, False)
    return len(found)


def move_file(spark: SparkSession, pattern: str, target: str) -> None:
    """Give the one file that matches a glob another name, in place of what has it."""
    fs = spark._jvm.org.apache.hadoop.fs
    path, name = fs.Path(pattern), fs.Path(target)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    (found,) = system.globStatus(path)
    system.delete(name, False)
    if not system.rename(found.getPath(), name):
        raise OSError(f"cannot write {target}")


class Scratch:
    """Intermediate tables in the shared folder, deleted at the end of the block."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folders: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        for folder in self.folders:
            remove_folder(self.spark, folder)

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` computed once and read back: neither computed again nor dependent on the
        executors that did."""
        self.folders.append(scratch_dir(self.spark, label))
        df.write.parquet(f"{self.folders[-1]}/data")
        return self.spark.read.schema(df.schema).parquet(f"{self.folders[-1]}/data")


def rebalanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Group rows by target partition into evenly sized tasks.

    Adaptive execution splits a partition value that holds much of the data over
    several tasks and packs small ones together, so neither one huge writer nor a
    crowd of tiny files results.
    """
    return df.hint("rebalance", *columns)


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; others stay as they are."""
    (
        rebalanced(df, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def overwrite_dates(df: DataFrame, zone: str, dates: list[str]) -> None:
    """Replace all of ``zone/date=<date>`` for every one of ``dates`` in one job, split by event
    type; ``df`` has rows of these dates only.

    Partitions are replaced one by one, so a type that a date has no longer would stay: folders
    without a file of this run are deleted afterwards. Running it again gives the same zone. A
    blank type has a folder of its own: a partition value cannot be blank and would come back as null."""
    run = f"run{uuid.uuid4().hex}"
    kind = F.when(F.col("event_type") == "", F.lit(BLANK_TYPE)).otherwise(F.col("event_type"))
    (
        rebalanced(df.withColumn("event_type", kind), ["date", "event_type"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("mapreduce.output.basename", run)
        .partitionBy("date", "event_type")
        .parquet(zone)
    )
    for date in dates:
        remove_stale(df.sparkSession, f"{zone}/date={date}", run)


def remove_stale(spark: SparkSession, folder: str, run: str) -> int:
    """Delete what lies in ``folder`` beside the folders that hold files of ``run``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for entry in system.listStatus(path) if system.exists(path) else []:
        names = [f.getPath().getName() for f in system.listStatus(entry.getPath())] if entry.isDirectory() else []
        if not any(n.startswith(run) for n in names):
            system.delete(entry.getPath(), True)
            gone += 1
    return gone


def append_raw(
    df: DataFrame, raw_zone: str, fallback: Column | None = None, basename: str | None = None
) -> int:
    """Append a batch to the raw zone, untyped events under their own label, and return
    the rows written. File names begin with ``basename`` if given."""
    routed, written = counted(routed_raw(df, fallback))
    writer = rebalanced(routed, RAW_PARTITIONS).write.mode("append").partitionBy(*RAW_PARTITIONS)
    if basename is not None:
        writer = writer.option("mapreduce.output.basename", basename)
    writer.parquet(raw_zone)
    return written.get["rows"]


def routed_raw(df: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Rows with their partitions of the raw zone."""
    labelled = df.withColumn("event_type", F.coalesce("event_type", F.lit(UNKNOWN_TYPE)))
    return with_raw_partitions(labelled, fallback)


def write_csv(df: DataFrame, folder: str, single_file: bool = False) -> str:
    """CSV with a header, quoting as RFC 4180 has it. ``single_file`` is for results
    whose row count is bounded by a limit."""
    if single_file:
        df = df.coalesce(1)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(folder)
    )
    return folder


def write_named_csv(df: DataFrame, folder: str, name: str) -> str:
    """``folder/name.csv``: one file of a result whose rows a limit or its grain bounds, floats that
    hold whole numbers only written as such. The file takes the place of an older one by a
    rename, so that a reader sees one or the other."""
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{name}.csv"
    with Scratch(spark) as scratch:
        rows = whole_numbers_to_bigint(scratch.write(df.coalesce(1), f"export-{name}"))
        part = f"{folder.rstrip('/')}/.{name}.parts"
        write_csv(rows, part, single_file=True)
        move_file(spark, f"{part}/part-*.csv", path)
        remove_folder(spark, part)
    return path


def write_exports(extracts: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each extract to a file of its name and return the paths."""
    return {name: write_named_csv(df, folder, name) for name, df in extracts.items()}
