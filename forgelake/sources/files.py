"""File scans. Schemas are declared, so no scan ever opens files to infer one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from forgelake.functions import int_or_null, path_value
from forgelake.schemas import BLANK_TYPE, PROCESSED_ZONE, RAW_API, RAW_ZONE, SEED_TYPES

Date = dt.date | str


def read_api_events(spark: SparkSession, path: str) -> DataFrame:
    """Landed API pages: one nested event per line."""
    return spark.read.schema(RAW_API).json(path)


def stream_api_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(RAW_API)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def stream_text(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Message values as lines of text, shaped like the value side of a broker scan."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def _between(df: DataFrame, column: str, start: Date, end: Date | None) -> DataFrame:
    low, high = F.lit(str(start)).cast("date"), F.lit(str(end or start)).cast("date")
    return df.where(F.col(column).between(low, high))


def read_raw_date(spark: SparkSession, raw_zone: str, date: Date) -> DataFrame:
    """Raw rows of one date. Only that date's folder is listed; a missing one is an
    error."""
    reader = spark.read.schema(RAW_ZONE).option("basePath", raw_zone)
    return reader.parquet(f"{raw_zone}/date={date}")


def read_listed_dates(spark: SparkSession, raw_zone: str, dates: list[str]) -> DataFrame:
    """Raw rows of the given dates, whose folders alone are listed; each must exist."""
    reader = spark.read.schema(RAW_ZONE).option("basePath", raw_zone)
    return reader.parquet(*(f"{raw_zone}/date={d}" for d in dates))


def read_raw_dates(
    spark: SparkSession, raw_zone: str, start: Date, end: Date | None = None
) -> DataFrame:
    """Raw rows of an inclusive range of dates, pruned to their partitions."""
    return _between(spark.read.schema(RAW_ZONE).parquet(raw_zone), "date", start, end)


def listed_dates(spark: SparkSession, zone: str, start: Date, end: Date | None = None) -> list[str]:
    """Dates of an inclusive range that have a ``date=`` folder in ``zone``, in order, from
    one listing of the zone; a missing zone has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(zone)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = (str(f.getPath().getName()) for f in system.listStatus(path) if f.isDirectory())
    low, high = str(start), str(end or start)
    return sorted(d for n in names if n.startswith("date=") and low <= (d := n[5:]) <= high)


def read_processed_dates(
    spark: SparkSession, processed_zone: str, start: Date, end: Date | None = None
) -> DataFrame:
    """Processed rows of a range of dates. Only those dates' folders are read; the type is
    the file's own column, else that of its path, be it a folder ``event_type=X`` or a
    file ``event_type=X.parquet``. A missing zone or date gives no rows."""
    dates = listed_dates(spark, processed_zone, start, end)
    if not dates:
        return spark.createDataFrame([], PROCESSED_ZONE)
    stored = StructType([f for f in PROCESSED_ZONE if f.name != "date"])
    files = spark.read.schema(stored).option("recursiveFileLookup", True)
    rows = files.parquet(*(f"{processed_zone}/date={d}" for d in dates))
    rows = with_path_column(with_path_column(rows, "event_type"), "date")
    kind = F.when(F.col("event_type") != BLANK_TYPE, F.col("event_type")).when(
        F.col("event_type") == BLANK_TYPE, F.lit("")
    )
    return rows.select(
        *[
            kind.alias(f.name) if f.name == "event_type"
            else F.col("date").cast("date").alias(f.name) if f.name == "date"
            else F.col(f.name)
            for f in PROCESSED_ZONE
        ]
    )


def read_parquet_tree(
    spark: SparkSession, folder: str, schema: StructType | None = None
) -> DataFrame:
    """All Parquet files below ``folder`` as one frame, matched by column name.

    A missing folder is an error. With a ``schema`` an empty folder gives no rows
    and a column absent from some file is null there; without one the schemas of
    all files are merged, which reads every footer.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        return reader.schema(schema).parquet(folder)
    return reader.option("mergeSchema", "true").parquet(folder)


def with_path_column(df: DataFrame, key: str = "event_type") -> DataFrame:
    """Fill ``key`` from each row's file path where the file itself lacks it."""
    found = path_value(F.col("_metadata.file_path"), key)
    if key in df.columns:
        found = F.coalesce(F.col(key), found)
    return df.withColumn(key, found)


def read_seed_csv(
    spark: SparkSession, path: str, columns: list[str], line_breaks: bool = True
) -> DataFrame:
    """CSV with a header, whose quoted values may hold line breaks; the ten declared
    columns are typed, the rest are text. Counts are read as tolerantly as the models do.
    ``line_breaks`` makes each file one task: leave it out for large files without any."""
    kinds = {c: SEED_TYPES.get(c, StringType()) for c in columns}
    counts = [c for c, kind in kinds.items() if isinstance(kind, (IntegerType, LongType))]
    schema = StructType(
        [StructField(c, StringType() if c in counts else kind) for c, kind in kinds.items()]
    )
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )
    return rows.withColumns({c: int_or_null(c).cast(kinds[c]) for c in counts})


def dates_touched_since(spark: SparkSession, raw_zone: str, since: dt.datetime) -> DataFrame:
    """Event dates that received files after ``since`` (with a time zone), late ones
    included. Prunes by file modification time and reads the partition column only."""
    stamp = since.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    return (
        spark.read.schema(RAW_ZONE)
        .option("modifiedAfter", stamp)
        .option("timeZone", "UTC")
        .parquet(raw_zone)
        .select("date")
        .distinct()
    )
