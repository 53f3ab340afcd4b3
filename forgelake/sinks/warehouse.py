"""Catalog tables: creation, load by name, replacement of dates, layers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from forgelake.functions import strict_cast
from forgelake.schemas import COUNT_COLUMNS, RAW_TABLE, RAW_TABLE_REQUIRED
from forgelake.settings import Settings
from forgelake.sinks.files import Scratch, rebalanced, remove_folder


def raw_table_name(settings: Settings) -> str:
    return f"{settings.raw_database}.code_events"


def create_databases(spark: SparkSession, settings: Settings, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{settings.zone(name)}'")


def create_tables(spark: SparkSession, settings: Settings) -> None:
    """Create the layer databases and the raw table unless they exist."""
    create_databases(
        spark, settings, settings.raw_database, settings.staging_database, settings.mart_database
    )
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TABLE)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {raw_table_name(settings)} ({columns}) USING parquet "
        f"PARTITIONED BY (date_partition) LOCATION '{settings.zone('warehouse/code_events')}'"
    )


def by_name(
    df: DataFrame, schema: StructType = RAW_TABLE, required: list[str] | None = None
) -> DataFrame:
    """Project onto ``schema`` matching names in any case: absent columns are null,
    extra ones go, and a value that does not fit its type, or a null in a
    ``required`` column, aborts the job that reads the result."""
    sources: dict[str, str] = {}
    for name in df.columns:
        if sources.setdefault(name.lower(), name) != name:
            raise ValueError(f"columns {sources[name.lower()]!r} and {name!r} differ only in case")
    projected = []
    for f in schema:
        source = sources.get(f.name.lower())
        if source is None:
            c = F.lit(None).cast(f.dataType)
        elif df.schema[source].dataType == f.dataType:
            c = F.col(source)
        elif isinstance(df.schema[source].dataType, ArrayType) and f.dataType == StringType():
            c = F.to_json(source)
        else:
            c = strict_cast(source, f.dataType, f.name)
        if required and f.name in required:
            missing = F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)
            c = F.coalesce(c, missing)
        projected.append(c.alias(f.name))
    return df.select(projected)


def replace_dates(df: DataFrame, table: str) -> None:
    """Replace the table's partitions for every ``date_partition`` in ``df``; loading
    the same dates again gives the same table. Rows are gathered by date, so that a date
    has few files however many tasks read it, and sorted by type inside each file so that
    row groups can be skipped by event type."""
    spark = df.sparkSession
    gathered = rebalanced(df.select(spark.table(table).columns), ["date_partition"])
    clustered = gathered.sortWithinPartitions("date_partition", "event_type")
    with _dynamic_overwrite(spark):
        clustered.write.insertInto(table, overwrite=True)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows of; ``df`` may read others."""
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        df.select(spark.table(table).columns).write.insertInto(table, overwrite=True)


def drop_partition(spark: SparkSession, table: str, values: dict[str, str | int]) -> None:
    """Drop one partition and its files, which dropping from an external table leaves."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    folder = "/".join(f"{k}={v}" for k, v in values.items())
    if folder not in {r.partition for r in listed}:
        return
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    remove_folder(spark, f"{location.data_type.rstrip('/')}/{folder}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` takes the mode from the session only, not from writer options."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LoadRejected(ValueError):
    """Rows broke a constraint of the table; nothing was replaced."""


def violations(df: DataFrame, required: list[str]) -> Column:
    """The required columns a row has no value in, as an array."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return F.filter(F.array(*names), lambda c: c.isNotNull())


def load_rows(df: DataFrame, table: str, rejects: str | None = None) -> None:
    """Load by name with the raw table's NOT NULL columns enforced.

    Without ``rejects`` the first null aborts the load. With it, the rows are read once,
    those that break a constraint are appended to that folder with the names of the columns
    missing and the time of the load, and the load then ends before anything is replaced.
    A value that does not fit its column's type aborts in either case.
    """
    if rejects is None:
        replace_dates(by_name(df, required=RAW_TABLE_REQUIRED), table)
        return
    spark = df.sparkSession
    named = by_name(df)
    with Scratch(spark) as scratch:
        tagged = named.withColumn(_MISSING, violations(named, RAW_TABLE_REQUIRED))
        tagged = scratch.write(tagged, "load")
        bad = tagged.where(F.size(_MISSING) > 0)
        count = bad.count()
        if count:
            bad = bad.withColumn("rejected_at", F.current_timestamp())
            bad.write.mode("append").parquet(rejects)
            raise LoadRejected(f"{count} rows rejected, see {rejects}")
        replace_dates(tagged.drop(_MISSING), table)


_MISSING = "missing_columns"


def widen_table(spark: SparkSession, table: str, location: str, columns: list[str] | None = None) -> list[str]:
    """Give ``table``'s count columns the type BIGINT in place; returns the columns changed.

    All partitions are rewritten into ``location`` under a second name, counted against the
    old table, and only then do the names change places; the old table is dropped, its
    files stay where they were. Repeatable: a table already wide is left alone, and what a
    failed run left under the second name is written again.
    """
    second, former = f"{table}__wide", f"{table}__narrow"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(former):
        # A run ended between the two renamings.
        spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
    old = spark.table(table)
    wide = widened(old.schema, columns)
    changed = [f.name for f, g in zip(old.schema, wide) if f.dataType != g.dataType]
    if not changed:
        spark.sql(f"DROP TABLE IF EXISTS {second}")
        return []
    narrowing = [f.name for f in old.schema if f.name in changed and f.dataType.typeName() not in ("byte", "short", "integer")]
    if narrowing:
        raise TypeError(f"not whole-number columns: {narrowing}")
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    spark.sql(f"DROP TABLE IF EXISTS {second}")
    remove_folder(spark, location)
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide)
    split = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {second} ({listed}) USING parquet {split} LOCATION '{location}'")
    # Reading with the wide schema widens on the fly, so one pass rewrites everything.
    rows = old.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wide])
    rows = rebalanced(rows, partitions) if partitions else rows
    if partitions:
        replace_partitions(rows, second)
    else:
        rows.write.insertInto(second, overwrite=True)
    checks = [F.count(F.lit(1)), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in changed], *[F.count(c) for c in changed]]
    if tuple(old.agg(*checks).first()) != tuple(spark.table(second).agg(*checks).first()):
        raise ValueError(f"{second} does not hold what {table} does")
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {second} RENAME TO {table}")
    spark.sql(f"DROP TABLE {former}")
    return changed


def widened(schema: StructType, columns: list[str] | None = None) -> StructType:
    """``schema`` with the given columns as BIGINT. Reading Parquet with it widens
    INT columns on the fly, so old files need no rewrite."""
    names = columns or COUNT_COLUMNS
    return StructType(
        [StructField(f.name, LongType(), f.nullable) if f.name in names else f for f in schema]
    )


def require_bigint(df: DataFrame, columns: list[str] | None = None) -> None:
    wrong = {
        c: df.schema[c].dataType.simpleString()
        for c in (columns or COUNT_COLUMNS)
        if c in df.columns and df.schema[c].dataType != LongType()
    }
    if wrong:
        raise TypeError(f"expected BIGINT columns: {wrong}")


def save_mart(
    df: DataFrame,
    name: str,
    settings: Settings,
    partitions: list[str] | None = None,
    seen: Observation | None = None,
    measures: list[Column] | None = None,
) -> DataFrame:
    """Overwrite one mart table and return it as read back. ``measures`` are taken of the rows as
    they are written, into ``seen``."""
    if partitions:
        df = df.hint("rebalance", *partitions)
    if seen is not None and measures:
        df = df.observe(seen, *measures)
    writer = df.write.mode("overwrite").format("parquet")
    writer = writer.option("path", settings.zone(f"{settings.mart_database}/{name}"))
    if partitions:
        writer = writer.partitionBy(*partitions)
    full_name = f"{settings.mart_database}.{name}"
    writer.saveAsTable(full_name)
    return df.sparkSession.table(full_name)
