"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.session import ENGINE_CONF
from forgelake.settings import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name, with ``sql`` as its twin."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
                spark.conf.set(key, ENGINE_CONF[key])
            return portable(f(spark, sf_dir))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps without zone, so that both engines hand the
    same values to a client whatever its time zone."""
    changes = {}
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind == "date":
            changes[f.name] = F.col(f.name).cast("string")
        elif kind == "timestamp":
            changes[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changes) if changes else df


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` through a Parquet table in the scratch folder."""
    path = scratch_dir(df.sparkSession, label) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
