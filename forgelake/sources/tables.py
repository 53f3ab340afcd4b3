"""Catalog table scans and source routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table with lower-case column names."""
    return lower_columns(spark.table(name))


def raw_source(spark: SparkSession, table: str, seed: DataFrame | None = None) -> DataFrame:
    """The same models run over a development seed, when given, or the raw table."""
    return seed if seed is not None else read_table(spark, table)
