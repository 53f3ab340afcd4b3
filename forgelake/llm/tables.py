"""Reading and writing tables for the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.settings import scratch_dir

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
_BITS, _CHUNK = 16, 1 << 15  # bits of the bitmap for each key that is sought; bits in a row of it
_CHUNKS = 2048  # 8 MB
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later uses neither
    compute it again nor depend on the executors that did. What was shuffled for it is deleted at once, not
    when the driver happens to collect its garbage; Spark computes it again if ``df`` itself is used later."""
    path = scratch_dir(df.sparkSession, label) + "/data"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, after the last job that reads them."""
    for df in tables:
        hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs  # DataFrames cannot delete files
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = hadoop.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def sifted(df: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` hashes to a place that a key of ``wanted(column)`` has: all that are
    wanted and a few others, so that an exact join behind it need not shuffle the rest. The places
    are a broadcast bitmap, which stays below 8 MB; beyond 4 million keys more others pass."""
    chunks = min(_CHUNKS, wanted.count() * _BITS // _CHUNK + 1)
    place = F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(chunks * _CHUNK))
    chunk, bits = free_names(df.columns, "chunk", "bits")
    at, within = F.floor(place / _CHUNK).cast("int"), place % _CHUNK
    # As numbers of eight bytes, the first of them highest: a row reads one of them, and copies no chunk.
    number = F.transform(
        F.sequence(F.lit(0), F.lit(_CHUNK // 64 - 1)),
        lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"),
    )
    bitmap = wanted.groupBy(at.alias(chunk)).agg(F.bitmap_construct_agg(within).alias(bits)).select(chunk, number.alias(bits))
    bit = 56 - F.floor(within % 64 / 8) * 8 + within % 8
    hit = F.bit_get(F.get(bits, F.floor(within / 64).cast("int")), bit.cast("int")) == 1
    found = df.withColumn(chunk, at).join(F.broadcast(bitmap), chunk).where(hit)
    return found.select(*(F.col(f"`{c}`") for c in df.columns))


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names that clash with none of ``taken``, in any case."""
    used = {c.lower() for c in taken}
    found = []
    for name in wanted:
        while name.lower() in used:
            name = f"{name}_"
        used.add(name.lower())
        found.append(name)
    return found


def shipped(spark: SparkSession) -> None:
    """Give the package to the executors' Python once per application, as ``--py-files``
    would, for sessions that were not started with it."""
    context = spark.sparkContext
    if getattr(context, "_forgelake_shipped", None):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "forgelake.zip")  # read by the driver alone
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(target)
    context._forgelake_shipped = True
