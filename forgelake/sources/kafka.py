"""Message-broker scan. Needs the public spark-sql-kafka package on the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Start at the latest offset on first run only; later runs resume from the
    checkpoint. ``min_partitions`` splits few large topic partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **limits)).load()
