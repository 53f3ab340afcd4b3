"""Message-topic writer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_messages(df: DataFrame, key: str = "repo_name") -> DataFrame:
    """(key, value) messages: the key keeps a repository's events in order within one
    topic partition, the value is the whole record as JSON, nulls included."""
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(
        F.when(F.col(key) != "", F.col(key)).alias("key"), record.alias("value")
    )


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.compression.type": "gzip",
    }


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: str):
    return (
        keyed_messages(df)
        .writeStream.format("kafka")
        .options(**kafka_write_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )
