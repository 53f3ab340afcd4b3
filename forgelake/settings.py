"""Where data lives and how a run is configured."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

from forgelake.schemas import DEFAULT_TRACKED


ENVIRONMENT = "FORGELAKE_"


@dataclass(frozen=True)
class Settings:
    """One run's configuration; every field has a working default."""

    root: str = "./data/lake"  # a local path is made absolute
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "code-events"
    trigger: str = "30 seconds"
    dedup_delay: str = "1 day"
    tracked_repos: list[str] = field(default_factory=lambda: list(DEFAULT_TRACKED))
    export_days: int = 14
    # Limits of a stream's batches and the partitions of its state, fixed at first start;
    # 0 leaves each to the source or the session.
    max_offsets: int = 0
    max_files: int = 0
    state_partitions: int = 0
    # Buckets of tables kept by event id or by (repository, actor), fixed at their creation;
    # 0 takes the session's shuffle partitions.
    buckets: int = 0
    raw_database: str = "raw"
    staging_database: str = "staging"
    mart_database: str = "mart"

    def __post_init__(self) -> None:
        # The catalog resolves a relative location against its warehouse, file writers
        # against the working folder.
        if "://" not in self.root and not self.root.startswith("file:"):
            object.__setattr__(self, "root", os.path.abspath(self.root))

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> Settings:
        """Build from ``FORGELAKE_`` and the upper-cased field name, e.g. out of
        ``os.environ``; other keys are ignored."""
        known = {}
        for f in fields(cls):
            raw = values.get(ENVIRONMENT + f.name.upper())
            if raw is None:
                continue
            if f.name == "tracked_repos":
                known[f.name] = [r.strip() for r in raw.split(",") if r.strip()]
            elif f.type in ("int", int):
                known[f.name] = int(raw)
            else:
                known[f.name] = raw
        return cls(**known)

    def zone(self, name: str) -> str:
        """URI of a zone; ``root`` may be a local path or any Hadoop filesystem URI."""
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw_zone(self) -> str:
        return self.zone("raw")

    @property
    def ledger(self) -> str:
        return self.zone("ledger")

    @property
    def processed_zone(self) -> str:
        return self.zone("processed")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, reachable by every executor.

    It lies under ``spark.checkpoint.dir``, which the cluster sets, or else under the
    warehouse, which all executors write tables to.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/forgelake/{label}-{uuid.uuid4().hex}"
