"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for null inside a hashed key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 of the columns' text joined by ``-``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))
