"""Import every module that registers queries."""

from catalogue import files, models, payloads, records, streams, upkeep  # noqa: F401
