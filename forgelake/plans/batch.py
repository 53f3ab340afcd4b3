"""Daily runs. Each takes one date or an inclusive range and replaces what an earlier
run of the same dates wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators.dedup import newest_copy
from forgelake.operators.enrich import coerce_types, enrich, with_date_partition
from forgelake.operators.metrics import counted
from forgelake.operators.normalise import normalise_daily
from forgelake.schemas import PROCESSED_ZONE, RAW_TABLE
from forgelake.settings import Settings
from forgelake.sinks.files import overwrite_dates
from forgelake.sinks.ledger import dates_noted_since, ledger_exists
from forgelake.sinks.warehouse import load_rows, raw_table_name
from forgelake.sources.files import (
    dates_touched_since,
    listed_dates,
    read_api_events,
    read_listed_dates,
    read_processed_dates,
)


def yesterday() -> str:
    return str(dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1))


def processed(raw: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Deduplicated and enriched rows of the raw zone. Copies are sought within a
    date, as separate runs of the dates would."""
    unique = newest_copy(raw, keys=["date", "event_id"])
    return coerce_types(enrich(unique, processed_at)).select(PROCESSED_ZONE.names)


def process_dates(
    spark: SparkSession,
    settings: Settings,
    start: str | None = None,
    end: str | None = None,
    processed_at: Column | None = None,
) -> dict[str, int]:
    """Raw zone to processed zone for one date or a range; returns the rows read and
    written. Dates without raw rows are left as they are."""
    days = listed_dates(spark, settings.raw_zone, start or yesterday(), end)
    return _process_days(spark, days, settings, processed_at)


def reprocess_since(
    spark: SparkSession,
    settings: Settings,
    since: dt.datetime,
    processed_at: Column | None = None,
) -> dict[str, int]:
    """Process again every date that got raw rows after ``since``, which is how late events
    reach the processed zone. The batches' ledger tells the dates; a zone filled without one
    is asked for its files' times."""
    touched = dates_noted_since(spark, settings.ledger, since)
    if not ledger_exists(spark, settings.ledger):
        touched = dates_touched_since(spark, settings.raw_zone, since)
    days = sorted(str(row.date) for row in touched.collect())  # a calendar's worth
    return _process_days(spark, days, settings, processed_at)


def _process_days(
    spark: SparkSession, days: list[str], settings: Settings, processed_at: Column | None
) -> dict[str, int]:
    """All dates in one job, which replaces each of them whole, so that a type a date no
    longer has goes too; running it again gives the same zone."""
    if not days:
        return {"raw_rows": 0, "processed_rows": 0}
    raw, read = counted(read_listed_dates(spark, settings.raw_zone, days))
    out, written = counted(processed(raw, processed_at))
    overwrite_dates(out, settings.processed_zone, days)
    return {"raw_rows": read.get["rows"], "processed_rows": written.get["rows"]}


def daily_rows(
    events: DataFrame,
    date: str,
    now: Column | None = None,
    tie_break: list[Column | str] | None = None,
) -> DataFrame:
    """API events to processed rows labelled with the run's date. Of the copies of one fetch, all
    equally fresh, a typed one stays, then the one ``tie_break`` names."""
    rows = coerce_types(normalise_daily(events, now))
    typed = F.when(F.col("event_type") != "", 0).otherwise(1)
    rows = newest_copy(rows, tie_break=[typed, *(tie_break or [F.xxhash64(*rows.columns)])]).withColumn("date", F.lit(date).cast("date"))
    return rows.select(PROCESSED_ZONE.names)


def fetch_date(
    spark: SparkSession, settings: Settings, landed: str, date: str | None = None
) -> dict[str, int]:
    """Landed API pages straight to the processed zone of one date."""
    label = date or str(dt.datetime.now(dt.timezone.utc).date())
    out, written = counted(daily_rows(read_api_events(spark, landed), label))
    overwrite_dates(out, settings.processed_zone, [label])
    return {"processed_rows": written.get["rows"]}


def load_dates(
    spark: SparkSession,
    settings: Settings,
    start: str | None = None,
    end: str | None = None,
    dedup: bool = False,
) -> dict[str, int]:
    """Processed zone to raw table; returns the rows loaded and the stale rows of the
    same dates they replaced. The processed zone already holds one copy per event and
    date; ``dedup`` is for zones filled by other writers."""
    table = raw_table_name(settings)
    rows = read_processed_dates(spark, settings.processed_zone, start or yesterday(), end)
    rows = with_date_partition(rows, F.col("date")).drop("date")
    # Both sides are partition columns, so counting reads file footers only.
    dates = rows.select("date_partition").distinct()
    replaced = spark.table(table).join(dates, "date_partition", "left_semi").count()
    if dedup:
        rows = newest_copy(rows, keys=["date_partition", "event_id"])
    out, loaded = counted(coerce_types(rows).select(RAW_TABLE.names))
    load_rows(out, table, f"{settings.zone('rejected')}/code_events")
    return {"loaded_rows": loaded.get["rows"], "replaced_rows": replaced}
