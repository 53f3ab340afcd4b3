"""Rules mended: rejects, migration, range runs, metadata order, casts, flat files, seeds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from forgelake import jobs
from forgelake.functions import date_or_null, flag, int_or_null, timestamp_or_null
from forgelake.operators.enrich import coerce_types
from forgelake.operators.lookup import with_repo_meta
from forgelake.operators.quality import MART_CHECKS, check_tables
from forgelake.plans import batch
from forgelake.plans.publish import publish
from forgelake.schemas import PROCESSED_ZONE, RAW_TABLE
from forgelake.sinks.files import append_raw, overwrite_dates
from forgelake.sinks.warehouse import (
    LoadRejected,
    create_databases,
    create_tables,
    load_rows,
    raw_table_name,
    widen_table,
)
from forgelake.sources.files import read_processed_dates, read_seed_csv
from forgelake.sources.tables import raw_source


def typed(raw_rows, *rows):
    return coerce_types(raw_rows(*rows)).withColumn("date_partition", date_or_null("date_partition"))


def test_rejected_rows_are_kept_and_nothing_is_replaced(spark, lake, raw_rows):
    create_tables(spark, lake)
    table, rejects = raw_table_name(lake), lake.zone("rejects")
    good = {"event_id": "1", "date_partition": "2024-01-01"}
    load_rows(typed(raw_rows, good), table, rejects)
    assert not os.path.exists(rejects)
    bad = typed(raw_rows, {**good, "stars": "9"}, {**good, "event_id": None}, {**good, "event_id": None, "repo_name": None})
    with pytest.raises(LoadRejected, match="2 rows"):
        load_rows(bad, table, rejects)
    assert [r.stars for r in spark.table(table).collect()] == [0]
    kept = spark.read.parquet(rejects).collect()
    assert sorted(r.missing_columns for r in kept) == [["event_id"], ["event_id", "repo_name"]]
    assert all(r.rejected_at is not None for r in kept)
    with pytest.raises(Exception, match="must not be null"):
        load_rows(bad, table)


def narrow_table(spark, lake, name, partitioned=True):
    create_databases(spark, lake, lake.raw_database)
    split = "PARTITIONED BY (d)" if partitioned else ""
    table = f"{lake.raw_database}.{name}"
    spark.sql(f"CREATE TABLE {table} (id STRING, stars INT, d STRING) USING parquet {split} LOCATION '{lake.zone(name)}'")
    spark.sql(f"INSERT INTO {table} VALUES ('a', 1, 'x'), ('b', NULL, 'x'), ('c', 2147483647, 'y')")
    return table


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_table_is_widened_in_place(spark, lake, partitioned):
    table = narrow_table(spark, lake, "t", partitioned)
    assert widen_table(spark, table, lake.zone("t2"), ["stars"]) == ["stars"]
    assert dict(spark.table(table).dtypes)["stars"] == "bigint"
    spark.sql(f"INSERT INTO {table} VALUES ('d', 5000000000, 'z')")
    assert sorted(map(tuple, spark.table(table).select("id", "stars", "d").collect()), key=str) == [
        ("a", 1, "x"), ("b", None, "x"), ("c", 2147483647, "y"), ("d", 5000000000, "z"),
    ]
    assert widen_table(spark, table, lake.zone("t3"), ["stars"]) == []
    assert not spark.catalog.tableExists(f"{table}__narrow") and not spark.catalog.tableExists(f"{table}__wide")


def test_a_migration_that_failed_is_taken_up_again(spark, lake):
    table = narrow_table(spark, lake, "t")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__narrow")  # between the renamings
    spark.sql(f"CREATE TABLE {table}__wide (id STRING) USING parquet LOCATION '{lake.zone('junk')}'")
    assert spark.catalog.tableExists(f"{table}__narrow")
    assert widen_table(spark, table, lake.zone("t2"), ["stars"]) == ["stars"]
    assert spark.table(table).count() == 3
    with pytest.raises(TypeError):
        widen_table(spark, table, lake.zone("t3"), ["id"])


def processed(spark, *rows):
    df = spark.createDataFrame(list(rows), "event_id string, event_type string, date string")
    names = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESSED_ZONE]
    return df.select(names)


def test_a_range_is_replaced_whole_and_alone(spark, lake):
    zone = lake.processed_zone
    overwrite_dates(processed(spark, ("1", "A", "2024-01-01"), ("2", "B", "2024-01-01"), ("3", "A", "2024-01-02"), ("4", "", "2024-01-03")), zone, ["2024-01-01", "2024-01-02", "2024-01-03"])
    for _ in range(2):
        overwrite_dates(processed(spark, ("5", "A", "2024-01-01")), zone, ["2024-01-01", "2024-01-02"])
        rows = read_processed_dates(spark, zone, "2024-01-01", "2024-01-03").collect()
        assert sorted((r.event_id, r.event_type, str(r.date)) for r in rows) == [("4", "", "2024-01-03"), ("5", "A", "2024-01-01")]


def test_a_backfill_is_one_job_for_all_dates(spark, lake, raw_rows):
    rows = [{"event_id": str(i), "created_at": f"2024-01-0{i % 5 + 1}T00:00:00Z"} for i in range(20)]
    append_raw(raw_rows(*rows).select("event_id", "event_type", "actor", "repo_name", "created_at", "ingested_at"), lake.raw_zone)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("backfill", "")
    counts = batch.process_dates(spark, lake, "2024-01-01", "2024-01-04")
    jobs_run = len(tracker.getJobIdsForGroup("backfill"))
    spark.sparkContext.setJobGroup("", "")
    assert counts == {"raw_rows": 16, "processed_rows": 16}
    assert jobs_run <= 6  # listing, shuffle stages and the write, whatever the dates' number
    assert batch.process_dates(spark, lake, "2030-01-01") == {"raw_rows": 0, "processed_rows": 0}


META = "repo_name string, language string, stars bigint, forks bigint, open_issues bigint, topics array<string>, description string, fetched_at string"


def test_metadata_counts_by_its_order(spark):
    df = spark.createDataFrame([("o/r",), ("x/y",), (None,)], "repo_name string")
    meta = spark.createDataFrame([("o/r", "Go", 9, 0, 0, [], "", "2024-01-01"), ("o/r", "C", 5, 0, 0, [], "", "2024-01-02")], META)
    got = {r.repo_name: r.meta.stars for r in with_repo_meta(df, meta, newest_by="fetched_at").collect()}
    assert got == {"o/r": 5, "x/y": 0, None: 0}
    with pytest.raises(Exception, match="several rows"):
        with_repo_meta(df, meta).collect()
    one = meta.limit(1)
    assert {r.meta.stars for r in with_repo_meta(df, one).collect()} == {9, 0}
    plan = with_repo_meta(df, one, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_casts_leave_typed_columns_alone(spark):
    df = spark.sql("SELECT 5 AS n, true AS b, TIMESTAMP '2024-01-02 03:04:05' AS t, DATE '2024-01-02' AS d, '5.5' AS s")
    kind = {f.name: f.dataType for f in df.schema}
    row = df.select(
        int_or_null("n", kind["n"]).alias("n"), flag("b", kind["b"]).alias("b"), timestamp_or_null("t", kind["t"]).alias("t"),
        date_or_null("d", kind["d"]).alias("d"), date_or_null("t", kind["t"]).alias("td"), int_or_null("s", kind["s"]).alias("s"),
    ).first()
    assert tuple(row) == (5, True, dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), dt.date(2024, 1, 2), 6)
    plan = df.select(timestamp_or_null("t", kind["t"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan


def test_row_checks_are_taken_by_the_write(spark, lake, raw_rows):
    rows = [{"event_id": str(i), "commit_count": str(i - 1), "event_type": "PushEvent"} for i in range(4)]
    measured = {}
    marts = publish(raw_rows(*rows), lake, measured=measured)
    from_write, by_scan = check_tables(marts, MART_CHECKS, measured), check_tables(marts, MART_CHECKS)
    assert sorted(map(tuple, from_write.collect())) == sorted(map(tuple, by_scan.collect()))
    assert [r.failures for r in from_write.where("check_name = 'accepted_range' AND table_name = 'fact_commits'").collect()] == [1]


def test_flat_files_take_their_type_from_the_path(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "event_id string").coalesce(1)
    df.write.parquet(str(tmp_path / "w"))
    folder = tmp_path / "zone" / "date=2024-01-01"
    folder.mkdir(parents=True)
    (part,) = (tmp_path / "w").glob("part-*.parquet")
    part.rename(folder / "event_type=ForkEvent.parquet")
    (row,) = read_processed_dates(spark, str(tmp_path / "zone"), "2024-01-01").collect()
    assert (row.event_id, row.event_type, str(row.date)) == ("1", "ForkEvent", "2024-01-01")
    assert read_processed_dates(spark, str(tmp_path / "none"), "2024-01-01").count() == 0


def test_seed_with_line_breaks_and_routing(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('event_id,stars,text_content\n1,12.0,"two\nlines"\n2,x,"say ""hi"""\n')
    seed = read_seed_csv(spark, str(path), ["event_id", "stars", "text_content"])
    assert [tuple(r) for r in seed.orderBy("event_id").collect()] == [("1", 12, "two\nlines"), ("2", None, 'say "hi"')]
    plain = tmp_path / "plain.csv"
    plain.write_text("event_id,stars\n1,3\n")
    assert read_seed_csv(spark, str(plain), ["event_id", "stars"], line_breaks=False).first().stars == 3
    assert raw_source(spark, "no.such_table", seed) is seed


def test_a_failing_daily_run_ends_in_an_error(spark, lake, raw_rows):
    row = {"event_id": "1", "event_type": "PullRequestEvent", "action": "opened"}
    report = spark.createDataFrame([("d", "checks", 1, "failed")], "run_date string, stage string, rows bigint, status string")
    with pytest.raises(ValueError):
        jobs.require_success(report)
    names = ["event_id", "event_type", "action", "actor", "repo_name", "created_at", "ingested_at"]
    append_raw(raw_rows(row).select(names), lake.raw_zone)
    report = jobs.daily(spark, lake, "2024-01-02", incremental=True)
    counts = {r.stage: r["rows"] for r in report.collect()}
    assert counts["fact_prs"] == 1 and counts["dim_repos"] == 1 and counts["loaded_rows"] == 1
    assert RAW_TABLE.names
