"""Writers, loads and scans."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from forgelake import jobs
from forgelake.plans import batch
from forgelake.schemas import EVENT, PROCESSED_ZONE, RAW_TABLE
from forgelake.settings import Settings, scratch_dir
from forgelake.sinks.files import append_raw, overwrite_partitions, write_csv, write_exports
from forgelake.sinks.kafka import kafka_write_options, keyed_messages
from forgelake.sinks.warehouse import (
    by_name, create_tables, load_rows, raw_table_name, replace_dates, require_bigint, widened,
)
from forgelake.sources.files import (
    read_parquet_tree, read_processed_dates, read_raw_date, read_raw_dates,
    read_seed_csv, with_path_column,
)
from forgelake.sources.kafka import kafka_options
from forgelake.sources.tables import raw_source, read_table


def rows_for(spark, *days, ids=("a", "b")):
    rows = [(f"{i}-{d}", "PushEvent", "o/r", dt.date(2024, 1, d)) for d in days for i in ids]
    return spark.createDataFrame(
        rows, "event_id string, event_type string, repo_name string, date_partition date"
    )


def test_load_is_idempotent_and_leaves_other_dates(spark, lake):
    create_tables(spark, lake)
    create_tables(spark, lake)
    table = raw_table_name(lake)
    load_rows(rows_for(spark, 1, 2), table)
    load_rows(rows_for(spark, 1, 2), table)
    assert spark.table(table).count() == 4
    load_rows(rows_for(spark, 2, ids=("c",)), table)
    assert sorted(r.event_id for r in spark.table(table).collect()) == ["a-1", "b-1", "c-2"]
    assert spark.table(table).columns == RAW_TABLE.names


def test_load_by_name(spark):
    df = spark.createDataFrame(
        [("7", "x", "9", ["a"])], "STARS string, Extra string, Event_Id string, Topics array<string>"
    )
    row = by_name(df).first()
    assert (row.stars, row.event_id, row.org, row.topics) == (7, "9", None, '["a"]')
    assert by_name(df).columns == RAW_TABLE.names


def test_load_aborts_on_bad_value_or_missing_key(spark):
    bad = spark.createDataFrame([("x", "1")], "stars string, event_id string")
    with pytest.raises(Exception, match="cannot load stars: x"):
        by_name(bad).collect()
    null = spark.createDataFrame([(None, "1")], "event_id string, repo_name string")
    with pytest.raises(Exception, match="event_id must not be null"):
        by_name(null, required=["event_id"]).collect()
    twins = spark.createDataFrame([("1", "2")], "org string, repo string").toDF("org", "ORG")
    with pytest.raises(ValueError):
        by_name(twins)


def test_overwrite_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(rows_for(spark, 1, 2), path, ["date_partition", "event_type"])
    overwrite_partitions(rows_for(spark, 2, ids=("z",)), path, ["date_partition", "event_type"])
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["a-1", "b-1", "z-2"]


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(400_000, numPartitions=8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
            F.when(F.col("id") % 10 < 9, "PushEvent").otherwise("ForkEvent").alias("event_type"),
        )
        overwrite_partitions(df, path, ["event_type"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")])
             for d in os.listdir(path) if d.startswith("event_type")}
    assert files["event_type=PushEvent"] >= 4
    assert spark.read.parquet(path).count() == 400_000


def test_path_value_from_file_name(spark, tmp_path):
    pq.write_table(pa.table({"event_id": ["1"]}), tmp_path / "event_type=PushEvent.parquet")
    folder = tmp_path / "event_type=ForkEvent"
    folder.mkdir()
    pq.write_table(pa.table({"event_id": ["2"]}), folder / "part-0.parquet")
    df = with_path_column(read_parquet_tree(spark, str(tmp_path)))
    assert {r.event_id: r.event_type for r in df.collect()} == {"1": "PushEvent", "2": "ForkEvent"}


def test_special_characters_survive_the_path(spark, tmp_path):
    kinds = ["a/b", "c d", "e%f", "g=h", "ü", "i+j", "50%"]
    df = spark.createDataFrame([(str(i), k) for i, k in enumerate(kinds)], "event_id string, event_type string")
    path = str(tmp_path / "t")
    df.write.partitionBy("event_type").parquet(path)
    back = with_path_column(read_parquet_tree(spark, path, df.drop("event_type").schema))
    assert sorted(r.event_type for r in back.collect()) == sorted(kinds)
    assert sorted(r.event_type for r in spark.read.parquet(path).collect()) == sorted(kinds)


def test_parquet_tree(spark, tmp_path):
    pq.write_table(pa.table({"a": ["1"], "b": ["2"]}), tmp_path / "x.parquet")
    (tmp_path / "deep").mkdir()
    pq.write_table(pa.table({"a": ["3"]}), tmp_path / "deep" / "y.parquet")
    merged = read_parquet_tree(spark, str(tmp_path))
    assert {(r.a, r.b) for r in merged.collect()} == {("1", "2"), ("3", None)}
    assert read_parquet_tree(spark, str(tmp_path), merged.schema).count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_parquet_tree(spark, str(empty), merged.schema).count() == 0
    with pytest.raises(AnalysisException):
        read_parquet_tree(spark, str(tmp_path / "missing"), merged.schema)


def test_csv_is_plain_rfc(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", ok', None, "", True)], "a string, b string, c string, d boolean")
    folder = write_csv(df, str(tmp_path / "out"), single_file=True)
    (part,) = [f for f in os.listdir(folder) if f.endswith(".csv")]
    with open(f"{folder}/{part}") as f:
        assert f.read() == 'a,b,c,d\n"say ""hi"", ok",,,true\n'


def test_exports_are_one_small_file_each(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    paths = write_exports({"n": df.groupBy("k").count().orderBy("k")}, str(tmp_path))
    assert paths == {"n": f"{tmp_path}/n.csv"} and [f for f in os.listdir(tmp_path) if not f.endswith(".crc")] == ["n.csv"]
    write_exports({"n": df.groupBy("k").count().orderBy("k")}, str(tmp_path))  # in place of the first
    lines = open(paths["n"]).read().splitlines()
    assert lines[0] == "k,count" and len(lines) == 8


def test_exports_write_whole_floats_as_whole_numbers(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.5, "a\nb"), (None, 2.0, 'q"')], "n double, x double, s string").orderBy("x")
    path = write_exports({"t": df}, str(tmp_path))["t"]
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).collect()
    assert [tuple(r) for r in rows] == [("1", "0.5", "a\nb"), (None, "2.0", 'q"')]


def test_seed_types(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('event_id,stars,pr_merged,text_content\n1,n/a,true,"a, ""b"""\n2,5,,\n')
    df = read_seed_csv(spark, str(tmp_path / "seed.csv"), ["event_id", "stars", "pr_merged", "text_content"])
    assert [tuple(r) for r in df.orderBy("event_id").collect()] == [
        ("1", None, True, 'a, "b"'), ("2", 5, None, None),
    ]
    assert raw_source(spark, "no.such_table", seed=df) is df


def test_widening_needs_no_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    narrow = spark.createDataFrame([(1, "a")], "stars int, event_id string")
    narrow.write.parquet(path)
    with pytest.raises(TypeError):
        require_bigint(narrow)
    wide = spark.read.schema(widened(narrow.schema)).parquet(path)
    require_bigint(wide)
    assert tuple(wide.first()) == (1, "a")


def test_messages(spark):
    df = spark.createDataFrame([("o/r", None, 1), ("", "ü", 2)], "repo_name string, org string, stars bigint")
    rows = [tuple(r) for r in keyed_messages(df).collect()]
    assert rows == [
        ("o/r", '{"repo_name":"o/r","org":null,"stars":1}'),
        (None, '{"repo_name":"","org":"ü","stars":2}'),
    ]
    written = kafka_write_options("h:1", "t")
    assert (written["kafka.acks"], written["kafka.compression.type"]) == ("all", "gzip")
    read = kafka_options("h:1", "t", max_offsets_per_trigger=200)
    assert (read["startingOffsets"], read["failOnDataLoss"], read["maxOffsetsPerTrigger"]) == (
        "latest", "false", "200",
    )


def record(**values):
    return tuple({"event_type": "PushEvent", "repo_name": "o/r", **values}.get(n) for n in EVENT.names)


def test_raw_to_processed_to_table(spark, lake):
    raw = spark.createDataFrame(
        [
            record(event_id="1", created_at="2024-01-01T10:00:00Z", ingested_at="2024-01-01T10:00:01Z"),
            record(event_id="1", created_at="2024-01-01T10:00:00Z", ingested_at="2024-01-01T10:00:09Z", stars=4),
            record(event_id="2", created_at="2024-01-02T07:00:00Z", topics=["x"]),
            record(event_id="3", created_at="garbage", event_type=None),
        ],
        EVENT,
    )
    assert append_raw(raw, lake.raw_zone, F.lit("2024-01-02 01:00:00").cast("timestamp")) == 4
    assert os.path.isdir(f"{lake.raw_zone}/date=2024-01-02/hour=07/event_type=PushEvent")
    assert os.path.isdir(f"{lake.raw_zone}/date=2024-01-02/hour=01/event_type=Unknown")
    assert read_raw_dates(spark, lake.raw_zone, "2024-01-01").count() == 2
    one = read_raw_date(spark, lake.raw_zone, "2024-01-01")
    assert [(str(r.date), r.hour) for r in one.collect()] == [("2024-01-01", "10")] * 2
    with pytest.raises(AnalysisException):
        read_raw_date(spark, lake.raw_zone, "2024-01-09")

    counts = batch.process_dates(spark, lake, "2024-01-01", "2024-01-02")
    assert counts == {"raw_rows": 4, "processed_rows": 3}
    rows = {r.event_id: r for r in read_processed_dates(spark, lake.processed_zone, "2024-01-01", "2024-01-02").collect()}
    assert (rows["1"].stars, rows["1"].pr_number, rows["2"].topics, rows["1"].topics) == (4, 0, '["x"]', "[]")

    create_tables(spark, lake)
    for replaced in (0, 3):
        counts = batch.load_dates(spark, lake, "2024-01-01", "2024-01-02", dedup=replaced > 0)
        assert counts == {"loaded_rows": 3, "replaced_rows": replaced}
    assert read_table(spark, raw_table_name(lake)).count() == 3
    missing = jobs.dry_run(spark, lake, "2024-01-01", "2024-01-03").collect()
    assert {str(r.date): (r.rows, r.missing) for r in missing} == {
        "2024-01-01": (1, False), "2024-01-02": (2, False), "2024-01-03": (0, True),
    }


def test_late_events_are_reprocessed(spark, lake):
    def deliver(event_id, day):
        rows = [record(event_id=event_id, created_at=f"2024-01-0{day}T00:00:00Z")]
        append_raw(spark.createDataFrame(rows, EVENT), lake.raw_zone)

    deliver("1", 1)
    deliver("2", 2)
    batch.process_dates(spark, lake, "2024-01-01", "2024-01-02")
    since = dt.datetime.now(dt.timezone.utc)
    assert batch.reprocess_since(spark, lake, since) == {"raw_rows": 0, "processed_rows": 0}
    deliver("late", 1)
    assert batch.reprocess_since(spark, lake, since) == {"raw_rows": 2, "processed_rows": 2}
    ids = read_processed_dates(spark, lake.processed_zone, "2024-01-01", "2024-01-02").select("event_id")
    assert sorted(r.event_id for r in ids.collect()) == ["1", "2", "late"]


def test_a_type_that_vanished_from_a_date_goes(spark, lake, api_rows):
    def page(kind):
        return {"id": kind, "type": kind, "repo": {"name": "o/r"}, "created_at": "2024-01-01T00:00:00Z"}

    for kinds, date in ((["PushEvent", "ForkEvent"], "2024-01-01"), (["ForkEvent"], "2024-01-02"),
                        (["PushEvent"], "2024-01-01")):
        api_rows(*map(page, kinds)).write.mode("overwrite").json(lake.zone("landing"))
        batch.fetch_date(spark, lake, lake.zone("landing"), date)
    rows = read_processed_dates(spark, lake.processed_zone, "2024-01-01", "2024-01-02").collect()
    assert sorted((str(r.date), r.event_type) for r in rows) == [
        ("2024-01-01", "PushEvent"), ("2024-01-02", "ForkEvent"),
    ]


def test_daily_run_end_to_end(spark, lake):
    rows = [
        record(event_id=str(i), actor=f"a{i % 3}", created_at=f"2024-01-01T0{i}:00:00Z", commit_count=i,
               ingested_at="2024-01-01T12:00:00Z")
        for i in range(6)
    ]
    append_raw(spark.createDataFrame(rows, EVENT), lake.raw_zone)
    for replaced in (0, 6):
        stages = jobs.daily(spark, lake, "2024-01-01").collect()
        report = {r.stage: (r.rows, r.status) for r in stages}
        assert report["raw_rows"] == (6, "done") and report["loaded_rows"] == (6, "done")
        assert report["replaced_rows"] == (replaced, "done")
        assert report["checks"][1] == "passed"
    assert {n: df.count() for n, df in jobs.saved_marts(spark, lake).items()} == {
        "fact_commits": 6, "fact_prs": 0, "dim_repos": 1, "dim_contributors": 3,
    }
    paths = jobs.export(spark, lake, days=40000)
    assert set(paths) == {"dim_repos", "dim_contributors", "fact_commits", "fact_prs"}
    top = spark.read.option("header", True).csv(paths["dim_contributors"])
    assert top.count() == 3


def test_settings():
    s = Settings.from_mapping({"FORGELAKE_ROOT": "gs://b/x/", "FORGELAKE_TRACKED_REPOS": "a/b, c/d,", "FORGELAKE_EXPORT_DAYS": "30", "ROOT": "1"})
    assert (s.raw_zone, s.tracked_repos, s.export_days) == ("gs://b/x/raw", ["a/b", "c/d"], 30)
    assert len(Settings().tracked_repos) == 10


def test_command_line_covers_every_stage():
    args = jobs.parser().parse_args(["load", "--date", "2024-01-01", "--dry-run"])
    assert (args.stage, args.dry_run) == ("load", True)
    assert jobs.parser().parse_args(["process"]).date == batch.yesterday()


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path.startswith(f"{shared}/forgelake/x-") if shared else os.path.isdir(path)
    assert path != scratch_dir(spark, "x")


def test_processed_zone_is_the_raw_table_by_date():
    assert set(PROCESSED_ZONE.names) ^ set(RAW_TABLE.names) == {"date", "date_partition"}
    assert replace_dates.__doc__
