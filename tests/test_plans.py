"""The physical plans are the intended ones."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogue.adapter import raw_events
from catalogue.models import stg
from forgelake.operators.dedup import any_copy, newest_copy
from forgelake.operators.quality import MART_CHECKS, check_table
from forgelake.plans.marts import dim_contributors, dim_repos, fact_commits
from forgelake.plans.staging import stg_events, stg_push
from forgelake.schemas import RAW_TABLE
from forgelake.sinks.files import append_raw
from forgelake.sources.files import read_raw_dates

SF = "/root/testdata/sf0.001"


def plan(df):
    """Physical plan text, with scan details in full."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def raw_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], RAW_TABLE).write.parquet(path)
    return spark.read.schema(RAW_TABLE).parquet(path)


def test_dedup_cuts_copies_before_its_only_shuffle(raw_table):
    text = plan(stg_events(raw_table))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("WindowGroupLimit") == 2
    before, after = text.split("Exchange hashpartitioning")
    assert "Final" in before and "Partial" in after
    assert "IsNotNull(event_id)" in text


def test_unread_columns_are_pruned_through_the_dedup(raw_table):
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", plan(dim_contributors(stg_events(raw_table))))
    for unread in ("text_content", "description", "org", "ref_name", "topics"):
        assert unread not in schema


def test_dimensions_scan_once_and_never_join(raw_table):
    for dim in (dim_repos, dim_contributors):
        text = plan(dim(stg_events(raw_table)))
        assert text.count("FileScan") == 1
        assert "Join" not in text
        assert "hashpartitioning(repo_name" in text and "actor" in text


def test_facts_add_no_shuffle(raw_table):
    assert plan(fact_commits(stg_events(raw_table))).count("Exchange") == 1


def test_slices_of_staged_events_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "stg")
    events = stg(spark, SF)
    events.write.partitionBy("event_type").parquet(path)
    staged = spark.read.schema(events.schema).parquet(path)
    assert "PartitionFilters: [isnotnull(event_type" in plan(stg_push(staged))


def test_date_scan_prunes(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_raw(raw_events(spark, SF).select("event_id", "event_type", "created_at"), path)
    text = plan(read_raw_dates(spark, path, "2024-01-01", "2024-01-02"))
    assert re.search(r"PartitionFilters: \[isnotnull\(date", text)


def test_drop_duplicates_aggregates_first(spark):
    text = plan(any_copy(raw_events(spark, SF)))
    assert "partial_first" in text


def test_unique_checks_share_one_scan(raw_table):
    facts = fact_commits(stg_events(raw_table))
    uniques = [c for c in MART_CHECKS["fact_commits"] if c.kind == "unique"]
    assert len(uniques) == 2
    assert plan(check_table("t", facts, uniques)).count("FileScan") == 1


def test_no_python_and_no_cross_product_anywhere(spark):
    lazy = [
        "stg_events", "dim_repos", "dim_contributors", "kpi_totals", "pr_status_breakdown",
        "top_repos_200", "repo_meta_lookup", "repo_meta_lookup_salted", "normalise_push",
        "normalise_texts", "daily_normalise_texts", "normalise_events", "ingest_counters",
        "tracked_only", "tracked_table_flag", "coerce_types", "parse_json_messages",
    ]
    for name in lazy:
        text = plan(entry.queries()[name](spark, SF))
        for banned in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
            assert banned not in text, (name, banned)


def test_library_has_no_udf_and_no_local_checkpoint():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sources = [p for p in glob.glob(f"{root}/forgelake/**/*.py", recursive=True) if f"{os.sep}llm{os.sep}" not in p]
    assert len(sources) > 20
    for path in sources:
        source = open(path).read()
        for banned in ("localCheckpoint", "toPandas", "pandas_udf", "F.udf", ".rdd", "crossJoin", "broadcast("):
            assert banned not in source, (path, banned)


@pytest.mark.parametrize("hot", ["event", "repo", "actor"])
def test_a_hot_key_changes_nothing(spark, hot):
    """A third of all rows on one key: same answer as plain Python."""
    n = 3000
    rows = []
    for i in range(n):
        on = i % 3 == 0
        rows.append((
            "hot" if on and hot == "event" else str(i),
            "o/hot" if on and hot == "repo" else f"o/{i % 50}",
            "bot" if on and hot == "actor" else f"a{i % 70}",
            f"2024-01-{i % 28 + 1:02d}T00:00:00Z",
            f"2024-02-01T{i % 24:02d}:{i % 60:02d}:00Z",
        ))
    names = ["event_id", "repo_name", "actor", "created_at", "ingested_at"]
    df = spark.createDataFrame(rows, names).withColumn("event_type", F.lit("PushEvent"))
    full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in RAW_TABLE.names])

    newest = {}
    for r in rows:
        if r[0] not in newest or r[4] > newest[r[0]][4]:
            newest[r[0]] = r
    kept = list(newest.values())
    got = newest_copy(df).select("event_id", "ingested_at").collect()
    assert sorted((r.event_id, r.ingested_at) for r in got) == sorted((r[0], r[4]) for r in kept)

    per_repo, per_actor = {}, {}
    total_repo, total_actor = {}, {}
    for r in kept:
        per_repo.setdefault(r[1], set()).add(r[2])
        per_actor.setdefault(r[2], set()).add(r[1])
        total_repo[r[1]] = total_repo.get(r[1], 0) + 1
        total_actor[r[2]] = total_actor.get(r[2], 0) + 1
    if hot != "event":  # which of the hot event's tied copies survives is arbitrary
        stg_ = stg_events(full)
        assert {r.repo_name: (r.total_events, r.unique_contributors) for r in dim_repos(stg_).collect()} == {
            k: (total_repo[k], len(v)) for k, v in per_repo.items()
        }
        assert {r.actor: (r.total_events, r.repos_contributed_to) for r in dim_contributors(stg_).collect()} == {
            k: (total_actor[k], len(v)) for k, v in per_actor.items()
        }


def test_marts_agree_with_staging(spark):
    events = stg(spark, SF)
    assert dim_repos(events).agg(F.sum("total_events")).first()[0] == events.count()
