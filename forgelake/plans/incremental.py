"""Publishing what changed: staging, facts and dimensions after some dates were loaded again.

Tables kept between runs, all in the catalog:

- ``event_copies``: the newest copy of each event per ``date_partition``, partitioned by that date
  and bucketed by event id. Finding an event's newest copy shuffles new rows only.
- ``stg_events``: the staged events, partitioned by ``event_date``.
- ``activity_state``: partial rollups per (repository, actor), which deltas are merged into.
- ``pr_state``: pull-request events per (event date, status, repository, number).
- the marts.

A run takes the touched dates and asks only about the events that have or had a copy in them. Of
the other dates just those are read that hold further copies of these events, and
only the event dates of these copies are written again. Every event whose staged row changes is
taken back from its (repository, actor) state and added to its new one. Counts and sums are
subtracted; where what is taken back was a group's first or newest event and nothing newer
came in its place, the group alone is rolled up from staging again.

The run can be repeated after a failure at any point: the ids in question are written first
and cleared last, and a new generation of the state is written beside the old one. If a run
left two generations, the one whose fingerprint is that of staging counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.functions import date_or_null, pr_status
from forgelake.operators.dedup import newest_copy
from forgelake.operators.rollups import REPO_SNAPSHOT, activity_by_repo_actor
from forgelake.plans.exports import EXPORT_DAYS, breakdown_per_repo, trailing_days
from forgelake.plans.marts import dim_contributors, dim_repos, fact_commits, fact_prs
from forgelake.plans.staging import EARLIEST, LATEST, later_load_wins, stg_events, stg_pr
from forgelake.settings import Settings
from forgelake.sinks.files import Scratch, remove_folder
from forgelake.sinks.warehouse import create_databases, drop_partition, replace_partitions, save_mart

GROUP = ["repo_name", "actor"]


def _name(settings: Settings, table: str) -> str:
    database = settings.staging_database if table in ("event_copies", "stg_events") else settings.mart_database
    return f"{database}.{table}"


def _create(df: DataFrame, settings: Settings, table: str, partition: str, bucket: list[str] | None = None) -> None:
    """An empty table of ``df``'s columns, ``partition`` last, unless there is one."""
    spark, name = df.sparkSession, _name(settings, table)
    if spark.catalog.tableExists(name):
        return
    columns = [f for f in df.schema if f.name != partition] + [df.schema[partition]]
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    buckets = settings.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clustered = f"CLUSTERED BY ({', '.join(bucket)}) SORTED BY ({', '.join(bucket)}) INTO {buckets} BUCKETS" if bucket else ""
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet PARTITIONED BY ({partition}) {clustered} "
        f"LOCATION '{settings.zone(name.replace('.', '/'))}'"
    )


def _bucketed(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows dealt as the table's buckets are, for one file per bucket and partition."""
    spark = df.sparkSession
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return df.repartition(int(described["data_type"]), *keys)


def _in(column: str, dates: list[str]) -> Column:
    """A filter that prunes partitions."""
    return F.col(column).isin([F.lit(d).cast("date") for d in dates]) if dates else F.lit(False)


def newest_per_date(raw: DataFrame, tie_break: list[Column | str] | None = None) -> DataFrame:
    """The newest copy of each event and ``date_partition``. The newest of these is the newest of
    all, as one order decides both times."""
    identified = raw.where("event_id IS NOT NULL")
    return newest_copy(identified, ["event_id", "date_partition"], tie_break or later_load_wins(raw.schema))


def winners(copies: DataFrame, ids: DataFrame, tie_break: list[Column | str] | None = None) -> DataFrame:
    """Staged rows of the events in ``ids``. ``copies`` being bucketed by event id, only the ids
    are shuffled."""
    return stg_events(copies.join(ids, "event_id", "left_semi"), tie_break)


def fingerprint() -> Column:
    """Of an event's contribution to its group; additive over events."""
    measured = ["event_id", "created_at", "event_type", "commit_count", "is_merge", *GROUP]
    return F.pmod(F.xxhash64(*measured), F.lit(1 << 31))


def state_of(stg: DataFrame) -> DataFrame:
    """State of every (repository, actor), from staged events."""
    return activity_by_repo_actor(stg, REPO_SNAPSHOT, [F.sum(fingerprint()).alias("fingerprint")])


def _additive(state: DataFrame) -> list[str]:
    return [c for c in state.columns if c not in (*GROUP, "first_at", "newest", "generation")]


def merge_state(state: DataFrame, added: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``state`` after taking ``removed`` groups back and adding ``added`` ones, all of the columns
    of :func:`state_of`; and the groups whose first or newest event is no longer known.

    The values of these are not to be used. Groups left without events fall away."""
    sums = _additive(state)
    plus = added.select(*GROUP, *(F.col(c).alias(f"plus_{c}") for c in [*sums, "first_at", "newest"]))
    minus = removed.select(*GROUP, *(F.col(c).alias(f"minus_{c}") for c in [*sums, "first_at", "newest"]))
    delta = plus.join(minus, GROUP, "full_outer")
    both = state.join(delta, GROUP, "full_outer")

    def total(c: str) -> Column:
        zero = F.lit(0)
        return F.coalesce(c, zero) + F.coalesce(f"plus_{c}", zero) - F.coalesce(f"minus_{c}", zero)

    def key(prefix: str) -> Column:
        newest = F.col(f"{prefix}newest")
        return F.when(newest.isNotNull(), F.struct(newest.created_at, newest.event_id))

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    # What was taken back was the group's first or newest event.
    first_gone = yes(F.col("minus_first_at") <= F.col("first_at"))
    newest_gone = yes(key("minus_") >= key(""))
    lost = (first_gone & ~yes(F.col("plus_first_at") <= F.col("minus_first_at"))) | (
        newest_gone & ~yes(key("plus_") >= key("minus_"))
    )
    first = F.when(first_gone, F.col("plus_first_at")).otherwise(F.least("first_at", "plus_first_at"))
    newest = F.when(newest_gone | yes(key("plus_") >= key("")), F.col("plus_newest")).otherwise(
        F.coalesce("newest", "plus_newest")
    )
    merged = both.select(
        *GROUP,
        *(total(c).alias(c) for c in sums),
        first.alias("first_at"),
        newest.alias("newest"),
        lost.alias("lost"),
    ).where("events > 0")
    return merged.select(*state.columns, "lost"), merged.where("lost").select(*GROUP)


def _current_state(spark: SparkSession, settings: Settings) -> tuple[DataFrame, int]:
    """The state that describes staging, and its generation."""
    name = _name(settings, "activity_state")
    table = spark.table(name)
    held = [r.generation for r in table.select("generation").distinct().orderBy("generation").collect()]
    if len(held) < 2:
        generation = held[0] if held else 0
        return table.where(F.col("generation") == generation), generation
    stg = spark.table(_name(settings, "stg_events"))
    want = stg.agg(F.coalesce(F.sum(fingerprint()), F.lit(0)).alias("n")).first().n
    marks = table.groupBy("generation").agg(F.sum("fingerprint").alias("n")).where(F.col("n") == want)
    found = marks.agg(F.max("generation").alias("g")).first().g
    if found is None:  # neither: staging was changed by other hands
        found = held[-1] + 1
        _write_state(state_of(stg), settings, found)
    _drop_states(spark, settings, [g for g in held if g != found])
    return spark.table(name).where(F.col("generation") == found), found


def _drop_states(spark: SparkSession, settings: Settings, generations: list[int]) -> None:
    for g in generations:
        drop_partition(spark, _name(settings, "activity_state"), {"generation": g})


def _write_state(state: DataFrame, settings: Settings, generation: int) -> None:
    name = _name(settings, "activity_state")
    rows = state.withColumn("generation", F.lit(generation))
    replace_partitions(_bucketed(rows, name, GROUP), name)


def pr_events_per_number(stg: DataFrame) -> DataFrame:
    """Pull-request events per event date, status, repository and number: what status
    breakdowns of any window add up."""
    prs = stg_pr(stg).withColumn("pr_status", pr_status(F.col("is_merge"), F.col("pr_action")))
    return prs.groupBy("event_date", "pr_status", "repo_name", "pr_number").agg(F.count(F.lit(1)).alias("events"))


def breakdown_of(pr_state: DataFrame, days: int = EXPORT_DAYS, as_of: str | None = None) -> DataFrame:
    """The status breakdown per repository and number, from the stored state."""
    recent = trailing_days(pr_state, days, as_of)
    numbers = recent.groupBy("pr_status", "pr_number", "repo_name").agg(F.sum("events").alias("events"))
    return breakdown_per_repo(numbers)


def _replace_dates(df: DataFrame, table: str, column: str, dates: list[str]) -> None:
    """Replace the partitions of ``dates``; those without rows any more go."""
    replace_partitions(df, table)
    for date in sorted(set(dates) - set(_dates(df, column))):
        drop_partition(df.sparkSession, table, {column: date})


def _dates(df: DataFrame, column: str) -> list[str]:
    """A calendar's worth of values."""
    return sorted(str(r[0]) for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


_FACTS = {"fact_commits": fact_commits, "fact_prs": fact_prs}
_PENDING = "event_id string, event_date date"


def _event_date() -> Column:
    return date_or_null("created_at").alias("event_date")


def _note(before: DataFrame, after: DataFrame, pending: str) -> None:
    """Write down the events that have or had a copy in the touched dates, and their own dates."""
    asked = [F.col("event_id"), _event_date()]
    before.select(asked).union(after.select(asked)).distinct().write.mode("append").parquet(pending)


def _create_all(raw: DataFrame, settings: Settings, tie_break: list[Column | str] | None) -> None:
    create_databases(raw.sparkSession, settings, settings.staging_database, settings.mart_database)
    stg = stg_events(raw, tie_break)
    _create(raw, settings, "event_copies", "date_partition", ["event_id"])
    _create(stg, settings, "stg_events", "event_date")
    _create(state_of(stg).withColumn("generation", F.lit(0)), settings, "activity_state", "generation", GROUP)
    for table, model in {**_FACTS, "pr_state": pr_events_per_number}.items():
        _create(model(stg), settings, table, "event_date")


def publish_incremental(
    raw: DataFrame,
    settings: Settings,
    dates: list[str] | None = None,
    tie_break: list[Column | str] | None = None,
) -> dict[str, DataFrame]:
    """Bring staging, facts, states and dimensions up to date with the ``date_partition``s in
    ``dates`` of ``raw``, of all there are by default; returns the marts.

    Rows without a ``date_partition`` cannot be replaced by a later load and are refused.
    """
    spark = raw.sparkSession
    if dict(raw.dtypes)["date_partition"] != "date":
        raw = raw.withColumn("date_partition", date_or_null("date_partition"))
    if dates is None:
        if not raw.where("date_partition IS NULL").isEmpty():
            raise ValueError("rows without date_partition")
        dates = _dates(raw, "date_partition")
    _create_all(raw, settings, tie_break)
    names = {t: _name(settings, t) for t in ("event_copies", "stg_events", "pr_state", *_FACTS)}
    pending = settings.zone(f"{settings.staging_database}/pending_ids")
    with Scratch(spark) as scratch:
        fresh = scratch.write(newest_per_date(raw.where(_in("date_partition", dates)), tie_break), "fresh-copies")
        _note(spark.table(names["event_copies"]).where(_in("date_partition", dates)), fresh, pending)
        _replace_dates(_bucketed(fresh, names["event_copies"], ["event_id"]), names["event_copies"], "date_partition", dates)

        noted = spark.read.schema(_PENDING).parquet(pending)
        ids = scratch.write(noted.select("event_id").distinct(), "asked-ids")
        # The narrow look-up says which other dates hold copies of these events; only they are read.
        holding = spark.table(names["event_copies"]).join(ids, "event_id", "left_semi")
        copies = spark.table(names["event_copies"]).where(_in("date_partition", _dates(holding, "date_partition")))
        seen = copies.join(ids, "event_id", "left_semi").select(_event_date())
        event_dates = _dates(noted.select("event_date").union(seen), "event_date")
        event_dates = [d for d in event_dates if EARLIEST <= d <= LATEST]

        stg = spark.table(names["stg_events"])
        held = stg.where(_in("event_date", event_dates))
        new = scratch.write(winners(copies, ids, tie_break), "new-winners")
        old = held.join(ids, "event_id", "left_semi")
        state, generation = _current_state(spark, settings)
        merged, lost = merge_state(state.drop("generation"), state_of(new), state_of(old))
        merged = scratch.write(merged, "merged-state")
        whole, lost = merged.where("NOT lost").drop("lost"), merged.where("lost").select(*GROUP)
        if not lost.isEmpty():
            rest = stg.join(ids, "event_id", "left_anti").unionByName(new)
            whole = whole.unionByName(state_of(rest.join(lost, GROUP, "left_semi")))
        _write_state(whole, settings, generation + 1)

        unchanged = held.join(ids, "event_id", "left_anti")
        dated = scratch.write(unchanged.unionByName(new), "staged-dates")
        _replace_dates(dated.hint("rebalance", "event_date"), names["stg_events"], "event_date", event_dates)
        _drop_states(spark, settings, [generation])
        for table, model in {**_FACTS, "pr_state": pr_events_per_number}.items():
            _replace_dates(model(dated).hint("rebalance", "event_date"), names[table], "event_date", event_dates)
        remove_folder(spark, pending)

    stg, pairs = spark.table(names["stg_events"]), spark.table(_name(settings, "activity_state")).drop("generation")
    return {t: spark.table(names[t]) for t in _FACTS} | {
        "dim_repos": save_mart(dim_repos(stg, pairs), "dim_repos", settings),
        "dim_contributors": save_mart(dim_contributors(stg, pairs), "dim_contributors", settings),
    }
