"""Staging and mart rules on handwritten rows."""

import datetime as dt

from forgelake.operators.enrich import enrich, whole_numbers_to_bigint
from forgelake.operators.rollups import activity_by_repo_actor
from forgelake.plans import exports
from forgelake.plans.marts import dim_contributors, dim_repos, fact_commits, fact_prs
from forgelake.plans.staging import stg_events, stg_watch


def test_validity_is_judged_on_the_newest_copy(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "ingested_at": "2024-01-02T00:00:00Z"},
            {"event_id": "1", "ingested_at": "2024-01-03T00:00:00Z", "event_type": None},
            {"event_id": "2"},
        )
    )
    assert [r.event_id for r in stg.collect()] == ["2"]


def test_copy_without_ingest_time_loses(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "ingested_at": None, "stars": "1"},
            {"event_id": "1", "ingested_at": "2020-01-01T00:00:00Z", "stars": "2"},
        )
    )
    assert [r.stars for r in stg.collect()] == [2]


def test_ingest_times_compare_as_instants(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "ingested_at": "2024-01-02T01:00:00+02:00", "stars": "1"},
            {"event_id": "1", "ingested_at": "2024-01-02T00:00:00Z", "stars": "2"},
        )
    )
    assert [r.stars for r in stg.collect()] == [2]


def test_full_ties_are_settled_the_same_way_every_run(raw_rows):
    rows = [{"event_id": "1", "stars": str(i)} for i in range(50)]
    picks = {stg_events(raw_rows(*order)).first().stars for order in (rows, rows[::-1])}
    assert len(picks) == 1


def test_defaults(raw_rows):
    row = stg_events(
        raw_rows({"event_id": "1", "actor": None, "stars": "n/a", "repo_name": "solo", "pr_number": "x"})
    ).first()
    assert (row.actor, row.stars, row.repo_owner, row.pr_number) == ("[unknown]", 0, "solo", None)
    assert (row.action, row.org, row.language, row.is_merge) == ("", "", "Unknown", False)
    assert (row.event_date, row.event_hour) == (dt.date(2024, 1, 2), 3)


def test_rows_out_of_range_or_unreadable_go(raw_rows):
    bad = ["garbage", "1999-12-31T23:59:59Z", "2100-01-02T00:00:00Z", None]
    rows = [{"event_id": str(i), "created_at": t} for i, t in enumerate(bad)]
    edges = [{"event_id": "a", "created_at": "2000-01-01T00:00:00Z"},
             {"event_id": "b", "created_at": "2100-01-01T23:00:00Z"}]
    stg = stg_events(raw_rows(*rows, *edges, {"event_id": None}, {"event_id": "c", "repo_name": None}))
    assert sorted(r.event_id for r in stg.collect()) == ["a", "b"]
    assert stg.columns[-1] == "date_partition" and len(stg.columns) == 29


def test_watch_slice(raw_rows):
    stg = stg_events(raw_rows({"event_id": "1", "event_type": "WatchEvent"}, {"event_id": "2"}))
    row = stg_watch(stg).first()
    assert (row.event_id, row.starred_by) == ("1", "bob")


def test_blank_actor_counts_for_repos_only(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "actor": None},
            {"event_id": "2", "actor": ""},
            {"event_id": "3", "actor": "bob"},
            {"event_id": "4", "actor": "bob"},
        )
    )
    assert [r.actor for r in dim_contributors(stg).collect()] == ["bob"]
    repo = dim_repos(stg).first()
    assert (repo.unique_contributors, repo.total_events) == (2, 4)


def test_snapshot_is_the_newest_event(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "created_at": "2024-01-02T00:00:00Z", "stars": "10", "language": "Go"},
            {"event_id": "2", "created_at": "2024-01-03T00:00:00Z", "stars": "7", "actor": "al",
             "language": None},
            {"event_id": "3", "created_at": "2024-01-01T00:00:00Z", "stars": "99", "actor": "al",
             "repo_name": "o/z"},
        )
    )
    repos = {r.repo_name: r for r in dim_repos(stg).collect()}
    assert (repos["o/r"].stars, repos["o/r"].language) == (7, "Unknown")
    assert repos["o/r"].first_seen_at < repos["o/r"].last_seen_at == repos["o/r"].latest_event_at
    al = {r.actor: r for r in dim_contributors(stg).collect()}["al"]
    assert (al.most_recent_repo, al.repos_contributed_to) == ("o/r", 2)


def test_ties_in_time_fall_to_the_event_id(raw_rows):
    stg = stg_events(raw_rows({"event_id": "1", "stars": "1"}, {"event_id": "2", "stars": "2"}))
    assert dim_repos(stg).first().stars == 2


def test_facts(raw_rows):
    stg = stg_events(
        enrich(
            raw_rows(
                {"event_id": "1", "commit_count": "0"},
                {"event_id": "2", "event_type": "PullRequestEvent", "action": "closed", "pr_merged": True},
                {"event_id": "3", "event_type": "PullRequestEvent", "action": "closed"},
                {"event_id": "4", "event_type": "PullRequestEvent", "action": "labeled"},
            )
        )
    )
    assert [r.commit_count for r in fact_commits(stg).collect()] == [0]
    prs = fact_prs(stg)
    assert {r.event_id: r.pr_status for r in prs.collect()} == {"2": "merged", "3": "closed", "4": "open"}
    assert len(prs.columns) == 22 and len(fact_commits(stg).columns) == 17
    assert "pr_state" not in prs.columns


def test_trailing_window_is_inclusive(raw_rows):
    stg = stg_events(
        raw_rows(
            {"event_id": "1", "created_at": "2024-01-16T00:00:00Z"},
            {"event_id": "2", "created_at": "2024-01-15T23:59:59Z"},
        )
    )
    kept = exports.trailing_days(fact_commits(stg), 14, "2024-01-30")
    assert [r.event_id for r in kept.collect()] == ["1"]


def test_kpis_of_nothing(raw_rows):
    stg = stg_events(raw_rows({"event_id": None}))
    row = exports.kpi_totals(activity_by_repo_actor(stg)).first()
    assert tuple(row) == (0, 0, 0, 0)


def test_pr_numbers_repeat_across_repositories(raw_rows):
    pr = {"event_type": "PullRequestEvent", "action": "opened", "pr_number": "5"}
    stg = stg_events(
        raw_rows(
            {"event_id": "1", **pr},
            {"event_id": "2", **pr, "repo_name": "o/other"},
            {"event_id": "3", **{**pr, "pr_number": None}},
        )
    )
    plain = exports.pr_breakdown(fact_prs(stg), as_of="2024-01-03").first()
    assert (plain.events, plain.unique_prs) == (3, 1)
    row = exports.pr_breakdown(fact_prs(stg), as_of="2024-01-03", per_repo=True).first()
    assert (row.events, row.unique_prs, row.unique_repo_prs) == (3, 1, 2)


def test_whole_number_retype(spark):
    df = spark.createDataFrame(
        [(1.0, 0.5, None, float("nan"), float("inf")), (None, 1.0, None, 2.0, 1.0)],
        "whole double, part double, nothing double, gaps double, endless double",
    )
    out = whole_numbers_to_bigint(df)
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    assert types == {
        "whole": "bigint", "part": "double", "nothing": "bigint", "gaps": "bigint",
        "endless": "double",
    }
    assert [r.gaps for r in out.collect()] == [None, 2]
