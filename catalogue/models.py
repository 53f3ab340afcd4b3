"""Staging, marts and extracts over the adapted events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.adapter import AS_OF, PROCESSED_AT, RAW_SQL, raw_events
from catalogue.registry import query
from forgelake.operators.dedup import any_copy, newest_copy
from forgelake.operators.enrich import enrich
from forgelake.operators.metrics import dedup_counts
from forgelake.operators.rollups import activity_by_repo_actor
from forgelake.plans import exports, marts, staging

ENRICHED_SQL = f"""{RAW_SQL},
enriched AS (
  SELECT *,
    event_type IS NOT DISTINCT FROM 'PullRequestEvent' AND pr_merged IS NOT DISTINCT FROM TRUE AS is_merge,
    text_content IS NOT NULL AND text_content <> '' AS has_text,
    CASE WHEN event_type IS DISTINCT FROM 'PullRequestEvent' THEN ''
         WHEN pr_merged THEN 'merged' WHEN action = 'closed' THEN 'closed' ELSE 'open' END AS pr_state,
    TIMESTAMP '{PROCESSED_AT}' AS processed_at
  FROM raw)"""

STG_SQL = f"""{ENRICHED_SQL},
newest AS (
  SELECT * FROM enriched WHERE event_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC NULLS LAST, c) = 1),
typed AS (
  SELECT event_id, event_type, ifnull(action, '') AS action, ifnull(actor, '[unknown]') AS actor,
    ifnull(org, '') AS org, repo_name, split_part(repo_name, '/', 1) AS repo_owner,
    ifnull(language, 'Unknown') AS language, ifnull(TRY_CAST(stars AS BIGINT), 0) AS stars,
    ifnull(TRY_CAST(forks AS BIGINT), 0) AS forks,
    ifnull(TRY_CAST(open_issues AS BIGINT), 0) AS open_issues,
    ifnull(description, '') AS description, ifnull(is_tracked, FALSE) AS is_tracked,
    ifnull(text_content, '') AS text_content,
    ifnull(TRY_CAST(commit_count AS BIGINT), 0) AS commit_count,
    ifnull(pr_merged, FALSE) AS pr_merged, TRY_CAST(pr_number AS BIGINT) AS pr_number,
    TRY_CAST(issue_number AS BIGINT) AS issue_number, ifnull(ref_type, '') AS ref_type,
    ifnull(ref_name, '') AS ref_name, is_merge, has_text, pr_state,
    TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(created_at AS DATE) AS event_date,
    TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at, processed_at, date_partition
  FROM newest),
stg AS (
  SELECT *, CAST(hour(created_at) AS INTEGER) AS event_hour FROM typed
  WHERE event_type IS NOT NULL AND repo_name IS NOT NULL AND created_at IS NOT NULL
    AND event_date BETWEEN DATE '2000-01-01' AND DATE '2100-01-01')"""

_HEAD = "event_id, repo_name, repo_owner, language"
_TAIL = (
    "stars, forks, is_tracked, CAST(event_date AS VARCHAR) AS event_date, event_hour,"
    " ingested_at, processed_at"
)
_PUSH = (
    f"{_HEAD}, actor AS pushed_by, org, commit_count, text_content AS commit_messages,"
    f" created_at AS pushed_at, {_TAIL} FROM stg WHERE event_type = 'PushEvent'"
)
_PR = (
    f"{_HEAD}, actor AS pr_actor, org, action AS pr_action, pr_number, pr_merged, is_merge,"
    f" text_content AS pr_title_body, has_text, created_at AS event_at, {_TAIL}"
)
_PR_FROM = "FROM stg WHERE event_type = 'PullRequestEvent'"

REPOS_SQL = f"""{STG_SQL},
repos AS (
  SELECT md5(repo_name) AS repo_key, repo_name, min(repo_owner) AS repo_owner,
    last(language ORDER BY created_at, event_id) AS language,
    last(stars ORDER BY created_at, event_id) AS stars,
    last(forks ORDER BY created_at, event_id) AS forks,
    last(open_issues ORDER BY created_at, event_id) AS open_issues,
    last(description ORDER BY created_at, event_id) AS description,
    last(is_tracked ORDER BY created_at, event_id) AS is_tracked,
    max(created_at) AS last_seen_at, count(*) AS total_events,
    min(created_at) AS first_seen_at, max(created_at) AS latest_event_at,
    count(*) FILTER (event_type = 'WatchEvent') AS total_stars,
    count(*) FILTER (event_type = 'ForkEvent') AS total_forks_events,
    count(*) FILTER (event_type = 'PushEvent') AS total_pushes,
    count(*) FILTER (event_type = 'PullRequestEvent') AS total_pr_events,
    count(DISTINCT nullif(actor, '[unknown]')) AS unique_contributors
  FROM stg GROUP BY repo_name)"""

CONTRIBUTORS_SQL = f"""{STG_SQL},
contributors AS (
  SELECT md5(actor) AS contributor_key, actor, count(*) AS total_events,
    count(DISTINCT repo_name) AS repos_contributed_to, min(created_at) AS first_seen_at,
    max(created_at) AS last_seen_at,
    count(*) FILTER (event_type = 'PushEvent') AS push_events,
    count(*) FILTER (event_type = 'PullRequestEvent') AS pr_events,
    count(*) FILTER (event_type = 'IssuesEvent') AS issue_events,
    count(*) FILTER (event_type = 'WatchEvent') AS watch_events,
    count(*) FILTER (event_type = 'ForkEvent') AS fork_events,
    count(*) FILTER (event_type = 'IssueCommentEvent') AS comment_events,
    count(*) FILTER (event_type = 'ReleaseEvent') AS release_events,
    CAST(sum(commit_count) AS BIGINT) AS total_commits, count(*) FILTER (is_merge) AS prs_merged,
    last(language ORDER BY created_at, event_id) AS primary_language,
    last(repo_name ORDER BY created_at, event_id) AS most_recent_repo
  FROM stg WHERE actor NOT IN ('', '[unknown]') GROUP BY actor)"""

_RECENT = f"event_date >= DATE '{AS_OF}' - 14"


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(raw_events(spark, sf_dir), F.lit(PROCESSED_AT).cast("timestamp"))


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_events(enriched(spark, sf_dir), tie_break=["c"])


@query(
    f"WITH {STG_SQL} SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date,"
    " CAST(date_partition AS VARCHAR) AS date_partition) FROM stg"
)
def stg_events(spark, sf_dir):
    return stg(spark, sf_dir)


@query(
    f"WITH {STG_SQL} SELECT event_id, event_type, stars, created_at, ingested_at, c FROM newest"
)
def dedup_latest(spark, sf_dir):
    raw = raw_events(spark, sf_dir).where("event_id IS NOT NULL")
    return newest_copy(raw, tie_break=["c"]).select(
        "event_id", "event_type", "stars", "created_at", "ingested_at", "c"
    )


@query(f"WITH {RAW_SQL} SELECT DISTINCT event_id FROM raw")
def drop_duplicate_ids(spark, sf_dir):
    return any_copy(raw_events(spark, sf_dir)).select("event_id")


@query(
    f"WITH {RAW_SQL}, ids AS (SELECT DISTINCT event_id FROM raw)"
    " SELECT (SELECT count(*) FROM raw) AS rows_before, (SELECT count(*) FROM ids) AS rows_after,"
    " (SELECT count(*) FROM raw) - (SELECT count(*) FROM ids) AS rows_removed"
)
def dedup_count_report(spark, sf_dir):
    return dedup_counts(raw_events(spark, sf_dir))


@query(f"WITH {STG_SQL} SELECT {_PUSH}")
def stg_push(spark, sf_dir):
    return staging.stg_push(stg(spark, sf_dir))


@query(f"WITH {STG_SQL} SELECT {_PR}, pr_state {_PR_FROM}")
def stg_pr(spark, sf_dir):
    return staging.stg_pr(stg(spark, sf_dir))


@query(
    f"WITH {STG_SQL} SELECT {_HEAD}, actor AS starred_by, org, created_at AS starred_at, {_TAIL}"
    " FROM stg WHERE event_type = 'WatchEvent'"
)
def stg_watch(spark, sf_dir):
    return staging.stg_watch(stg(spark, sf_dir))


@query(f"WITH {STG_SQL} SELECT md5(event_id) AS commit_fact_key, {_PUSH}")
def fact_commits(spark, sf_dir):
    return marts.fact_commits(stg(spark, sf_dir))


@query(
    f"WITH {STG_SQL} SELECT md5(event_id) AS pr_fact_key, {_PR},"
    f" CASE WHEN is_merge THEN 'merged' WHEN action = 'closed' THEN 'closed' ELSE 'open' END"
    f" AS pr_status {_PR_FROM}"
)
def fact_prs(spark, sf_dir):
    return marts.fact_prs(stg(spark, sf_dir))


@query(f"WITH {REPOS_SQL} SELECT * FROM repos")
def dim_repos(spark, sf_dir):
    return marts.dim_repos(stg(spark, sf_dir))


@query(f"WITH {CONTRIBUTORS_SQL} SELECT * FROM contributors")
def dim_contributors(spark, sf_dir):
    return marts.dim_contributors(stg(spark, sf_dir))


@query(
    f"WITH {REPOS_SQL} SELECT repo_name, repo_owner, language, stars, forks, open_issues,"
    " total_events, total_pushes, total_pr_events, total_stars, unique_contributors, is_tracked,"
    " last_seen_at FROM repos ORDER BY total_events DESC, repo_name LIMIT 200"
)
def top_repos_200(spark, sf_dir):
    return exports.top_repos(marts.dim_repos(stg(spark, sf_dir)))


@query(
    f"WITH {CONTRIBUTORS_SQL} SELECT actor, total_events, repos_contributed_to, push_events,"
    " pr_events, prs_merged, total_commits, primary_language, most_recent_repo, first_seen_at,"
    " last_seen_at FROM contributors ORDER BY total_events DESC, actor LIMIT 100"
)
def top_contributors_100(spark, sf_dir):
    return exports.top_contributors(marts.dim_contributors(stg(spark, sf_dir)))


@query(
    f"WITH {STG_SQL} SELECT CAST(event_date AS VARCHAR) AS event_date, language,"
    " count(*) AS push_events, CAST(sum(commit_count) AS BIGINT) AS total_commits"
    f" FROM stg WHERE event_type = 'PushEvent' AND {_RECENT} GROUP BY ALL"
)
def daily_pushes_by_language(spark, sf_dir):
    return exports.daily_pushes(marts.fact_commits(stg(spark, sf_dir)), as_of=AS_OF)


@query(
    f"WITH {STG_SQL} SELECT CASE WHEN is_merge THEN 'merged' WHEN action = 'closed' THEN 'closed'"
    " ELSE 'open' END AS pr_status, count(DISTINCT event_id) AS events,"
    f" count(DISTINCT pr_number) AS unique_prs {_PR_FROM} AND {_RECENT} GROUP BY 1"
)
def pr_status_breakdown(spark, sf_dir):
    return exports.pr_breakdown(marts.fact_prs(stg(spark, sf_dir)), as_of=AS_OF)


@query(
    f"WITH {STG_SQL} SELECT CASE WHEN is_merge THEN 'merged' WHEN action = 'closed' THEN 'closed'"
    " ELSE 'open' END AS pr_status, count(DISTINCT event_id) AS events,"
    " count(DISTINCT pr_number) AS unique_prs,"
    " count(DISTINCT concat(repo_name, '#', pr_number)) FILTER (pr_number IS NOT NULL)"
    f" AS unique_repo_prs {_PR_FROM} AND {_RECENT} GROUP BY 1"
)
def pr_status_repo_pairs(spark, sf_dir):
    return exports.pr_breakdown(
        marts.fact_prs(stg(spark, sf_dir)), as_of=AS_OF, per_repo=True
    )


@query(
    f"WITH {STG_SQL} SELECT count(*) FILTER (event_type = 'PushEvent') AS push_events,"
    " count(DISTINCT actor) FILTER (actor NOT IN ('', '[unknown]')) AS contributors,"
    " count(DISTINCT repo_name) AS repos,"
    " count(*) FILTER (event_type = 'PullRequestEvent') AS pr_events FROM stg"
)
def kpi_totals(spark, sf_dir):
    return exports.kpi_totals(activity_by_repo_actor(stg(spark, sf_dir)))


@query(f"WITH {REPOS_SQL} SELECT repo_name, language, stars, total_events FROM repos")
def stars_vs_activity(spark, sf_dir):
    return exports.stars_vs_activity(marts.dim_repos(stg(spark, sf_dir)))


@query(
    f"WITH {ENRICHED_SQL} SELECT * REPLACE (CAST(date_partition AS VARCHAR) AS date_partition)"
    " FROM enriched"
)
def batch_enrich(spark, sf_dir):
    return enriched(spark, sf_dir)
