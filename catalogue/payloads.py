"""Nested API events built from the text tables, through both normaliser profiles.

``conversations`` gives pushes: a conversation is a push, its turns are commits, and the total is
stated beside them. ``documents`` gives the events that carry a title and a body.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogue.adapter import RAW_SQL, raw_events, table
from catalogue.records import META_COLUMNS_SQL, META_SQL, TRACKED, repo_meta, topics_as_json
from catalogue.registry import query
from forgelake.operators.lookup import with_repo_meta
from forgelake.functions import int_or_null
from forgelake.operators.normalise import normalise, normalise_daily
from forgelake.schemas import RAW_API, WATCHED_TYPES

NOW = "2024-03-01T00:00:00.000000+00:00"
# The whitespace both engines strip; in SQL as code points.
_SPACE_SQL = " || ".join(
    f"chr({n})"
    for n in [
        *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
        8232, 8233, 8239, 8287, 12288,
    ]
)


def _as_api(df: DataFrame, **columns) -> DataFrame:
    """Rows as nested API events; payload parts not named are null."""
    payload_type = RAW_API["payload"].dataType
    parts = columns.pop("payload")
    payload = F.struct(
        *[
            parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in payload_type
        ]
    )
    return df.select(
        columns["id"].cast("string").alias("id"),
        columns["type"].alias("type"),
        columns.get("created_at", F.lit("2024-01-05T00:00:00Z")).alias("created_at"),
        F.struct(columns["login"].alias("login")).alias("actor"),
        F.struct(columns.get("org", F.lit(None)).cast("string").alias("login")).alias("org"),
        F.struct(columns["repo"].alias("name")).alias("repo"),
        payload.alias("payload"),
    )


def pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One push per conversation, a commit per turn."""
    turns = table(spark, sf_dir, "conversations")
    listed = (
        turns.withColumn(
            "rn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text"))
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("rn", F.col("text").alias("message")))).alias("t"))
    )
    totals = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    whole = listed.join(totals, "conv_id")
    size = F.expr("CASE conv_id % 3 WHEN 0 THEN n + 30 WHEN 1 THEN 0 END")
    return _as_api(
        whole,
        id=F.col("conv_id"),
        type=F.lit("PushEvent"),
        login=F.concat(F.lit("user_"), F.expr("conv_id % 7")),
        repo=F.concat(F.lit("owner/repo_"), F.expr("conv_id % 5")),
        payload={
            "size": size,
            "commits": F.transform("t", lambda x: F.struct(x["message"].alias("message"))),
        },
    )


_PUSHES_SQL = f"""turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn FROM conversations),
pushes AS (
  SELECT conv_id, count(*) AS n, count(*) AS listed,
    string_agg(ifnull(text, ''), ' | ' ORDER BY rn) FILTER (rn <= 5) AS messages,
    string_agg(substr(ifnull(text, ''), 1, 100), ' | ' ORDER BY rn) FILTER (rn <= 5) AS clipped
  FROM turns GROUP BY conv_id)"""


@query(
    f"WITH {_PUSHES_SQL} SELECT CAST(conv_id AS VARCHAR) AS event_id,"
    " concat('user_', conv_id % 7) AS actor, concat('owner/repo_', conv_id % 5) AS repo_name,"
    " 'owner' AS repo_owner, 'Unknown' AS language, CAST(0 AS BIGINT) AS stars,"
    f" trim(messages, {_SPACE_SQL}) AS text_content,"
    " CAST(CASE WHEN conv_id % 3 = 0 THEN n + 30 ELSE listed END AS BIGINT) AS commit_count,"
    " FALSE AS pr_merged, FALSE AS is_tracked FROM pushes"
)
def normalise_push(spark, sf_dir):
    return normalise(pushes(spark, sf_dir), TRACKED, F.lit(NOW)).select(
        "event_id", "actor", "repo_name", "repo_owner", "language", "stars", "text_content",
        "commit_count", "pr_merged", "is_tracked",
    )


@query(
    f"WITH {_PUSHES_SQL} SELECT CAST(conv_id AS VARCHAR) AS event_id,"
    f" trim(substr(clipped, 1, 500), {_SPACE_SQL}) AS text_content,"
    " CAST(listed AS BIGINT) AS commit_count,"
    f" trim(substr(clipped, 1, 500), {_SPACE_SQL}) <> '' AS has_text,"
    " CAST(NULL AS VARCHAR) AS pr_state, '[]' AS topics FROM pushes"
)
def daily_normalise_push(spark, sf_dir):
    return normalise_daily(pushes(spark, sf_dir), F.lit(NOW)).select(
        "event_id", "text_content", "commit_count", "has_text", "pr_state", "topics"
    )


_KINDS = [
    "PullRequestEvent", "IssuesEvent", "ReleaseEvent", "IssueCommentEvent", "CreateEvent",
    "GollumEvent",
]


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per document, its kind by turns; titles are sometimes missing."""
    docs = table(spark, sf_dir, "documents")
    kind = F.element_at(
        F.array(*[F.lit(k) for k in _KINDS]), (F.col("doc_id") % len(_KINDS) + 1).cast("int")
    )
    title = F.expr("CASE WHEN doc_id % 4 = 0 THEN NULL ELSE source END")
    body = F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END")
    text = [title.alias("title"), body.alias("body")]
    merged = F.expr("CASE WHEN doc_id % 7 <> 0 THEN doc_id % 2 = 0 END")
    state = F.expr("CASE WHEN doc_id % 3 = 0 THEN 'closed' END")
    return _as_api(
        docs,
        id=F.col("doc_id"),
        type=kind,
        login=F.concat(F.lit("user_"), F.expr("doc_id % 11")),
        org=F.expr("CASE WHEN doc_id % 2 = 0 THEN lang END"),
        repo=F.expr("CASE WHEN doc_id % 9 = 0 THEN 'solo' ELSE concat(lang, '/', source) END"),
        payload={
            "action": F.expr("CASE WHEN doc_id % 8 <> 0 THEN 'opened' END"),
            "ref": F.col("source"),
            "ref_type": F.expr("CASE WHEN doc_id % 10 <> 4 THEN 'branch' END"),
            "pull_request": F.struct(
                *text, merged.alias("merged"), F.col("doc_id").alias("number"), state.alias("state")
            ),
            "issue": F.struct(*text, F.col("doc_id").alias("number")),
            "release": F.struct(
                title.alias("name"),
                body.alias("body"),
                F.expr("CASE WHEN doc_id % 5 <> 2 THEN 'published' END").alias("action"),
            ),
            "comment": F.struct(body.alias("body")),
        },
    )


_TEXTS_SQL = f"""texts AS (
  SELECT doc_id, [{", ".join(f"'{k}'" for k in _KINDS)}][doc_id % {len(_KINDS)} + 1] AS event_type,
    CASE WHEN doc_id % 4 = 0 THEN '' ELSE ifnull(source, '') END AS title,
    CASE WHEN doc_id % 5 = 0 THEN '' ELSE ifnull(text, '') END AS body,
    CASE WHEN doc_id % 2 = 0 THEN ifnull(lang, '') ELSE '' END AS org,
    CASE WHEN doc_id % 9 = 0 THEN 'solo' ELSE lang || '/' || source END AS repo_name,
    CASE WHEN doc_id % 9 = 0 THEN '' ELSE lang END AS repo_owner,
    CASE WHEN doc_id % 8 <> 0 THEN 'opened' ELSE '' END AS action,
    doc_id % 7 <> 0 AND doc_id % 2 = 0 AS merged, source, lang
  FROM documents)"""


@query(
    f"WITH {_TEXTS_SQL} SELECT CAST(doc_id AS VARCHAR) AS event_id, event_type,"
    " CASE WHEN event_type = 'ReleaseEvent' AND doc_id % 5 <> 2 THEN 'published' ELSE action END"
    " AS action, org, repo_name, repo_owner, trim(CASE"
    " WHEN event_type IN ('PullRequestEvent', 'IssuesEvent', 'ReleaseEvent')"
    " THEN substr(title || ' ' || body, 1, 500)"
    " WHEN event_type = 'IssueCommentEvent' THEN substr(body, 1, 300) ELSE '' END,"
    f" {_SPACE_SQL}) AS text_content, CAST(0 AS BIGINT) AS commit_count,"
    " event_type = 'PullRequestEvent' AND merged AS pr_merged,"
    " CASE WHEN event_type = 'PullRequestEvent' THEN doc_id END AS pr_number,"
    " CASE WHEN event_type = 'IssuesEvent' THEN doc_id END AS issue_number,"
    " CASE WHEN event_type = 'CreateEvent' AND doc_id % 10 <> 4 THEN 'branch' ELSE '' END"
    " AS ref_type, CASE WHEN event_type = 'CreateEvent' THEN source ELSE '' END AS ref_name"
    " FROM texts WHERE event_type <> 'GollumEvent'"
)
def normalise_texts(spark, sf_dir):
    return normalise(texts(spark, sf_dir), TRACKED, F.lit(NOW)).select(
        "event_id", "event_type", "action", "org", "repo_name", "repo_owner", "text_content",
        "commit_count", "pr_merged", "pr_number", "issue_number", "ref_type", "ref_name",
    )


@query(
    f"WITH {_TEXTS_SQL}, stripped AS (SELECT *, trim(CASE"
    " WHEN event_type IN ('PullRequestEvent', 'IssuesEvent')"
    f" THEN substr(title || ' ' || body, 1, 500) ELSE '' END, {_SPACE_SQL}) AS t FROM texts)"
    " SELECT CAST(doc_id AS VARCHAR) AS event_id, event_type, action, org, repo_owner,"
    " t AS text_content, t <> '' AS has_text,"
    " event_type = 'PullRequestEvent' AND merged AS pr_merged,"
    " event_type = 'PullRequestEvent' AND merged AS is_merge,"
    " CASE WHEN event_type = 'PullRequestEvent' THEN CASE WHEN merged THEN 'merged'"
    " WHEN doc_id % 3 = 0 THEN 'closed' ELSE 'open' END END AS pr_state,"
    " CASE WHEN event_type = 'PullRequestEvent' THEN doc_id END AS pr_number,"
    " CASE WHEN event_type = 'IssuesEvent' THEN doc_id END AS issue_number,"
    " CASE WHEN doc_id % 10 <> 4 THEN 'branch' END AS ref_type, source AS ref_name,"
    " CAST(NULL AS BIGINT) AS commit_count FROM stripped"
)
def daily_normalise_texts(spark, sf_dir):
    return normalise_daily(texts(spark, sf_dir), F.lit(NOW)).select(
        "event_id", "event_type", "action", "org", "repo_owner", "text_content", "has_text",
        "pr_merged", "is_merge", "pr_state", "pr_number", "issue_number", "ref_type", "ref_name",
        "commit_count",
    )


def api_events(spark: SparkSession, sf_dir: str, copy: int | None = None) -> DataFrame:
    """The adapted events as nested API events; ``copy`` picks first or second copies."""
    raw = raw_events(spark, sf_dir)
    if copy is not None:
        raw = raw.where(F.col("c") == copy)
    number = int_or_null("pr_number")
    return _as_api(
        raw,
        id=F.col("event_id"),
        type=F.col("event_type"),
        created_at=F.col("created_at"),
        login=F.col("actor"),
        org=F.col("org"),
        repo=F.col("repo_name"),
        payload={
            "action": F.col("action"),
            "size": int_or_null("commit_count"),
            "ref": F.col("ref_name"),
            "ref_type": F.col("ref_type"),
            "pull_request": F.struct(
                F.col("text_content").alias("title"),
                F.lit(None).cast("string").alias("body"),
                F.col("pr_merged").alias("merged"),
                number.alias("number"),
                F.lit(None).cast("string").alias("state"),
            ),
            "issue": F.struct(
                F.lit(None).cast("string").alias("title"),
                F.col("text_content").alias("body"),
                int_or_null("issue_number").alias("number"),
            ),
        },
    )


# Normalised form of the adapted events; the text is that of pull requests and issues.
API_SQL = f"""{RAW_SQL}, {META_SQL},
flat AS (
  SELECT c, ifnull(event_id, '') AS event_id, ifnull(event_type, '') AS event_type,
    ifnull(action, '') AS action, ifnull(actor, '') AS actor, ifnull(org, '') AS org,
    ifnull(raw.repo_name, '') AS repo_name,
    CASE WHEN raw.repo_name LIKE '%/%' THEN split_part(raw.repo_name, '/', 1) ELSE '' END
      AS repo_owner,
    {META_COLUMNS_SQL}, ifnull(m.topics, '[]') AS topics,
    CASE WHEN event_type = 'PullRequestEvent' THEN trim(ifnull(text_content, '')) ELSE '' END
      AS text_content,
    CASE WHEN event_type = 'PushEvent' THEN CAST(commit_count AS BIGINT)
      ELSE CAST(0 AS BIGINT) END AS commit_count,
    event_type IS NOT DISTINCT FROM 'PullRequestEvent' AND ifnull(pr_merged, FALSE) AS pr_merged,
    CASE WHEN event_type = 'PullRequestEvent' THEN CAST(pr_number AS BIGINT) END AS pr_number,
    CASE WHEN event_type = 'IssuesEvent' THEN CAST(issue_number AS BIGINT) END AS issue_number,
    CASE WHEN event_type = 'CreateEvent' THEN ifnull(ref_type, '') ELSE '' END AS ref_type,
    CASE WHEN event_type = 'CreateEvent' THEN ifnull(ref_name, '') ELSE '' END AS ref_name,
    ifnull(raw.repo_name, '') IN ({", ".join(f"'{r}'" for r in TRACKED)}) AS is_tracked,
    created_at
  FROM raw LEFT JOIN meta m ON m.repo_name = raw.repo_name)"""

WATCHED_SQL = ", ".join(f"'{t}'" for t in WATCHED_TYPES)


@query(f"WITH {API_SQL} SELECT * EXCLUDE (c) FROM flat WHERE event_type IN ({WATCHED_SQL})")
def normalise_events(spark, sf_dir):
    """All types, with repository metadata."""
    events = api_events(spark, sf_dir)
    meta = repo_meta(raw_events(spark, sf_dir))
    joined = with_repo_meta(events, meta, F.col("repo.name"), unique=True)
    return topics_as_json(normalise(joined, TRACKED, F.lit(NOW))).drop("ingested_at")
