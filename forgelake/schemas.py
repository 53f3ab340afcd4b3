"""Declared schemas: the single source of truth for every zone.

Counts are BIGINT at every layer, so no stage ever needs to widen what an
earlier one wrote.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


_STR, _INT, _BOOL, _TS = StringType(), LongType(), BooleanType(), TimestampType()

# The event types the engine keeps.
PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"
ISSUES = "IssuesEvent"
ISSUE_COMMENT = "IssueCommentEvent"
WATCH = "WatchEvent"
FORK = "ForkEvent"
RELEASE = "ReleaseEvent"
CREATE = "CreateEvent"
WATCHED_TYPES = [WATCH, FORK, PUSH, PULL_REQUEST, ISSUES, RELEASE, CREATE, ISSUE_COMMENT]

# Repositories tracked unless the caller names others.
DEFAULT_TRACKED = [
    "torvalds/linux",
    "microsoft/vscode",
    "openai/openai-python",
    "huggingface/transformers",
    "golang/go",
    "rust-lang/rust",
    "tensorflow/tensorflow",
    "facebook/react",
    "vuejs/vue",
    "django/django",
]

# Pull-request actions known to the data checks.
KNOWN_PR_ACTIONS = [
    "opened", "closed", "reopened", "synchronize", "ready_for_review",
    "converted_to_draft", "labeled", "unlabeled", "review_requested",
    "review_request_removed", "edited", "assigned", "unassigned",
    "locked", "unlocked", "auto_merge_enabled", "auto_merge_disabled",
    "milestoned", "demilestoned", "enqueued", "dequeued",
]
PR_STATUSES = ["open", "closed", "merged"]

UNKNOWN_ACTOR = "[unknown]"
UNKNOWN_LANGUAGE = "Unknown"
UNKNOWN_TYPE = "Unknown"
BLANK_TYPE = "__blank__"  # folder of blank types in the processed zone

COUNT_COLUMNS = ["stars", "forks", "open_issues", "commit_count", "pr_number", "issue_number"]
FLAG_COLUMNS = ["is_tracked", "pr_merged", "is_merge", "has_text"]
TIME_COLUMNS = ["created_at", "ingested_at", "processed_at"]

# Nested event as the hosting API delivers it.
RAW_API = _struct(
    id=_STR,
    type=_STR,
    created_at=_STR,
    actor=_struct(login=_STR),
    org=_struct(login=_STR),
    repo=_struct(name=_STR),
    payload=_struct(
        action=_STR,
        size=_INT,
        ref_type=_STR,
        ref=_STR,
        commits=ArrayType(_struct(message=_STR)),
        pull_request=_struct(title=_STR, body=_STR, merged=_BOOL, number=_INT, state=_STR),
        issue=_struct(title=_STR, body=_STR, number=_INT),
        release=_struct(name=_STR, body=_STR, action=_STR),
        comment=_struct(body=_STR),
    ),
)

REPO_META = _struct(
    repo_name=_STR,
    language=_STR,
    stars=_INT,
    forks=_INT,
    open_issues=_INT,
    topics=ArrayType(_STR),
    description=_STR,
)

# Flat record carried by the stream; times are ISO text.
EVENT = _struct(
    event_id=_STR,
    event_type=_STR,
    action=_STR,
    actor=_STR,
    org=_STR,
    repo_name=_STR,
    repo_owner=_STR,
    language=_STR,
    stars=_INT,
    forks=_INT,
    open_issues=_INT,
    description=_STR,
    topics=ArrayType(_STR),
    text_content=_STR,
    commit_count=_INT,
    pr_merged=_BOOL,
    pr_number=_INT,
    issue_number=_INT,
    ref_type=_STR,
    ref_name=_STR,
    is_tracked=_BOOL,
    created_at=_STR,
    ingested_at=_STR,
)

# Raw zone on disk: the record plus its partition columns. Hour is text ("07").
RAW_ZONE = StructType(EVENT.fields + _struct(date=DateType(), hour=_STR).fields)

# Warehouse raw table: 28 columns, topics as JSON text.
RAW_TABLE = _struct(
    event_id=_STR,
    event_type=_STR,
    action=_STR,
    actor=_STR,
    org=_STR,
    repo_name=_STR,
    repo_owner=_STR,
    language=_STR,
    stars=_INT,
    forks=_INT,
    open_issues=_INT,
    description=_STR,
    is_tracked=_BOOL,
    topics=_STR,
    text_content=_STR,
    commit_count=_INT,
    pr_merged=_BOOL,
    pr_number=_INT,
    issue_number=_INT,
    ref_type=_STR,
    ref_name=_STR,
    is_merge=_BOOL,
    has_text=_BOOL,
    pr_state=_STR,
    created_at=_TS,
    ingested_at=_TS,
    processed_at=_TS,
    date_partition=DateType(),
)
RAW_TABLE_REQUIRED = ["event_id", "repo_name", "date_partition"]

# Processed zone on disk: the raw table's columns (topics as JSON text) with the
# run's date as partition column.
PROCESSED_ZONE = StructType(
    [f for f in RAW_TABLE.fields if f.name != "date_partition"] + _struct(date=DateType()).fields
)

# Column types declared for the CSV seed; all its other columns are text.
SEED_TYPES = {
    **{name: _INT for name in COUNT_COLUMNS},
    **{name: _BOOL for name in FLAG_COLUMNS},
}
