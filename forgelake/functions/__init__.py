"""Column-level building blocks. All are Catalyst expressions; none is a UDF."""

from forgelake.functions.casts import (
    date_or_null,
    flag,
    int_or_null,
    int_or_zero,
    strict_cast,
    timestamp_or_null,
)
from forgelake.functions.derive import (
    bulk_pr_state,
    daily_pr_state,
    has_text,
    is_merge,
    pr_status,
)
from forgelake.functions.keys import surrogate_key
from forgelake.functions.text import (
    clip,
    commit_text,
    owner_or_blank,
    path_safe,
    path_value,
    repo_owner,
    strip,
    title_and_body,
    topics_text,
)

__all__ = [
    "bulk_pr_state", "clip", "commit_text", "daily_pr_state", "date_or_null", "flag",
    "has_text", "int_or_null", "int_or_zero", "is_merge", "owner_or_blank", "path_safe",
    "path_value", "pr_status", "repo_owner", "strict_cast", "strip", "surrogate_key",
    "timestamp_or_null", "title_and_body", "topics_text",
]
