"""Columns derived from an event's type, action and merge flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgelake.schemas import PULL_REQUEST


def _merged(pr_merged: Column) -> Column:
    return F.coalesce(pr_merged, F.lit(False))


def is_merge(event_type: Column, pr_merged: Column) -> Column:
    """A pull request known to be merged; unknown counts as not merged."""
    return F.coalesce(event_type == PULL_REQUEST, F.lit(False)) & _merged(pr_merged)


def has_text(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))) > 0


def bulk_pr_state(event_type: Column, pr_merged: Column, action: Column) -> Column:
    """State from the action, blank for anything but a pull request."""
    return (
        F.when(F.coalesce(event_type, F.lit("")) != PULL_REQUEST, F.lit(""))
        .when(_merged(pr_merged), F.lit("merged"))
        .when(action == "closed", F.lit("closed"))
        .otherwise(F.lit("open"))
    )


def daily_pr_state(event_type: Column, pr_merged: Column, api_state: Column) -> Column:
    """State as the API reports it, null for anything but a pull request."""
    return F.when(
        event_type == PULL_REQUEST,
        F.when(_merged(pr_merged), F.lit("merged")).otherwise(
            F.coalesce(api_state, F.lit("open"))
        ),
    )


def pr_status(is_merge_: Column, action: Column) -> Column:
    return (
        F.when(is_merge_, F.lit("merged"))
        .when(action == "closed", F.lit("closed"))
        .otherwise(F.lit("open"))
    )
