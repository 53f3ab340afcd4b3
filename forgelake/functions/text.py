"""Text rules: truncation, stripping, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's ``str.strip`` removes. SQL ``trim``
# removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
COMMIT_SEPARATOR = " | "
COMMITS_SHOWN = 5


def clip(c: Column, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(c, 1, n)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def title_and_body(title: Column, body: Column, n: int = 500) -> Column:
    """``title body`` clipped to ``n``; either part may be missing."""
    return clip(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit(""))), n)


def commit_text(commits: Column, each: int | None = None, total: int | None = None) -> Column:
    """Messages of the first commits on one line, optionally clipped."""

    def message(commit: Column) -> Column:
        text = F.coalesce(commit["message"], F.lit(""))
        return clip(text, each) if each else text

    joined = F.array_join(F.transform(F.slice(commits, 1, COMMITS_SHOWN), message), COMMIT_SEPARATOR)
    joined = F.coalesce(joined, F.lit(""))
    return clip(joined, total) if total else joined


def repo_owner(repo_name: Column) -> Column:
    """Text before the first slash; the whole name when there is none."""
    return F.split_part(repo_name, F.lit("/"), F.lit(1))


def owner_or_blank(repo_name: Column) -> Column:
    """Like :func:`repo_owner`, but blank for a name without a slash."""
    return F.when(F.contains(repo_name, F.lit("/")), repo_owner(repo_name)).otherwise(F.lit(""))


def path_safe(c: Column) -> Column:
    return F.translate(c, "/", "_")


def path_value(path: Column, key: str) -> Column:
    """Value of ``key=`` in a file path: a folder name or the Parquet file's own name."""
    value = F.regexp_extract(path, key + r"=([^/]+?)(?:\.parquet)?(?:/|$)", 1)
    # The path is a URI, and a partition folder's name is escaped once more in it.
    once = _percent_decoded(value)
    plain = F.coalesce(_percent_decoded(once), once)
    return F.when((value != "") & (value != "__HIVE_DEFAULT_PARTITION__"), plain)


def _percent_decoded(c: Column) -> Column:
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def topics_text(topics: Column) -> Column:
    """Array as JSON text; null becomes an empty list."""
    return F.coalesce(F.to_json(topics), F.lit("[]"))
