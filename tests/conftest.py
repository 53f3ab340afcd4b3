import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forgelake.schemas import RAW_API, RAW_TABLE  # noqa: E402
from forgelake.session import local_session  # noqa: E402
from forgelake.settings import Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path, request):
    tag = "".join(ch if ch.isalnum() else "_" for ch in request.node.name)[:40].lower()
    return Settings(
        root=str(tmp_path),
        raw_database=f"raw_{tag}",
        staging_database=f"staging_{tag}",
        mart_database=f"mart_{tag}",
    )


@pytest.fixture
def raw_rows(spark):
    """Rows of the raw table as text, from partial dicts."""

    def build(*rows):
        base = {
            "event_type": "PushEvent",
            "actor": "bob",
            "repo_name": "o/r",
            "created_at": "2024-01-02T03:04:05Z",
            "ingested_at": "2024-01-02T03:05:00Z",
        }
        names = RAW_TABLE.names
        schema = ", ".join(
            f"{n} boolean" if n in ("is_tracked", "pr_merged", "is_merge", "has_text") else f"{n} string"
            for n in names
        )
        return spark.createDataFrame(
            [tuple({**base, **r}.get(n) for n in names) for r in rows], schema
        )

    return build


@pytest.fixture
def api_rows(spark, tmp_path):
    """Nested API events from dicts, parsed as they would be from landed pages."""
    import json
    import uuid

    def build(*rows):
        path = tmp_path / f"api-{uuid.uuid4().hex}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        return spark.read.schema(RAW_API).json(str(path))

    return build
