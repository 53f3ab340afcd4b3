"""Extra columns under any name, empty tables and very long texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgelake.llm import decontaminate, langid, pieces, pii, secrets, url_cascade
from forgelake.llm.queries import PIECES_MODEL

EXTRA = ("key", "key_", "_key", "matched", "made", "key_hash", "input", "h1", "rank", "vector", "salt", "node", "list")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "mail bob@example.com today", "en"), (2, "", "en"), (3, None, "en"), (4, "word " * 40_000, "en"), (1, "mail bob@example.com today", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return df.withColumns({c: F.lit(f"mine {c}") for c in EXTRA})


def untouched(df):
    kept = [c for c in EXTRA if c in df.columns]
    assert len(kept) == len(EXTRA)
    assert all(r[c] == f"mine {c}" for r in df.select(*kept).collect() for c in kept)


def test_extra_columns_pass_through_pseudonyms(docs):
    out = pii.pseudonymise(docs)
    untouched(out)
    assert out.count() == docs.count() and pii.pseudonymise(docs.limit(0)).count() == 0
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[3] is None and texts[2] == "" and texts[4] == "word " * 40_000
    assert "bob@" not in texts[1] and texts[1].endswith("@example.com today")


def test_extra_columns_pass_through_pieces(docs):
    vocabulary = pieces.load(PIECES_MODEL)
    out = pieces.encode(docs, vocabulary, decoded_col="decoded")
    untouched(out)
    rows = out.collect()
    assert all(r.decoded == r.text for r in rows)  # the long text goes by chunks
    assert sorted(len(r.token_ids) for r in rows if r.text is not None)[0] == 0
    apart = pieces.decode(pieces.encode(docs, vocabulary), vocabulary).collect()
    assert sorted(map(repr, apart)) == sorted(map(repr, rows))
    assert pieces.encode(docs.limit(0), vocabulary, decoded_col="decoded").count() == 0


def test_pieces_remember_boundedly(monkeypatch):
    vocabulary = pieces.load(PIECES_MODEL)
    text = " ".join(f"token{i} and more" for i in range(400))
    whole = pieces.Encoder(vocabulary).ids(text)
    monkeypatch.setattr(pieces, "_REMEMBERED", 3000)
    small = pieces.Encoder(vocabulary)
    assert small.ids(text) == whole == small.ids(text)
    assert len(small.known) + len(small.older) < 60


def test_language_of_odd_texts(spark, docs):
    learned = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(learned)
    out = langid.identify(docs, model, *docs.columns)
    untouched(out)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == "und" and rows[4].lang_pred in model.languages


def test_url_lookup_keeps_columns(spark):
    universe = spark.createDataFrame([(f"h{i}", i % 3 == 0) for i in range(50)], "key string, listed boolean")
    df = spark.createDataFrame([("h3", "a"), ("h4", "b"), (None, "c")], "host string, key_hash string")
    rows = {r.host: (r.key_hash, r.listed) for r in url_cascade.exact_member(df, "host", universe).collect()}
    assert rows == {"h3": ("a", True), "h4": ("b", False), None: ("c", False)}


def test_scans_of_long_and_no_texts(spark, docs):
    items = spark.createDataFrame([("b1", "word " * 12), ("b2", None)], "item_id string, text string")
    rows = {r.doc_id: r for r in decontaminate.report(docs.select("doc_id", "text"), items).collect()}
    assert rows[4].n_words == rows[4].n_hit == 40_000 and rows[1].n_hit == 0 and rows[3].n_words == 0
    long = spark.createDataFrame([(1, "x " * 500_000 + "token=abcdefgh")], "doc_id bigint, text string")
    (row,) = secrets.digests(secrets.scan(long)).collect()
    assert row.n_assign == 1 and row.spans == "assign:1000000:1000014"
    assert secrets.digests(secrets.scan(long.limit(0))).count() == 0
    assert np.__name__
