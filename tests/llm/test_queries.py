"""Registered queries against their SQL twins, and the pipeline against its operators."""

import pytest

import corpus_pipeline
from forgelake.llm import dart_minhash, decontaminate, langid, pieces, pii
from forgelake.llm.oracles import ORACLE
from forgelake.llm.queries import PIECES_MODEL, QUERIES
from forgelake.llm.tables import DOCUMENTS
from tools.check_oracle import canonical, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df, twin = QUERIES[name](spark, SF), duck(SF).sql(ORACLE[name])
    assert canonical(df.columns, df.collect()) == canonical(twin.columns, twin.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_language_query_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op10_language_id"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) > 0.9


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    # The same decisions, taken one by one over all documents.
    known = [r for r in langid.identify(docs, langid.fit(docs), "doc_id", "text").collect() if not r.rejected]
    texts = {r.doc_id: r.text for r in known}
    kept = []
    for i in sorted(texts):
        if not any(dart_minhash.similarity(texts[i].encode(), texts[j].encode()) >= 0.8 for j in kept):
            kept.append(i)
    report = decontaminate.report(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    clean = {r.doc_id for r in report.where("NOT contaminated").collect()}
    assert set(rows) == set(kept) & clean
    new = {r.doc_id: r.text for r in pii.pseudonymise(docs).collect()}
    assert all(r.text == new[i] and r.round_trip and r.n_tokens == len(r.token_ids) for i, r in rows.items())
    encoder = pieces.Encoder(pieces.load(PIECES_MODEL))
    assert all(r.token_ids == encoder.ids(pieces.SPACE + r.text.replace(" ", pieces.SPACE)) for r in rows.values())


def test_stages_return_the_documents_columns(spark):
    none = spark.createDataFrame([(1, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (none.limit(0), none):
            out = stage(spark, docs, SF)
            assert name == "sentencepiece" or out.columns == list(DOCUMENTS)
            assert out.count() == (0 if docs is not none or name == "language_id" else 1)
