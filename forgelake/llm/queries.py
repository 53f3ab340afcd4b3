"""Registered queries of the operators; each reads whole tables. SQL twins are in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm import chaining, dart_minhash, decontaminate, dual_tree, fim, group_join, langid, pieces, pii, secrets, topk, url_cascade, warc
from forgelake.llm.tables import shipped, stored, table
from forgelake.settings import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
QUERY_STEP, NEAREST = 50, 5


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shipped(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where(F.col("id") % QUERY_STEP == 0), vectors, NEAREST)


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load(PIECES_MODEL)
    decoded = pieces.encode(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary, decoded_col="decoded")
    return decoded.select(
        "doc_id",
        "token_ids",
        F.coalesce(F.size("token_ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.length("decoded").cast("bigint").alias("decoded_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.translate("text", pieces.SPACE, " ")).alias("round_trip"),
    )


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    warc.write(table(spark, sf_dir, "pages"), f"{path}/archive")
    records = warc.read(spark, f"{path}/archive", payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"))
    counts = [F.size(F.array_remove("pii_found", kind)) for kind in pii.KINDS]
    counts = [(F.size("pii_found") - n).cast("bigint").alias(f"n_{kind}") for n, kind in zip(counts, pii.KINDS)]
    return found.select("doc_id", "text", *counts)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages", "page_id", "url"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs), "doc_id")
    held_out = F.coalesce(langid.remainder() == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


@query
def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op13_dual_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    books = dual_tree.fit(vectors)
    coded = stored(dual_tree.encode(vectors, books).drop("embedding"), "codes")
    digest = F.lit(books.sha256()).alias("codebooks_sha256")
    return dual_tree.with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest)


@query
def op12_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.classes(table(spark, sf_dir, "documents", "doc_id", "text"))
