"""Documents through language ID, near-duplicate removal, benchmark decontamination,
pseudonyms and SentencePiece pieces. Each stage is written as Parquet and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm import dart_minhash, decontaminate, langid, pieces, pii
from forgelake.llm.queries import PIECES_MODEL
from forgelake.llm.tables import DOCUMENTS, shipped, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, named by the classifier."""
    shipped(spark)
    docs = docs.select(*DOCUMENTS)
    found = langid.identify(docs, langid.fit(docs), *DOCUMENTS)
    kept = found.where(~F.col("rejected")).withColumn("lang", F.col("lang_pred"))
    return kept.select(*DOCUMENTS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    shipped(spark)
    return dart_minhash.drop_duplicates(docs.select(*DOCUMENTS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    shipped(spark)
    return decontaminate.drop_documents(docs.select(*DOCUMENTS), table(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data under pseudonyms."""
    found = pii.pseudonymise(docs.select(*DOCUMENTS))
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*DOCUMENTS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, and whether they decode to the text."""
    shipped(spark)
    vocabulary = pieces.load(PIECES_MODEL)
    decoded = pieces.encode(docs.select(*DOCUMENTS), vocabulary, decoded_col="decoded")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "text",
        "token_ids",
        F.coalesce(F.size("token_ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.translate("text", pieces.SPACE, " ")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("sentencepiece", sentencepiece),
]
ORACLE_SQL = None  # SQL cannot express the classifier, the signatures or the pieces


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
