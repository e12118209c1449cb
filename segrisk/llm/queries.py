"""Queries of the operators over whole tables: thin, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.llm import (
    bpe, classifier, fingerprints, html, jaccard, langid, licenses, merkle, oracle, packing, quality, search, substrings,
    tokencounts,
)
from segrisk.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TEXT_ORACLE: dict[str, str] = {
    "op6_quality_rules": oracle.OP6.replace("STOP", " ".join(quality.STOP_WORDS)),
    "op11_lexical_search": oracle.OP11,
    "op13_merkle_manifest": oracle.OP13,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def importable(spark: SparkSession) -> None:
    """Let Python workers that run on this machine import this package from its folder.

    On a cluster the package is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.select("doc_id", "text", "lang").filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.guess(model, F.col("text")).alias("_p"))
    return found.select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.rejected")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and the sequences they fill."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), ids=False)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    return bpe.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), ids=False)


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of every document and the component it is in."""
    return jaccard.join(documents(spark, sf_dir))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.compare_edited(documents(spark, sf_dir))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality.judge(documents(spark, sf_dir))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(f"_m.{n}") for n in names], "base_failed", "kept")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document, and where they stand."""
    return licenses.scan(documents(spark, sf_dir))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what repeated substrings cost every document, and a digest of what is left."""
    return substrings.remove_repeats(documents(spark, sf_dir)).drop("kept")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return tokencounts.count(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    importable(spark)
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    described = documents(spark, sf_dir).select(
        "doc_id", held_out.alias("held_out"), classifier.describe(F.col("text")).alias("statistics")
    )
    rows = stored(described, "described")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = classifier.fit(rows, labels.filter(~held_out))
    scored = rows.select("doc_id", "held_out", classifier.score(model, F.col("statistics")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the root of all, some of them tampered with."""
    docs = documents(spark, sf_dir)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return merkle.document_manifest(docs, tampered)
