"""Corpus pipeline: documents in, packed token sequences out.

Each stage calls one operator of ``segrisk.llm``, takes (spark, docs, sf_dir) and
returns what it kept; its result is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from segrisk.llm import jaccard, langid, packing, quality, substrings
from segrisk.llm.queries import documents, importable
from segrisk.session import stored

#: The model of the language stage and exact joins over all texts are not expressible in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and every rule."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, learned from the labelled rows of this stage, does not reject."""
    importable(spark)
    return langid.keep_known(docs, langid.fit(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    importable(spark)
    return jaccard.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that occur more than once."""
    importable(spark)
    return substrings.keep_unrepeated(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and the sequences they fill, with their ids."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
