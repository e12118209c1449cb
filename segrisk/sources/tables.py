"""Silver and gold tables: CSV and Parquet scans with fixed schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segrisk.functions.values import parse_number
from segrisk.operators.shape import conform
from segrisk.schemas import AWARDS, EMPLOYMENT, MANIFEST, SCORED, SEGMENTS, TRADE
from segrisk.sources import keyed_store
from segrisk.sources.delimited import read_delimited
from segrisk.sources.versions import current

def read_csv_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every column as text, whoever wrote the file; see ``read_delimited``."""
    return read_delimited(spark, path, schema.names)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Text scan, then tolerant casts: a bad number is NULL, not an error."""
    text = read_csv_text(spark, path, schema)
    typed = {}
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("double", "bigint", "int"):
            number = parse_number(F.col(field.name))
            typed[field.name] = number if kind == "double" else number.try_cast(kind)
        elif kind == "date":
            typed[field.name] = F.col(field.name).try_cast("date")
    return text.withColumns(typed) if typed else text


def read_awards(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, AWARDS)


def read_trade(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRADE)


def read_employment(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, EMPLOYMENT)


def read_segments_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SEGMENTS)


def read_segments(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Stored segments of the current version; projection and predicate reach the Parquet scan."""
    df = spark.read.schema(SCORED).parquet(current(spark, path))
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_briefs(spark: SparkSession, path: str, extension: str = ".txt") -> DataFrame:
    """Folder of whole-text briefs: identifier from the file name, file time beside it.

    The same file in two places is told apart only by its folder, so a brief is
    read from one folder, one file per identifier.
    """
    name = F.col("_metadata.file_name")
    return spark.read.text(path, wholetext=True, pathGlobFilter=f"*{extension}").select(
        F.substring(name, F.lit(1), F.length(name) - F.lit(len(extension))).alias("identifier"),
        F.col("value").alias("brief_text"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def read_brief_store(spark: SparkSession, path: str) -> DataFrame:
    """Briefs written by ``write_briefs``: identifier, brief_text, modified_at."""
    return keyed_store.read(spark, path)


def find_briefs(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The briefs of the identifiers in ``wanted``.

    Up to ``MOST_FOUND`` of them, a number that is measured, are pushed to the
    scan, which reads the pages that hold them; more are joined with their buckets.
    """
    keys = wanted.select("identifier").distinct()
    few = [r[0] for r in keys.limit(keyed_store.MOST_FOUND + 1).collect()]
    if len(few) > keyed_store.MOST_FOUND:
        return keyed_store.lookup(spark, path, keys)
    return keyed_store.find(spark, path, few)


def load_briefs(segments: DataFrame, briefs: DataFrame) -> DataFrame:
    """Each identified segment with its brief, NULL where there is none yet."""
    return segments.join(briefs, "identifier", "left")


def read_manifest(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Manifest records of the current version: one JSON object per line, or files holding one JSON array."""
    folder = path if array_file else current(spark, path)
    return conform(spark.read.schema(MANIFEST).json(folder, multiLine=array_file), MANIFEST)
