"""Top-k and ordered output. ``limit`` after ``orderBy`` never sorts the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segrisk.session import scratch_path


def descending(column: str, *ties: str) -> list[Column]:
    """Highest first, NULLs last, ties by the given columns."""
    return [F.col(column).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]


def top_k(df: DataFrame, k: int, order: Sequence[Column], rank: str | None = None) -> DataFrame:
    """First ``k`` rows; with ``rank``, numbered from 1.

    The numbering window has no partition, but sees only the ``k`` rows kept.
    """
    best = df.orderBy(*order).limit(k)
    if rank is None:
        return best
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_k_plus_all(
    first: DataFrame, k: int, order: Sequence[Column], rest: DataFrame, branch: str = "branch"
) -> DataFrame:
    """The best ``k`` of one kind, then every row of another; ``branch`` keeps the order."""
    best = top_k(first, k, order).withColumn(branch, F.lit(0))
    return best.unionByName(rest.withColumn(branch, F.lit(1)))


def number_rows(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Ordinal of every row of a table of any size.

    The sorted table is written to the shared folder once, so that the part
    files, and with them the row numbers, stay the same if an executor is lost.
    Numbers are a per-part offset plus the position within the part; only the
    part sizes, one row per file, meet in a window, and the offsets reach the
    rows as one array, so the table is not shuffled a second time. Rows that are
    equal in all sort columns are spread over parts by a hash of the whole row.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    part = F.spark_partition_id()
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    (
        df.withColumn("_spread", F.xxhash64(*df.columns))
        .orderBy(*order, "_spread")
        .withColumns({"_part": part, "_position": position})
        .drop("_spread")
        .write.parquet(path)
    )
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("_part").agg(F.max("_position").alias("_size"))
    # An entry for every part up to the last, so that a row finds its offset by place.
    parts = sizes.agg(F.max("_part").alias("last")).select(F.explode(F.sequence(F.lit(0), "last")).alias("_part"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_size").over(before), F.lit(0))
    placed = parts.join(sizes, "_part", "left").select(F.struct("_part", offset.alias("offset")).alias("o"))
    offsets = placed.agg(F.transform(F.sort_array(F.collect_list("o")), lambda o: o["offset"])).scalar()
    number = F.get(offsets, F.col("_part")) + F.col("_position")
    return rows.select(*df.columns, number.alias(rank))
