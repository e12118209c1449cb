"""Rows laid out along a space-filling curve, so that predicates on any of several columns skip files.

Each column's distinct values are cut into at most 2**bits ranges of about equal
numbers of rows; a row's place on the curve takes the bits of its ranges in turn.
Files and row groups that hold a stretch of the curve then hold few ranges of
every column, which their statistics tell the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segrisk.session import stored

BITS = 8


def ranges_of(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Rows (value, range): the range of every distinct value, nulls first, about equal numbers of rows in each.

    Values are counted before they are numbered; the running sum needs the distinct values only.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.coalesce(F.sum("n").over(before), F.lit(0)) * (1 << bits) / F.sum("n").over(total)
    return counts.select("value", F.floor(share).cast("long").alias("range"))


def interleaved(ranges: Sequence[Column], bits: int = BITS) -> Column:
    """One number with the bits of all in turn, the highest of each first."""
    n = len(ranges)
    taken = [
        F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")), b * n + (n - 1 - i)) for i, r in enumerate(ranges) for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def along_curve(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` dealt and sorted along the curve over ``columns``; write it as it is.

    The ranges of a column are found from its distinct values and joined by value,
    so columns with few distinct values, such as codes, are meant.
    """
    placed = df
    for i, column in enumerate(columns):
        of = stored(ranges_of(df, column, bits), f"ranges{i}").select(F.col("value").alias(f"_v{i}"), F.col("range").alias(f"_r{i}"))
        placed = placed.join(of, F.col(f"`{column}`").eqNullSafe(F.col(f"_v{i}")))
    curve = interleaved([F.col(f"_r{i}") for i in range(len(columns))], bits)
    return placed.withColumn("_curve", curve).repartitionByRange("_curve").sortWithinPartitions("_curve").select(*df.columns)
