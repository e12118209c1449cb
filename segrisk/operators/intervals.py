"""Rows by the periods that contain their day: an equi-join on bins of days, with exact edges.

A period is listed under every bin that it touches, a row belongs to the one bin
of its day, so a pair can meet once only. Where the number of rows per period is
wanted, rows are summed by day first, and what meets the periods grows with the
number of days, not of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a bin: a period of a year is listed under a dozen bins.
BIN_DAYS = 32


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width)


def listed(periods: DataFrame, start: str, end: str, width: int = BIN_DAYS) -> DataFrame:
    """Periods with ``_bin``, a row for each bin. Periods without an edge, or that end before they start, hold no day."""
    valid = periods.where(F.col(start) <= F.col(end))
    return valid.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width), _bin(F.col(end), width))))


def within_periods(rows: DataFrame, day: str, periods: DataFrame, start: str, end: str, width: int = BIN_DAYS) -> DataFrame:
    """Every pair of a row and a period from ``start`` to ``end``, both included, that contains its ``day``.

    Columns of both, whose names must differ. A bin with very many rows is split by the skew join.
    """
    dealt = rows.where(F.col(day).isNotNull()).withColumn("_bin", _bin(F.col(day), width))
    return dealt.join(listed(periods, start, end, width), "_bin").where(F.col(day).between(F.col(start), F.col(end))).drop("_bin")


def sums_by_period(
    rows: DataFrame, day: str, periods: DataFrame, key: str, start: str, end: str, sums: Mapping[str, Column], width: int = BIN_DAYS
) -> DataFrame:
    """Sums of whole numbers over the rows in each period; a period without rows has NULL sums.

    ``sums`` name sums of columns of ``rows``; they are made by day before they meet the periods.
    ``key`` identifies a period.
    """
    by_day = rows.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("_day")).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    pairs = within_periods(by_day, "_day", periods.select(F.col(key).alias("_key"), start, end), start, end, width)
    found = pairs.groupBy("_key").agg(*[F.sum(n).alias(n) for n in sums])
    return periods.join(found, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
