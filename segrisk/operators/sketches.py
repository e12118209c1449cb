"""Distinct counts that can be kept and merged.

A sketch of the values of each finest group is stored; coarser groups come from
merging sketches, without the rows. Up to ``ENTRIES`` distinct values a sketch
holds all their hashes, so its count is exact; beyond it keeps a sample of them by
hash, with a relative standard error of about 1 / sqrt(ENTRIES).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES = 12
ENTRIES = 1 << LOG_ENTRIES


def sketch(df: DataFrame, keys: Sequence[str], value: str, name: str = "sketch") -> DataFrame:
    """A sketch of the known values of each group."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(F.col(value), LOG_ENTRIES).alias(name))


def merge(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches of coarser groups; of the whole table without ``keys``."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg(F.col(name), LOG_ENTRIES).alias(name))


def estimate(sketches: DataFrame, count: str, name: str = "sketch") -> DataFrame:
    """The sketch of each row replaced by its count, and whether that is exact.

    A count of ``ENTRIES`` or more may be an estimate.
    """
    counted = sketches.withColumn(count, F.theta_sketch_estimate(F.col(name)))
    return counted.withColumn("is_exact", F.col(count) < ENTRIES).drop(name)
