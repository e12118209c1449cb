"""Joins by key: alignment, upsert, padding, cache split, row lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of keyed aggregates; a NULL key matches nothing and survives.

    Every input holds one row per key, so the join works on aggregates only.
    """
    return reduce(lambda left, right: left.join(right, key, "full_outer"), frames)


def upsert(
    table: DataFrame,
    scores: DataFrame,
    key: str,
    applies: Column,
    defaults: Mapping[str, Column],
    elsewhere: Mapping[str, Column],
) -> DataFrame:
    """Replace score columns of the rows that apply; all other columns survive.

    Rows that apply take the score of their key, even a NULL one, and
    ``defaults`` only where the key has no score row at all. Rows that do not
    apply take ``elsewhere``. ``scores`` holds one row per key.
    """
    new = scores.select(
        F.col(key).alias("_key"),
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_new_{c}") for c in defaults],
    )
    joined = table.withColumn("_applies", applies).join(new, F.col(key) == F.col("_key"), "left")
    values = {
        c: F.when(F.col("_applies") & F.col("_hit"), F.col(f"_new_{c}"))
        .when(F.col("_applies"), defaults[c])
        .otherwise(elsewhere[c])
        for c in defaults
    }
    kept = [c for c in table.columns if c not in values]
    return joined.select(*kept, *[v.alias(c) for c, v in values.items()])


def missing_keys(df: DataFrame, required: DataFrame, key: str) -> DataFrame:
    """Required keys without a row. Only distinct keys are shuffled."""
    return required.join(df.select(key).distinct(), key, "left_anti")


def require_keys(df: DataFrame, required: DataFrame, key: str) -> DataFrame:
    """The table itself, or an error naming required keys that have no rows.

    Runs a job; what returns to the driver is at most the required keys.
    """
    absent = sorted(str(row[0]) for row in missing_keys(df, required, key).collect())
    if absent:
        raise ValueError(f"no rows for required {key}: {', '.join(absent)}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def pad_missing(df: DataFrame, required: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Add one row per required key without a row; ``values`` fill it, the rest is NULL.

    A full outer join reads the table once; an anti join plus union would
    compute it twice. Rows without a key match nothing and stay.
    """
    joined = df.withColumn("_present", F.lit(True)).join(required.select(key), key, "full_outer")
    added = F.col("_present").isNull()
    return joined.select(
        *[
            F.when(added, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def split_by_existing(df: DataFrame, existing: DataFrame, key: str, flag: str = "cached") -> DataFrame:
    """Mark the rows whose key already exists elsewhere, in one join.

    ``existing`` is reduced to its distinct keys first, so its copies neither
    multiply rows nor pile up on one task.
    """
    keys = existing.select(F.col(key).alias("_key")).distinct()
    marked = df.join(keys, F.col(key) == F.col("_key"), "left")
    return marked.withColumn(flag, F.col("_key").isNotNull()).drop("_key")


def only_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not exist yet; a NULL key never exists."""
    return df.join(existing.select(key).distinct(), key, "left_anti")


def same_row(keys: Mapping[str, object]) -> Column:
    """All keys equal, where NULL equals NULL."""
    return reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.lit(value)) for name, value in keys.items()],
    )
