"""Projections: renaming, conforming to a schema, mapping codes, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from segrisk.functions.values import round_even


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[name for name in wanted if name in have])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns in order; absent ones become typed NULLs."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(name: str, kind: DataType) -> Column | str:
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        return name if have[name] == kind else F.col(name).cast(kind).alias(name)

    return df.select(*[column(f.name, f.dataType) for f in schema.fields])


def round_columns(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


def blank_text(df: DataFrame) -> DataFrame:
    """NULL strings become empty ones for display; numbers keep their NULLs."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    return df.na.fill("", subset=strings) if strings else df


def unique_headers(names: Column) -> Column:
    """A repeated header gets its repetition number: ``H, H`` -> ``H, H_1``. For one short list per row."""

    def numbered(name: Column, i: Column) -> Column:
        again = F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == name))
        return F.when(again > 0, F.concat(name, F.lit("_"), again.cast("string"))).otherwise(name)

    return F.transform(names, numbered)


def map_codes(
    df: DataFrame, mapping: DataFrame, key: str, value: str, keep_unmapped: bool = True
) -> DataFrame:
    """Attach ``value`` from a constant mapping table; unmapped rows get NULL or go.

    The mapping is a local relation, so it is broadcast by its known size.
    """
    return df.join(mapping.select(key, value), key, "left" if keep_unmapped else "inner")


def map_literal(code: Column, mapping: Mapping[str, str]) -> Column:
    """The value of a short constant mapping, or NULL: an expression, so the table is not joined at all."""
    found = F.lit(None).cast("string")
    for key, value in mapping.items():
        found = F.when(code == key, F.lit(value)).otherwise(found)
    return found


def map_codes_or(
    df: DataFrame, mapping: DataFrame, key: str, value: str, fallback: Column
) -> DataFrame:
    mapped = map_codes(df, mapping, key, value)
    return mapped.withColumn(value, F.coalesce(F.col(value), fallback))


def entries(df: DataFrame, array: Column, *keep: str) -> DataFrame:
    """One row per array entry, with its position from 0.

    The outer form, filtered afterwards: for a plain explode the optimizer adds
    a check for non-empty arrays that would compute the array a second time.
    """
    return df.select(*keep, F.posexplode_outer(array).alias("position", "entry")).where(
        F.col("position").isNotNull()
    )
