"""Rows known by a hash of all their columns, whatever the columns are named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns; those with a map in them, which have no hash, count by their JSON text."""
    columns = []
    for field in df.schema.fields:
        column = quoted(field.name)
        columns.append(F.to_json(F.struct(column.alias("value"))) if "map<" in field.dataType.simpleString() else column)
    return F.xxhash64(*columns)
