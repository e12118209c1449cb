"""CSV of any writer, cut into records in parallel even where fields hold line feeds.

A line feed ends a record only where the quotes before it, from the beginning of
its file, are even in number. Spark cuts a large file into blocks that begin at
any line, so a block alone cannot tell. Each block counts its lines with an odd
number of quotes; a prefix sum over the blocks of a file, and a running count
within a block, number these lines through the whole file. An odd line that comes
after an even number of odd lines opens a record, the next odd line closes it, and
the opener's number names all lines between them. Every other line is a record.

Lines are written once to the shared folder with their place, so that all steps
see the same blocks. The counts are read from one narrow column of that table.
Blocks without odd lines take their number from the prefix sum alone and are not
shuffled; only the lines of records that span lines are grouped. Files without
such lines are left to Spark's own reader.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segrisk.session import stored

# Only an empty field is missing: a name such as "NA" stays a name. Blanks around
# a value belong to it, in both directions (Spark's writer trims them by default).
CSV_OPTIONS = {
    "header": True,
    "nullValue": "",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
MARK = "﻿"


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of the files of a path: value, file, block (first byte), at (order within it), odd."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.text(path, lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        (quotes % 2).alias("odd"),
    )


def files_of(lines: DataFrame) -> DataFrame:
    """Of every file the kinds of its lines (odd, with a carriage return), four at most, and its first line.

    Beside a set of kinds, first lines are found by hashing files; alone, all lines would be sorted by file.
    """
    kind = F.struct("odd", F.contains("value", F.lit("\r")).alias("returns"))
    first = F.min_by("value", F.struct("block", "at"))
    return lines.groupBy("file").agg(F.collect_set(kind).alias("kinds"), first.alias("first"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``before``, the odd lines of the file before each, and ``is_first``, the file's first line.

    A file with an odd number of odd lines has a quote that is never closed; this stops the job.
    """
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("n"), F.min("at").alias("first_at"))
    earlier = Window.partitionBy("file").orderBy("block")
    so_far = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    # One row a block, written so that its size is known: it is broadcast only if it is small.
    blocks = stored(
        blocks.withColumns({"earlier": F.coalesce(so_far, F.lit(0)), "number": F.row_number().over(earlier)}), "blocks"
    )
    open_files = blocks.groupBy("file").agg(F.sum("n").alias("n")).where("n % 2 = 1").select("file").limit(3).collect()
    if open_files:
        raise ValueError(f"a quote is never closed in {', '.join(r[0] for r in open_files)}")
    placed = lines.join(blocks, ["file", "block"])
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counted = F.col("earlier") + F.coalesce(F.sum("odd").over(within), F.lit(0))
    numbered = placed.where("n = 0").withColumn("before", F.col("earlier")).unionByName(
        placed.where("n > 0").withColumn("before", counted)
    )
    first = (F.col("number") == 1) & (F.col("at") == F.col("first_at"))
    return numbered.select("file", "block", "at", "value", "odd", "before", first.alias("is_first"))


def records(lines: DataFrame) -> DataFrame:
    """Records (file, record, is_first) of numbered lines, without line ends; line feeds within fields are kept."""
    even = F.col("before") % 2 == 0
    whole = lines.where(even & (F.col("odd") == 0)).select("file", F.col("value").alias("record"), "is_first")
    name = F.col("before") + F.when(even, 1).otherwise(0)
    pieces = lines.where(~even | (F.col("odd") == 1)).groupBy("file", name.alias("name"))
    joined = pieces.agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("p"), F.max("is_first").alias("is_first")
    ).select("file", F.array_join(F.transform("p", lambda p: p["value"]), "\n").alias("record"), "is_first")
    ended = F.regexp_replace("record", "\r$", "")
    return whole.unionByName(joined).withColumn("record", F.when(F.endswith("record", F.lit("\r")), ended).otherwise(F.col("record")))


def _names(header: str, sep: str) -> list[str]:
    """Column names of a header record, which may hold line feeds."""
    return next(csv.reader([header.removeprefix(MARK)], delimiter=sep), [])


def _cells(record: Column, n: int, sep: str) -> Column:
    """The first ``n`` fields of a record, as text; absent and empty ones are NULL."""
    kind = ", ".join(f"c{i} string" for i in range(n))
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k != "header"}
    return F.from_csv(record, kind, options | {"sep": sep, "multiLine": "true"})


def _place(names: Sequence[str], wanted: str) -> int | None:
    return names.index(wanted) if wanted in names else None


def read_delimited(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Named columns of CSV files with header, all as text.

    Quoting is by the common rule: a field with the separator, a quote or a line
    end stands in quotes, a quote in it is doubled. Lines end with a line feed,
    with or without a carriage return; inside quotes both are kept. A mark of the
    encoding is skipped. Each file's own header says where a column stands; a
    column that it lacks is NULL, as are empty fields, quoted or not. Blank lines
    are skipped, fields beyond the header ignored. Files without any line have no rows.

    Two small jobs look at the files first: one tells whether a file has odd lines or
    carriage returns and takes its first line. Files that need neither
    joining of lines nor a look at their own header are read lazily by Spark.
    """
    lines = file_lines(spark, path)
    of_file = stored(files_of(lines), "files")
    simple = F.forall("kinds", lambda k: (k["odd"] == 0) & ~k["returns"])
    all_simple = of_file.agg(F.bool_and(simple)).first()[0]
    if all_simple is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    heads = [r[0] for r in of_file.select("first").distinct().limit(2).collect()]
    if all_simple and len(heads) == 1:
        names = _names(heads[0], sep)
        kind = ", ".join(f"c{i} string" for i in range(len(names)))
        table = spark.read.schema(kind).options(**CSV_OPTIONS, sep=sep, lineSep="\n").csv(path)
        return table.select(*[_column(F.col, _place(names, c)).alias(c) for c in columns])
    return _parsed(records(numbered_lines(stored(lines, "lines"))), columns, sep)


def _column(cell, place: int | None) -> Column:
    return F.lit(None).cast("string") if place is None else cell(f"c{place}")


def _parsed(found: DataFrame, columns: Sequence[str], sep: str) -> DataFrame:
    """Columns of records by the header of each file."""
    heads = stored(found.where("is_first").select("file", F.col("record").alias("head")), "heads")
    distinct = heads.select("head").distinct()
    rows = found.where("NOT is_first AND record <> ''")
    if distinct.limit(2).count() == 1:
        names = _names(heads.first()["head"], sep)
        cells = rows.select(_cells(F.col("record"), len(names), sep).alias("c"))
        return cells.select(*[_column(lambda c: F.col(f"c.{c}"), _place(names, c)).alias(c) for c in columns])
    # Headers are parsed as records are; the widest has one separator less than fields at most.
    plain = F.regexp_replace("head", f"^{MARK}", "")
    width = heads.agg(F.max(F.length("head") - F.length(F.replace("head", F.lit(sep), F.lit(""))))).first()[0] + 1
    listed = lambda record: F.array(*[_cells(record, width, sep)[f"c{i}"] for i in range(width)])
    places = heads.select("file", *[F.array_position(listed(plain), c).alias(f"_{i}") for i, c in enumerate(columns)])
    parsed = rows.join(places, "file").withColumn("_cells", listed(F.col("record")))
    at = lambda i: F.when(F.col(f"_{i}") > 0, F.try_element_at("_cells", F.col(f"_{i}").cast("int")))
    return parsed.select(*[at(i).alias(c) for i, c in enumerate(columns)])
