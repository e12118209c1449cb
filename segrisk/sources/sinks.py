"""Writers. Each replaces what it names and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.formatting import plain_number
from segrisk.operators.shape import conform
from segrisk.plans.explore import display_view
from segrisk.plans.scoring import canonical, canonical_order, exported
from segrisk.schemas import MANIFEST, SCORED
from segrisk.session import stored
from segrisk.sources import keyed_store
from segrisk.sources.delimited import CSV_OPTIONS
from segrisk.sources.versions import publish, replace_folder

#: A page holds so many briefs at most; a filter tells which files cannot hold an identifier.
BRIEF_PAGES = {
    "parquet.page.row.count.limit": "16",
    "parquet.bloom.filter.enabled#identifier": "true",
    "parquet.bloom.filter.expected.ndv#identifier": "20000",
}


def write_raw(bodies: DataFrame, path: str) -> None:
    """Bronze: the responses exactly as received, one JSON string field per line."""
    replace_folder(bodies.sparkSession, path, bodies.select("body").write.json)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that any reader reads alike: fields with line ends are quoted, NULL is an empty field.

    Numbers are written in full digits.
    """
    cells = {name: plain_number(F.col(f"`{name}`")) for name, kind in df.dtypes if kind == "double"}
    replace_folder(df.sparkSession, path, df.withColumns(cells).write.options(**CSV_OPTIONS).csv)


def write_clean(df: DataFrame, path: str, *partition_by: str) -> None:
    """Silver as Parquet, split by period so that later scans skip files."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    replace_folder(df.sparkSession, path, writer.parquet)


def write_segments(segments: DataFrame, path: str) -> None:
    """The whole table as a new version; readers see the old one until it is complete."""
    publish(segments.sparkSession, path, conform(segments, SCORED).write.parquet)


def export_segments(segments: DataFrame, path: str) -> DataFrame:
    """Canonical CSV in canonical order; returns what was written.

    The range sort leaves one file for a small table and as many ordered files
    as needed for a large one; nothing is forced into a single task.
    """
    table = canonical(segments)
    write_clean_csv(exported(canonical_order(table)), path)
    return table


def write_briefs(briefs: DataFrame, path: str, buckets: int = keyed_store.BUCKETS) -> None:
    """Upsert by key: the identifiers in ``briefs``, one row each, are replaced, with the time of this write.

    Any number of briefs share a bounded number of files. Pages of a few briefs
    each, in order of identifier, let a lookup read little more than it wants.
    """
    spark = briefs.sparkSession
    fresh = briefs.select("identifier", "brief_text", F.current_timestamp().alias("modified_at"))
    if keyed_store.exists(spark, path):
        keyed_store.update(spark, path, stored(fresh, "briefs"))
    else:
        keyed_store.create(fresh, path, ["identifier"], buckets, BRIEF_PAGES)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Full snapshot of the current selection as a new version, absent values written as null."""
    record = F.to_json(F.struct(*MANIFEST.names), {"ignoreNullFields": "false"})
    publish(manifest.sparkSession, path, manifest.select(record.alias("value")).write.text)


def write_view_csv(view: DataFrame, path: str) -> None:
    """The filtered view under its display headings."""
    write_clean_csv(display_view(view), path)
