"""Landing of only what is new.

A ledger knows every response by name, with the file it came from, the file's
time and size, and a digest of its content. A delivery is a folder of responses:
its listing is compared with the ledger, and only files that it does not know as
they are get read. Of these, only responses whose content has changed are parsed;
their records replace the ones that the same response gave before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.session import scratch_path, shuffles_freed, stored
from segrisk.sources import keyed_store, landed
from segrisk.sources.versions import POINTER, delete, read_small

PARSERS = {"awards": landed.parse_awards, "trade": landed.parse_trade, "employment": landed.parse_employment}
NAME = "response"
LEDGER = f"{NAME} string, file string, modified timestamp, size long, digest string"


def _listing(spark: SparkSession, folder: str, name: Callable[[Column], Column] | None) -> DataFrame:
    """Files of a delivery; their content is read only where it is selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    own = name(F.col("path")) if name else F.regexp_extract("path", "([^/]+)$", 1)
    return files.select(
        own.alias(NAME), F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"),
        F.col("_metadata.file_path").alias("uri"), "content",
    )


def _bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of a delivery, of compressed files (``.gz``) as they were before."""
    texts = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return texts.select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_modification_time").alias("modified"),
        F.decode(F.col("value").cast("binary"), "UTF-8").alias("body"),
    )


def _has(spark: SparkSession, path: str) -> bool:
    return read_small(spark, f"{path}/{POINTER}") is not None


def land(
    spark: SparkSession, delivery: str, store: str, kind: str, name: Callable[[Column], Column] | None = None,
    strict: bool = True, buckets: int = keyed_store.BUCKETS,
) -> int:
    """Parse what is new in a delivery into the table below ``store``; returns how many responses were parsed.

    ``kind`` is awards, trade or employment. ``name`` says which response a file
    path is; without it, the file's name does. Of several files of one response
    in a delivery the latest counts, the greatest path among equally late ones.
    Empty files (no content) are no responses; files may be compressed.
    A response that cannot be read stops the landing, and neither its records nor
    the ledger change; with ``strict`` off it counts as one without records. If a
    landing is cut off, the next one parses the same responses again and replaces
    their records, so each counts once.
    """
    scratch = scratch_path(spark, "landing")
    try:
        with shuffles_freed(spark):
            return _land(spark, delivery, store, kind, name, strict, buckets, scratch)
    finally:
        delete(spark, scratch)


def _land(
    spark: SparkSession, delivery: str, store: str, kind: str, name: Callable[[Column], Column] | None,
    strict: bool, buckets: int, scratch: str,
) -> int:
    records_at, ledger_at = f"{store}/records", f"{store}/ledger"
    parse = PARSERS[kind]
    files = _listing(spark, delivery, name)
    listed = files.drop("content")
    latest = listed.groupBy(NAME).agg(F.max_by(F.struct("file", "modified", "size", "uri"), F.struct("modified", "file")).alias("f"))
    offered = latest.select(NAME, "f.*")
    if _has(spark, ledger_at):
        known = keyed_store.read(spark, ledger_at)
        as_is = [F.col(c) == F.col(f"_{c}") for c in ("file", "modified", "size")]
        seen = known.select(F.col(NAME).alias("_name"), *[F.col(c).alias(f"_{c}") for c in ("file", "modified", "size", "digest")])
        fresh = offered.join(seen, F.col(NAME) == F.col("_name"), "left")
        fresh = fresh.where(F.col("_name").isNull() | ~(as_is[0] & as_is[1] & as_is[2]))
    else:
        fresh = offered.withColumn("_digest", F.lit(None).cast("string"))
    fresh = stored(fresh.select(NAME, "file", "modified", "size", "uri", "_digest"), "fresh", scratch)
    since = fresh.agg(F.min("modified")).first()[0]
    if since is None:
        return 0
    # The time reaches the scans, so the content of files that were all there before is not read.
    late = F.col("modified") >= since
    content = files.where(late).select("file", F.sha2("content", 256).alias("digest"))
    read = stored(fresh.join(content, "file"), "read", scratch)
    changed = read.where(~F.col("digest").eqNullSafe(F.col("_digest")))
    n = changed.count()
    if n:
        # Bodies are read from the delivery, not kept a second time.
        bodies = _bodies(spark, delivery).where(late).drop("modified").join(changed.select(NAME, "uri"), "uri")
        parsed = stored(parse(bodies.select(NAME, "body"), strict=strict, keep=[NAME]), "parsed", scratch)
        if changed.join(_listing(spark, delivery, name), ["uri", "modified", "size"], "left_semi").count() < n:
            raise RuntimeError(f"{delivery}: files were changed while they were read")
        if not _has(spark, records_at):
            keyed_store.create(parsed.limit(0), records_at, [NAME], buckets)
        keyed_store.replace_keys(spark, records_at, changed.select(NAME), parsed)
    entry = read.select(NAME, "file", "modified", "size", "digest")
    if not _has(spark, ledger_at):
        keyed_store.create(spark.createDataFrame([], LEDGER), ledger_at, [NAME], buckets)
    keyed_store.update(spark, ledger_at, entry)
    return n


def records(spark: SparkSession, store: str) -> DataFrame:
    """Records of all responses as last delivered, with the column ``response``."""
    return keyed_store.read(spark, f"{store}/records")


def entries(spark: SparkSession, store: str) -> DataFrame:
    """The ledger: a row per response."""
    return keyed_store.read(spark, f"{store}/ledger")
