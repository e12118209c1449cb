"""A stored table whose rows are dealt to buckets by a hash of their key.

A change writes again only the buckets that hold a changed key; a small file in
the new version lists, for every bucket, the version that holds its rows, so all
other files stay as they are and are read from where they stand. Versions are
swapped as in ``versions``. Nulls in keys are values like any other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from segrisk.sources.versions import current, file_system, pointer, publish, read_small, write_small

#: Rows of a bucket are rewritten together: about so many buckets that one holds 128 MB.
BUCKETS = 64
PARTS = "_parts.json"
BUCKET = "_bucket"
#: Values of a point lookup, which stand in its plan.
MOST_FOUND = 1_000


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def parts(spark: SparkSession, path: str, version: str | None = None) -> dict:
    """The list of a version (the current one): ``buckets``, ``keys``, ``schema`` and the ``held`` map of bucket to version."""
    folder = f"{path}/{version}" if version else current(spark, path)
    text = read_small(spark, f"{folder}/{PARTS}")
    if text is None:
        raise FileNotFoundError(f"{path} holds no keyed table")
    return json.loads(text)


def needed(spark: SparkSession, path: str) -> Callable[[str], Iterable[str]]:
    return lambda version: set(parts(spark, path, version)["held"].values())


def _write_buckets(rows: DataFrame, listing: dict, folder: str) -> list[str]:
    """Write rows by bucket, in key order so that pages know their range; returns the buckets that have any."""
    spark = rows.sparkSession
    dealt = rows.withColumn(BUCKET, bucket_of(listing["keys"], listing["buckets"]))
    ordered = dealt.repartition(BUCKET).sortWithinPartitions(BUCKET, *[f"`{k}`" for k in listing["keys"]])
    ordered.write.options(**listing.get("options", {})).partitionBy(BUCKET).parquet(folder)
    system, place = file_system(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return [n.partition("=")[2] for n in names if n.startswith(f"{BUCKET}=")]


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, options: dict[str, str] | None = None) -> str:
    """Write ``df`` as a keyed table, or replace the one that is there. Returns the version's name.

    ``options`` of the Parquet writer hold for this and all later versions.
    """
    spark = df.sparkSession
    listing = {"buckets": buckets, "keys": list(keys), "schema": df.schema.jsonValue(), "options": options or {}}

    def write(folder: str) -> None:
        name = folder.rpartition("/")[2]
        held = {b: name for b in _write_buckets(df, listing, folder)}
        write_small(spark, f"{folder}/{PARTS}", json.dumps(listing | {"held": held}))

    return publish(spark, path, write, needs=needed(spark, path))


def _scan(spark: SparkSession, path: str, listing: dict, buckets: Iterable[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(listing["schema"])
    use = listing["held"] if buckets is None else {b: listing["held"][b] for b in buckets if b in listing["held"]}
    folders = [f"{path}/{version}/{BUCKET}={b}" for b, version in sorted(use.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; a later change does not reach a frame that was read before it."""
    return _scan(spark, path, parts(spark, path))


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Rows of the keys in ``wanted``; only their buckets are read."""
    listing = parts(spark, path)
    keys = wanted.select(*[f"`{k}`" for k in listing["keys"]]).distinct()
    found = _scan(spark, path, listing, _touched(keys, listing))
    return found.join(keys, same_key(found, keys, listing["keys"]), "left_semi")


def exists(spark: SparkSession, path: str) -> bool:
    return pointer(spark, path)["current"] is not None


def _any_of(key: Column, values: Sequence) -> Column:
    """``key`` is one of the values, as a balanced tree that the scan takes whole; a list it would cut or nest too deep."""
    if len(values) <= 1:
        return key == F.lit(values[0]) if values else F.lit(False)
    half = len(values) // 2
    return _any_of(key, values[:half]) | _any_of(key, values[half:])


def find(spark: SparkSession, path: str, values: Sequence) -> DataFrame:
    """Rows whose key, a single column, is among a list of up to ``MOST_FOUND`` values.

    Of the buckets that they belong to, only pages whose range holds a value are
    read, since all values reach the scan.
    """
    if len(values) > MOST_FOUND:
        raise ValueError(f"{len(values)} values: put them into a table and use lookup")
    listing = parts(spark, path)
    (key,) = listing["keys"]
    kind = StructType.fromJson(listing["schema"])[key].dataType
    wanted = spark.createDataFrame([(v,) for v in values], StructType([StructField(key, kind)]))
    rows = _scan(spark, path, listing, _touched(wanted, listing))
    return rows.where(_any_of(F.col(f"`{key}`"), sorted(set(values))))


def _touched(keys: DataFrame, listing: dict) -> list[str]:
    """Buckets of some keys; at most as many rows as there are buckets reach the driver."""
    rows = keys.select(bucket_of(listing["keys"], listing["buckets"]).alias("b")).distinct().collect()
    return [str(r["b"]) for r in rows]


def rewrite(
    spark: SparkSession, path: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], note: str | None = None
) -> list[str]:
    """Replace the rows of the buckets that hold the keys in ``touched`` by ``change`` of them.

    ``change`` sees all rows of these buckets, and returns rows with the same
    columns whose keys belong to them. Returns the buckets written again; without
    any key nothing is written. A change that started from a version no longer
    current is refused. ``note`` is kept with the version and its successors, see ``noted``.
    """
    start = pointer(spark, path)["current"]
    listing = parts(spark, path, start)
    buckets = _touched(touched, listing)
    if not buckets:
        return []
    schema = StructType.fromJson(listing["schema"])
    rows = change(_scan(spark, path, listing, buckets)).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields])

    def write(folder: str) -> None:
        name = folder.rpartition("/")[2]
        held = {b: v for b, v in listing["held"].items() if b not in buckets}
        filled = _write_buckets(rows, listing, folder)
        astray = set(filled) - set(buckets)
        if astray:
            raise ValueError(f"changed rows belong to other buckets: {sorted(astray)[:5]}")
        held |= {b: name for b in filled}
        notes = [*listing.get("notes", []), *([note] if note else [])]
        write_small(spark, f"{folder}/{PARTS}", json.dumps(listing | {"held": held, "notes": notes}))

    publish(spark, path, write, expected=start, needs=needed(spark, path))
    return buckets


def noted(spark: SparkSession, path: str, note: str) -> bool:
    """Whether a change with this note is part of the table."""
    return note in parts(spark, path).get("notes", [])


def update(spark: SparkSession, path: str, changes: DataFrame, insert: bool = True, note: str | None = None) -> list[str]:
    """Set the columns of ``changes`` in the rows of its keys; other columns and rows survive.

    ``changes`` holds the key columns, one row per key, and any other columns. A key that the
    table lacks becomes a row, its other columns NULL, unless ``insert`` is off.
    """
    listing = parts(spark, path)
    keys = listing["keys"]
    new = changes.select(*[F.col(f"`{c}`").alias(f"_new_{c}") for c in changes.columns], F.lit(True).alias("_hit"))

    def change(old: DataFrame) -> DataFrame:
        match = reduce(lambda a, b: a & b, [old[f"`{k}`"].eqNullSafe(new[f"`_new_{k}`"]) for k in keys])
        joined = old.withColumn("_old", F.lit(True)).join(new, match, "full_outer" if insert else "left")
        set_ = {c: F.when(F.col("_hit"), F.col(f"`_new_{c}`")).otherwise(F.col(f"`{c}`")) for c in changes.columns}
        return joined.select(*[set_.get(c, F.col(f"`{c}`")).alias(c) for c in old.columns])

    return rewrite(spark, path, changes.select(*[f"`{k}`" for k in keys]), change, note)


def replace_keys(spark: SparkSession, path: str, gone: DataFrame, rows: DataFrame) -> list[str]:
    """Delete all rows of the keys in ``gone`` and add ``rows``, whose keys may be new or among them."""
    keys = parts(spark, path)["keys"]
    named = [f"`{k}`" for k in keys]
    touched = gone.select(*named).unionByName(rows.select(*named)).distinct()

    def change(old: DataFrame) -> DataFrame:
        out = gone.select(*named).distinct()
        return old.join(out, same_key(old, out, keys), "left_anti").unionByName(rows)

    return rewrite(spark, path, touched, change)
