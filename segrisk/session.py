"""Session helpers: a local builder for tests and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "segrisk", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A private temporary folder is used only where the setting is absent and the
    master is local, since on a cluster such a folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="segrisk-")
    spark.conf.set("spark.checkpoint.dir", folder)
    delete_at_end(spark, folder)
    return folder


def delete_at_end(spark: SparkSession, path: str) -> None:
    """The session owns this path: its file system deletes it when the driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses, deleted when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return path


#: Writer options for rows of a megabyte: pages and row groups are held whole, and by default both have 100 rows at least.
LONG_ROWS = {"parquet.page.row.count.limit": "4", "parquet.block.size.row.check.min": "4", "parquet.block.size": str(16 << 20)}


def stored(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """The table written to the shared folder and read back.

    For a result with several consumers: it is computed once, and a lost
    executor costs a re-read, not a recomputation. ``options`` are the writer's.
    It stays until the session ends, or lies in a ``folder`` that its owner deletes.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run inside deletes its shuffle files when it ends, not when the driver collects garbage.

    For jobs of many writes, whose shuffles would add up on disk.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


_once: dict[tuple[str, str, str], DataFrame] = {}


def stored_once(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stored table that many queries read: made once per session and data folder."""
    key = (spark.sparkContext.applicationId, name, source)
    if key not in _once:
        _once[key] = stored(build(), name)
    return _once[key]
