"""Tables that are replaced without a gap.

Each write goes to a folder of its own, and one small pointer file names the
current one. The pointer is swapped by an atomic rename after the write has
ended, so a reader, who resolves the pointer once, sees one whole table: the one
before or the one after. A write that fails leaves the table as it was. On a store
without atomic rename the swap is as atomic as that store's rename of one file.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import SparkSession

POINTER = "CURRENT"
#: Versions that stay readable, the current one included, and the age after which a folder no pointer names is deleted.
KEPT = 2
ABANDONED_HOURS = 24


class ConcurrentUpdate(RuntimeError):
    """Another write has replaced the version that this one started from."""


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Hadoop's file system of a path, and the path as an object of it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, None if there is none."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place, then rename it over the old one."""
    beside = f"{path}.{uuid.uuid4().hex}"
    system, source = file_system(spark, beside)
    stream = system.create(source, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    how = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(how, 1)
    options[0] = how.OVERWRITE
    target = fs.Path(path)
    fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)


def delete(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def pointer(spark: SparkSession, path: str) -> dict:
    """What the pointer of a table says: ``current``, and ``kept`` with the folders of versions still readable."""
    text = read_small(spark, f"{path}/{POINTER}")
    return json.loads(text) if text else {"current": None, "kept": []}


def current(spark: SparkSession, path: str) -> str:
    """Folder that holds the table now; a folder without a pointer is the table itself."""
    name = pointer(spark, path)["current"]
    return f"{path}/{name}" if name else path


def publish(
    spark: SparkSession, path: str, write: Callable[[str], None], expected: str | None = None,
    needs: Callable[[str], Iterable[str]] | None = None,
) -> str:
    """Let ``write`` fill a new folder, then make it the table. Returns the folder's name.

    ``expected`` is the version the write started from; if another one has taken
    its place, the new folder is deleted and ConcurrentUpdate raised. ``needs``
    names the folders of earlier versions that a version reads from.
    """
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        write(f"{path}/{name}")
        state = pointer(spark, path)
        if expected is not None and state["current"] != expected:
            raise ConcurrentUpdate(f"{path}: {state['current']} has replaced {expected}")
    except BaseException:
        delete(spark, f"{path}/{name}")
        raise
    kept = [name, *[v for v in state["kept"] if v != name]][:KEPT]
    write_small(spark, f"{path}/{POINTER}", json.dumps({"current": name, "kept": kept}))
    needed = set(kept) | {f for v in kept for f in (needs(v) if needs else ())}
    _prune(spark, path, needed, set(state["kept"]) | {f for v in state["kept"] for f in (needs(v) if needs else ())})
    return name


def _prune(spark: SparkSession, path: str, needed: set[str], earlier: set[str]) -> None:
    """Delete versions that have gone out of use, and old folders of writes that never ended."""
    system, place = file_system(spark, path)
    oldest = (time.time() - ABANDONED_HOURS * 3600) * 1000
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in needed and (name in earlier or status.getModificationTime() < oldest):
            system.delete(status.getPath(), True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """A plain folder, for readers who know of no pointer: written whole beside its place, then renamed to it.

    A write that fails leaves the old folder as it was. Between two renames there is a moment without the folder.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex
    fresh, old = f"{parent}/_new-{mark}-{name}", f"{parent}/_old-{mark}-{name}"
    try:
        write(fresh)
    except BaseException:
        delete(spark, fresh)
        raise
    system, place = file_system(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    if system.exists(place):
        system.rename(place, path_of(old))
    system.rename(path_of(fresh), place)
    system.delete(path_of(old), True)


def name_files(spark: SparkSession, path: str, extension: str) -> None:
    """Give the one file in each folder ``key=value`` below ``path`` the name of the value, in ``path`` itself.

    For hand-over folders of a bounded number of documents: one rename a file, by the driver.
    """
    system, place = file_system(spark, path)
    for folder in system.listStatus(place):
        _, key, value = folder.getPath().getName().partition("=")
        if key:
            (part,) = [s.getPath() for s in system.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")]
            system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{value}{extension}"))
            system.delete(folder.getPath(), True)
