"""Tables that are replaced, changed by key and scored anew, and what their files show."""

import threading

import pytest
from pyspark.sql import functions as F

from segrisk.plans import concentration, rescoring, scoring
from segrisk.sources import keyed_store, sinks, tables, versions
from segrisk.workload import facts

KIND = "a string, b string, x int, y string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(folder):
    return {p.relative_to(folder).as_posix(): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


# --- versions ---------------------------------------------------------------------


def test_readers_see_whole_tables_while_a_write_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    old, new = spark.range(100).selectExpr("id", "'old' AS v"), spark.range(200).selectExpr("id", "'new' AS v")
    versions.publish(spark, path, old.write.parquet)
    seen = []

    def look():
        got = spark.read.parquet(versions.current(spark, path))
        return got.count(), {r["v"] for r in got.select("v").distinct().collect()}

    def half(folder):
        # Some tasks end and write their files, the job fails: what the folder holds must not be seen.
        new.limit(50).write.parquet(folder)
        seen.append(look())
        broken = new.withColumn("id", F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
        broken.write.mode("append").parquet(folder)

    with pytest.raises(Exception, match="lost"):
        versions.publish(spark, path, half)
    seen.append(look())
    assert seen == [(100, {"old"})] * 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 1, "the half-written folder is gone"
    versions.publish(spark, path, new.write.parquet)
    assert look() == (200, {"new"})


def test_a_frame_keeps_its_version_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    sizes = [3, 5, 7]
    versions.publish(spark, path, spark.range(sizes[0]).write.parquet)
    first = spark.read.parquet(versions.current(spark, path))
    versions.publish(spark, path, spark.range(sizes[1]).write.parquet)
    assert first.count() == 3, "the version before stays readable"
    versions.publish(spark, path, spark.range(sizes[2]).write.parquet)
    folders = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]
    assert len(folders) == versions.KEPT and spark.read.parquet(versions.current(spark, path)).count() == 7


def test_readers_during_many_replacements(spark, tmp_path):
    path = str(tmp_path / "t")
    write = lambda n: versions.publish(spark, path, spark.range(10).withColumn("n", F.lit(n)).repartition(4).write.parquet)
    write(0)
    done, seen = threading.Event(), []

    def reader():
        while not done.is_set():
            try:
                seen.append(tuple(spark.read.parquet(versions.current(spark, path)).agg(F.count("n"), F.min("n"), F.max("n")).first()))
            except Exception as e:  # a reader slower than two replacements loses its files; it never sees half a table
                assert "FILE_NOT_EXIST" in str(e) or "does not exist" in str(e) or "PATH_NOT_FOUND" in str(e)

    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(1, 6):
        write(n)
    done.set()
    thread.join()
    assert seen and all(n == 10 and low == high for n, low, high in seen)


def test_failed_replacement_of_a_plain_folder_leaves_it(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_raw(spark.createDataFrame([("one",)], "body string"), path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("body"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_raw(broken, path)
    assert [r["body"] for r in spark.read.json(path).collect()] == ["one"]
    assert [p.name for p in tmp_path.iterdir()] == ["raw"]


def test_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    start = versions.publish(spark, path, spark.range(1).write.parquet)
    versions.publish(spark, path, spark.range(2).write.parquet, expected=start)
    with pytest.raises(versions.ConcurrentUpdate):
        versions.publish(spark, path, spark.range(3).write.parquet, expected=start)
    assert spark.read.parquet(versions.current(spark, path)).count() == 2


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    path = str(tmp_path / "segments")
    spark.createDataFrame([("STATE", "TX")], "row_type string, state string").write.parquet(path)
    assert [r["state"] for r in tables.read_segments(spark, path).collect()] == ["TX"]


# --- keyed tables ---------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    path = tmp_path / "store"
    given = [(f"k{i}", None if i % 7 == 0 else f"m{i % 3}", i, "old") for i in range(200)] + [(None, None, -1, "old")]
    keyed_store.create(spark.createDataFrame(given, KIND), str(path), ["a", "b"], 16)
    return path, given


def test_update_rewrites_only_touched_buckets(spark, store):
    path, given = store
    before = files(path)
    changes = spark.createDataFrame([("k3", "m0", "new"), (None, None, "new"), ("k7", None, "new")], "a string, b string, y string")
    touched = keyed_store.update(spark, str(path), changes)
    wanted = [(a, b, x, "new" if x in (3, 7, -1) else y) for a, b, x, y in given]
    assert rows(keyed_store.read(spark, str(path))) == sorted(wanted, key=str)
    after = files(path)
    assert 1 <= len(touched) <= 3 and before.items() <= after.items(), "no old file is changed"
    new = {name.split("/")[1] for name in set(after) - set(before)}
    assert new == {f"{keyed_store.BUCKET}={b}" for b in touched}
    held = keyed_store.parts(spark, str(path))["held"]
    assert sum(v != max(held.values()) for v in held.values()) == len(held) - len(touched)


def test_insert_delete_and_empty_changes(spark, store):
    path, given = store
    at = str(path)
    assert keyed_store.update(spark, at, spark.createDataFrame([], "a string, b string, x int")) == []
    keyed_store.update(spark, at, spark.createDataFrame([("fresh", None, 5)], "a string, b string, x int"))
    keyed_store.update(spark, at, spark.createDataFrame([("absent", None, 5)], "a string, b string, x int"), insert=False)
    gone = spark.createDataFrame([("k1", "m1"), ("k14", None), ("nobody", "x")], "a string, b string")
    added = spark.createDataFrame([("k1", "m1", 1, "one"), ("k1", "m1", 2, "two")], KIND)
    keyed_store.replace_keys(spark, at, gone, added)
    wanted = [r for r in given if r[0] not in ("k1", "k14")] + [("fresh", None, 5, None), ("k1", "m1", 1, "one"), ("k1", "m1", 2, "two")]
    assert rows(keyed_store.read(spark, at)) == sorted(wanted, key=str)
    assert rows(keyed_store.lookup(spark, at, gone)) == [("k1", "m1", 1, "one"), ("k1", "m1", 2, "two")]


def test_many_updates_keep_what_they_read(spark, store):
    """Folders that a kept version still reads from are not deleted."""
    path, given = store
    state = {(a, b): (x, y) for a, b, x, y in given}
    for n in range(5):
        key = (f"k{n * 7}", None)
        keyed_store.update(spark, str(path), spark.createDataFrame([(*key, f"v{n}")], "a string, b string, y string"))
        state[key] = (state[key][0], f"v{n}")
        assert rows(keyed_store.read(spark, str(path))) == sorted(((*k, *v) for k, v in state.items()), key=str)


def test_lookup_reads_only_its_buckets(spark, store):
    path, _ = store
    found = keyed_store.lookup(spark, str(path), spark.createDataFrame([("k3", "m0")], "a string, b string"))
    assert rows(found) == [("k3", "m0", 3, "old")] and len({f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1


def test_failed_rewrite_leaves_the_table(spark, store):
    path, given = store
    key = spark.createDataFrame([("k3", "m0")], "a string, b string")
    with pytest.raises(Exception, match="lost"):
        keyed_store.rewrite(spark, str(path), key, lambda old: old.withColumn("x", F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(ValueError, match="other buckets"):
        keyed_store.rewrite(spark, str(path), key, lambda old: old.withColumn("a", F.concat("a", F.lit("'"))))
    assert rows(keyed_store.read(spark, str(path))) == sorted(given, key=str)


# --- rescoring -------------------------------------------------------------------------


def test_rescored_dimension_equals_the_full_run(spark, sf_dir, tmp_path):
    parts, trade, yearly = facts.stored_reduced(spark, sf_dir)
    path = tmp_path / "segments"
    last = yearly.agg(F.max("year")).first()[0]
    rescoring.keep_segments(scoring.score_stepwise(parts, trade, yearly.where(F.col("year") < last)), str(path))
    before = files(path)
    touched = rescoring.rescore_workforce(spark, str(path), yearly)
    assert 0 < len(touched) <= 3 and before.items() <= files(path).items()
    assert all(any(f"{keyed_store.BUCKET}={b}/" in f for b in touched) for f in set(files(path)) - set(before))
    full = scoring.canonical(scoring.score_stepwise(parts, trade, yearly))
    kept = scoring.canonical(keyed_store.read(spark, str(path)))
    assert rows(kept) == rows(full)
    assert rescoring.rescore_workforce(spark, str(path), yearly) == [], "nothing has changed since"
    assert rescoring.rescore_geographic(spark, str(path), trade) == []


def test_new_state_and_lost_sector(spark, sf_dir, tmp_path):
    parts, trade, yearly = facts.stored_reduced(spark, sf_dir)
    path = str(tmp_path / "segments")
    rescoring.keep_segments(scoring.score_stepwise(parts.where("state <> 'WI'"), trade, yearly), path)
    rescoring.rescore_concentration(spark, path, concentration.state_profile(parts))
    assert rows(scoring.canonical(keyed_store.read(spark, path))) == rows(scoring.canonical(scoring.score_stepwise(parts, trade, yearly)))
    rescoring.rescore_workforce(spark, path, yearly.limit(0))
    left = keyed_store.read(spark, path).where("row_type = 'NAICS'").collect()
    assert left and all(r["workforce_risk_score"] is None and r["composite_risk_score"] == r["geo_risk_score"] for r in left)


# --- briefs ----------------------------------------------------------------------------


def bytes_read(spark):
    """Bytes that the file systems of this machine's one JVM have read so far."""
    total = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().iterator()
    n = 0
    while total.hasNext():
        value = total.next().getLong("bytesRead")
        n += value or 0
    return n


def test_lookup_reads_few_bytes(spark, tmp_path):
    """1,000 identifiers among a million: under a twentieth of the store is read."""
    path, n = str(tmp_path / "store"), 1_000_000
    text = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(k)), 256) for k in "abcd"])
    sinks.write_briefs(spark.range(n).select(F.format_string("S%09d", "id").alias("identifier"), text.alias("brief_text")), path)
    size = sum(p.stat().st_size for p in (tmp_path / "store").rglob("*.parquet"))
    wanted = spark.range(1000).select(F.format_string("S%09d", (F.col("id") * 7919 + 13) % (n + 5000)).alias("identifier"))
    before = bytes_read(spark)
    found = tables.find_briefs(spark, path, wanted).collect()
    read = bytes_read(spark) - before
    there = {r["identifier"] for r in wanted.collect() if int(r["identifier"][1:]) < n}
    assert {r["identifier"] for r in found} == there and len(found) == len(there) > 900
    assert read < 0.05 * size, (read, size)


def test_briefs_keep_their_time_and_many_are_joined(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    build = lambda **texts: spark.createDataFrame(list(texts.items()), "identifier string, brief_text string")
    sinks.write_briefs(build(a="1", b="2", c="3"), path, 1)
    first = {r["identifier"]: r["modified_at"] for r in tables.read_brief_store(spark, path).collect()}
    sinks.write_briefs(build(b="new", d="4"), path)
    after = {r["identifier"]: r for r in tables.read_brief_store(spark, path).collect()}
    assert {k: r["brief_text"] for k, r in after.items()} == {"a": "1", "b": "new", "c": "3", "d": "4"}
    assert [after[k]["modified_at"] == first[k] for k in "abc"] == [True, False, True], "peers keep their time"
    monkeypatch.setattr(keyed_store, "MOST_FOUND", 1)
    wanted = spark.createDataFrame([("a",), ("d",), ("x",)], "identifier string")
    assert sorted(r["identifier"] for r in tables.find_briefs(spark, path, wanted).collect()) == ["a", "d"]
    assert keyed_store.find(spark, path, []).count() == 0
