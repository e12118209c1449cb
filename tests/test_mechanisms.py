"""Selection, periods, sketches and layouts against brute force."""

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from segrisk.operators import intervals, layout, selection, sketches


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- selection --------------------------------------------------------------------


def quantile(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@pytest.mark.parametrize("share", [0.5, 0.0, 1.0, 0.3])
def test_quantiles_of_odd_groups(spark, share):
    rng = random.Random(4)
    groups = {
        "one": [3.5], "two": [1.0, 2.0], "same": [7.25] * 50, "wide": [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(401)],
        "close": [1 + i * 2**-52 for i in range(200)], "signs": [-5e-324, 0.0, -0.0, 5e-324, 1.7e308, -1.7e308],
        None: [float(i) for i in range(10)], "money": [rng.randint(0, 10**7) / 100 for _ in range(3000)],
    }
    given = [(g, v) for g, vs in groups.items() for v in vs] + [("two", None), ("two", math.nan), ("two", math.inf), ("void", None)]
    rng.shuffle(given)
    found = selection.quantiles(spark.createDataFrame(given, "g string, v double").repartition(5), "g", "v", share).collect()
    got = {r["g"]: (r["n"], r["quantile"]) for r in found}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g] == (len(vs), pytest.approx(quantile(vs, share), rel=1e-15, abs=0)), g


def test_median_rounds_shrink_and_keep_no_values(spark, monkeypatch):
    """With steps of 4 the rounds are many; each is written, and no plan collects values."""
    monkeypatch.setattr(selection, "BINS", 4)
    names = []
    stored = selection.stored
    monkeypatch.setattr(selection, "stored", lambda df, name: names.append((name, df)) or stored(df, name))
    values = [float(i * i % 977) for i in range(500)]
    found = selection.quantiles(spark.createDataFrame([("a", v) for v in values], "g string, v double"), "g", "v")
    assert [r["quantile"] for r in found.collect()] == [statistics.median(values)]
    left = [df.count() for name, df in names if name == "remaining"]
    assert len(left) > 2 and left == sorted(left, reverse=True)
    assert not any("collect_" in df._jdf.queryExecution().toString() for _, df in names)


def test_quantiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert selection.quantiles(empty, "g", "v").count() == 0
    with pytest.raises(ValueError, match="between 0 and 1"):
        selection.quantiles(empty, "g", "v", 1.5)


# --- periods -----------------------------------------------------------------------


def day(n):
    return datetime.date(1969, 12, 1) + datetime.timedelta(days=n)


@pytest.mark.parametrize("width", [1, 7, 32, 1000])
def test_pairs_equal_brute_force(spark, width):
    rng = random.Random(width)
    given = [(i, day(rng.randrange(200)) if i % 9 else None) for i in range(120)] + [(500 + i, day(50)) for i in range(40)]
    periods = [(f"p{k}", day(a := rng.randrange(200)), day(a + rng.choice([0, 1, 30, 150]))) for k in range(60)]
    periods += [("back", day(9), day(3)), ("open", day(5), None), ("all", day(-5000), day(5000))]
    r, p = spark.createDataFrame(given, "id int, day date"), spark.createDataFrame(periods, "scope string, a date, b date")
    wanted = sorted((i, s) for i, d in given for s, a, b in periods if d and b and a <= d <= b)
    pairs = intervals.within_periods(r, "day", p, "a", "b", width)
    assert rows(pairs.select("id", "scope")) == sorted(wanted, key=str)
    sums = rows(intervals.sums_by_period(r, "day", p, "scope", "a", "b", {"n": F.lit(1), "ids": F.col("id")}, width).select("scope", "n", "ids"))
    by = {s: [i for i, t in wanted if t == s] for s, _, _ in periods}
    assert sums == sorted(((s, len(v) or None, sum(v) if v else None) for s, v in by.items()), key=str)


def test_many_overlapping_periods_without_a_nested_loop(spark):
    dates = F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.col("id") * 7919, F.lit(3000)).cast("int"))
    r = spark.range(50_000).select("id", dates.alias("day"))
    periods = spark.range(10_000).select(
        F.col("id").alias("scope"), dates.alias("a"), F.date_add(dates, F.pmod(F.col("id"), F.lit(200)).cast("int")).alias("b")
    )
    found = intervals.sums_by_period(r, "day", periods, "scope", "a", "b", {"n": F.lit(1)})
    for df in (found, intervals.within_periods(r, "day", periods, "a", "b")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    per_day = [0] * 3300
    for i in range(50_000):
        per_day[i * 7919 % 3000] += 1
    so_far = [0]
    for n in per_day:
        so_far.append(so_far[-1] + n)
    got = {x["scope"]: x["n"] or 0 for x in found.collect()}
    assert len(got) == 10_000
    assert all(got[k] == so_far[(a := k * 7919 % 3000) + k % 200 + 1] - so_far[a] for k in range(10_000))


# --- sketches ----------------------------------------------------------------------


def test_sketches_merge_and_tell_what_is_exact(spark, tmp_path):
    value = F.pmod(F.xxhash64("id"), F.lit(60_000))
    df = spark.range(400_000).select(F.pmod("id", F.lit(3)).alias("a"), F.pmod("id", F.lit(30)).alias("b"), value.alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 9, None), (9, 9, 5), (9, 9, 5)], "a long, b long, v long"))
    path = str(tmp_path / "kept")
    sketches.sketch(df, ["a", "b"], "v").write.parquet(path)
    kept = spark.read.parquet(path)
    for keys in (["a", "b"], ["a"], []):
        exact = {tuple(r[k] for k in keys): r["n"] for r in df.groupBy(*keys).agg(F.count_distinct("v").alias("n")).collect()}
        got = sketches.estimate(sketches.merge(kept, keys), "n").collect()
        assert len(got) == len(exact)
        for r in got:
            n = exact[tuple(r[k] for k in keys)]
            if r["is_exact"]:
                assert r["n"] == n
            assert abs(r["n"] - n) <= 4 * n / math.sqrt(sketches.ENTRIES)
    small = {r["b"]: r for r in sketches.estimate(sketches.merge(kept, ["b"]), "n").collect()}
    assert small[9]["n"] > 1000
    plan = sketches.merge(kept, ["a"])._jdf.queryExecution().toString()
    assert path in plan and "Range" not in plan, "merged from stored sketches alone"


def test_small_groups_are_exact(spark):
    df = spark.range(4000).select(F.pmod("id", F.lit(2)).alias("g"), (F.col("id") % 2000).alias("v"))
    got = rows(sketches.estimate(sketches.sketch(df, ["g"], "v"), "n"))
    assert got == [(0, 1000.0, True), (1, 1000.0, True)]


# --- layout ------------------------------------------------------------------------


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(0b101, 0b011), (0, 0b111), (0b111, 0)], "a long, b long")
    got = [r[0] for r in df.select(layout.interleaved([F.col("a"), F.col("b")], 3)).collect()]
    assert got == [0b100111, 0b010101, 0b101010]


def row_groups_with(path, column, wanted):
    """Row groups, and those whose statistics allow a value."""
    import pyarrow.parquet as pq

    total = hit = 0
    for file in path.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = next(s for k in range(meta.num_columns) if (s := meta.row_group(g).column(k)).path_in_schema == column).statistics
            total += 1
            hit += stats.has_min_max and stats.min <= wanted <= stats.max
    return total, hit


def test_predicates_on_any_column_skip_row_groups(spark, tmp_path):
    code = F.format_string("%06d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)))
    state = F.format_string("S%02d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(54)))
    kind = F.when(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10)) < 7, "STATE").otherwise("NAICS")
    df = spark.range(200_000).select("id", kind.alias("row_type"), F.when(F.col("id") % 50 > 0, state).alias("state"), code.alias("code"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df.repartition(64).write.parquet(str(tmp_path / "plain"))
        layout.along_curve(df, ["row_type", "state", "code"]).write.parquet(str(tmp_path / "curve"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = spark.read.parquet(str(tmp_path / "curve"))
    assert kept.count() == 200_000 and kept.exceptAll(df).count() == 0
    for column, wanted in {"row_type": "NAICS", "state": "S17", "code": "000500"}.items():
        total, before = row_groups_with(tmp_path / "plain", column, wanted)
        parts, after = row_groups_with(tmp_path / "curve", column, wanted)
        assert total >= 60 and parts >= 60
        # Without the curve all groups may hold the value.
        assert before == total and after <= 0.55 * parts, (column, after, parts)
        assert kept.where(F.col(column) == wanted).count() == df.where(F.col(column) == wanted).count()


def test_layout_of_empty_and_constant_tables(spark):
    df = spark.createDataFrame([("x", None)] * 5, "a string, b string")
    assert rows(layout.along_curve(df, ["a", "b"])) == [("x", None)] * 5
    assert layout.along_curve(df.limit(0), ["a", "b"]).count() == 0
