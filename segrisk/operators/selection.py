"""Exact quantiles of groups of any size, without gathering a group's values.

The wanted ranks of a group are narrowed to ranges of values. Each round cuts a
range into ``BINS`` steps, counts the values in each, and goes on with the step
that holds the rank, until all values there are equal. The first round steps
along the logarithm, so a few rounds suffice whatever the spread. A task holds
counts of steps, never values; the rows that are left after a round are written,
so each round reads what the one before could not decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segrisk.functions.values import finite
from segrisk.session import stored

BINS = 1024
#: Logarithms of finite doubles lie within +-746.
LEAST_LOG = 746.0


def _scale(x: Column) -> Column:
    """Increasing in x, and finite: sign times logarithm, from -1,500 to 1,500."""
    size = F.log(F.abs(x)) + LEAST_LOG
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * size)


def _step(x: Column, low: Column, high: Column) -> Column:
    """Step of x between low and high, 0 to BINS - 1. Two different edges are never in one step, so every round parts some values."""
    share = F.try_divide(x - low, high - low)
    return F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")


def quantiles(df: DataFrame, group: str, value: str, share: float = 0.5) -> DataFrame:
    """Rows (group, n, quantile): known values of each group, and their quantile, interpolated between two neighbours.

    Missing, NaN and infinite values do not count; a group without others has no
    row. A missing group is a group. ``share`` is from 0 to 1, a half is the median.
    """
    if not 0 <= share <= 1:
        raise ValueError("a share lies between 0 and 1")
    rows = df.select(F.struct(group).alias("g"), finite(F.col(value).cast("double")).alias("x")).where("x IS NOT NULL")
    rows = stored(rows.withColumn("x", F.col("x") + F.lit(0.0)), "values")  # minus zero is zero
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    place = F.lit(float(share)) * (F.col("n") - 1)
    targets = sizes.select("g", "n", (place - F.floor(place)).alias("part"), F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))).alias("rank"))
    # A wanted rank, counted from the least value of the range that it lies in.
    targets = stored(targets.withColumn("left", F.col("rank")), "targets")
    found = _narrow(rows, targets)
    a, b = F.min_by("x", "rank"), F.max_by("x", "rank")
    value_at = a + (b - a) * F.max("part")
    return found.groupBy("g").agg(F.max("n").alias("n"), value_at.alias("quantile")).select(F.col(f"g.{group}").alias(group), "n", "quantile")


def _narrow(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The value at every target: rows (g, n, part, rank, x)."""
    spark = rows.sparkSession
    done = spark.createDataFrame([], targets.schema).drop("left").withColumn("x", F.lit(None).cast("double"))
    dealt = rows.join(targets.select("g", "rank"), "g").select("g", "rank", "x")
    step = _step(_scale(F.col("x")), F.lit(-1500.0), F.lit(1500.0))
    while True:
        placed = dealt.select("g", "rank", "x", step.alias("step"))
        counts = placed.groupBy("g", "rank", "step").agg(F.count(F.lit(1)).alias("k"), F.min("x").alias("low"), F.max("x").alias("high"))
        below = Window.partitionBy("g", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("below", F.coalesce(F.sum("k").over(below), F.lit(0)))
        hit = counts.join(targets, ["g", "rank"]).where("below <= left AND left < below + k")
        hit = stored(hit.select("g", "n", "part", "rank", (F.col("left") - F.col("below")).alias("left"), "step", "low", "high"), "hit")
        done = done.unionByName(hit.where("low = high").select("g", "n", "part", "rank", F.col("low").alias("x")))
        open_ = hit.where("low < high")
        if open_.isEmpty():
            return done
        targets = open_.select("g", "n", "part", "rank", "left")
        kept = placed.join(open_.select("g", "rank", "step", "low", "high"), ["g", "rank", "step"])
        dealt = stored(kept.select("g", "rank", "x", "low", "high"), "remaining")
        step = _step(F.col("x"), F.col("low"), F.col("high"))
