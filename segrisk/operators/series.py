"""Ordered series, cut into years so that one long series never sits in one task.

Repeated copies of an observation are counted before the first shuffle, so a
pile of copies is one row from there on. What is left per (series, year) is at
most a handful of values per month. Within a year rows are ordered by month,
then value; the years of a series are linked through one summary row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrisk.functions.values import finite

OBSERVATION = ["series_id", "year", "month", "value"]


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct observations with their number of copies; unknown values and NaN are left out."""
    return (
        df.withColumn("value", finite(F.col("value")))
        .where(F.col("value").isNotNull())
        .groupBy(*OBSERVATION)
        .agg(F.count(F.lit(1)).alias("copies"), F.min("series_label").alias("label"))
    )


def changes(df: DataFrame) -> DataFrame:
    """Difference of each distinct observation to the preceding one, NULL for the first.

    Further ``copies`` of an observation change nothing: their difference is 0.
    """
    data = count_copies(df)
    within = Window.partitionBy("series_id", "year").orderBy("month", "value")
    closing = data.groupBy("series_id", "year").agg(
        F.max_by("value", F.struct("month", "value")).alias("closing")
    )
    earlier = Window.partitionBy("series_id").orderBy("year")
    carried = closing.select("series_id", "year", F.lag("closing").over(earlier).alias("carried"))
    return (
        data.withColumn("preceding", F.lag("value").over(within))
        .join(carried, ["series_id", "year"])
        .withColumn("change", F.col("value") - F.coalesce("preceding", "carried"))
        .drop("preceding", "carried")
    )


def yearly_summary(df: DataFrame) -> DataFrame:
    """One row per (series, year): counts, sum, ends, peak and moments of the changes.

    The window and the aggregation share one shuffle on (series, year).
    """
    within = Window.partitionBy("series_id", "year").orderBy("month", "value")
    in_time = F.struct("month", "value")
    return (
        count_copies(df)
        .withColumn("change", F.col("value") - F.lag("value").over(within))
        .groupBy("series_id", "year")
        .agg(
            F.min_by("label", in_time).alias("label"),
            F.sum("copies").alias("n"),
            F.sum(F.col("value") * F.col("copies")).alias("value_sum"),
            F.min_by("value", in_time).alias("opening"),
            F.max_by("value", in_time).alias("closing"),
            F.max("value").alias("peak"),
            F.sum(F.col("copies") - 1).alias("still"),
            F.count("change").alias("moves"),
            F.avg("change").alias("move_mean"),
            F.var_pop("change").alias("move_variance"),
        )
    )


def series_metrics(yearly: DataFrame) -> DataFrame:
    """Latest, peak, mean and population deviation of the changes per series.

    Input has one row per year, so the windows stay small. The changes of a
    series are its moves within the years, the steps between years and the
    zeros of repeated copies. Their variance is put together from each part's
    own variance and its distance to the mean, which loses no digits.
    """
    c = F.col
    link = Window.partitionBy("series_id").orderBy("year")
    whole = Window.partitionBy("series_id")
    linked = yearly.withColumn("step", c("opening") - F.lag("closing").over(link)).withColumns(
        {
            "move_mean": F.coalesce("move_mean", F.lit(0.0)),
            "move_variance": F.coalesce("move_variance", F.lit(0.0)),
            "steps": F.when(c("step").isNull(), 0).otherwise(1),
        }
    )
    change_sum = c("moves") * c("move_mean") + F.coalesce("step", F.lit(0.0))
    changes_ = c("moves") + c("steps") + c("still")
    centred = linked.withColumn(
        "mean_change", F.try_divide(F.sum(change_sum).over(whole), F.sum(changes_).over(whole))
    )

    def squared(x):
        return x * x

    mean = c("mean_change")
    spread = (
        c("moves") * (c("move_variance") + squared(c("move_mean") - mean))
        + c("still") * squared(mean)
        + F.coalesce(squared(c("step") - mean), F.lit(0.0))
    )
    return centred.groupBy("series_id").agg(
        F.min_by("label", "year").alias("series_label"),
        F.sum("n").alias("observations"),
        F.sum("value_sum").alias("value_sum"),
        F.max_by("closing", "year").alias("latest_employment"),
        F.max("peak").alias("peak_employment"),
        F.first("mean_change").alias("mean_change"),
        F.sqrt(F.try_divide(F.sum(spread), F.sum(changes_))).alias("volatility"),
    )


def mean_and_peak(df: DataFrame) -> DataFrame:
    """Average, and the earliest month that reaches the maximum; one aggregation."""
    peak = F.min(F.struct((-F.col("value")).alias("negated"), "year", "month", "period_name"))
    return (
        df.withColumn("value", finite(F.col("value")))
        .where(F.col("value").isNotNull())
        .groupBy("series_id")
        .agg(F.avg("value").alias("mean_value"), peak.alias("peak"))
        .select(
            "series_id",
            "mean_value",
            F.col("peak.year").alias("peak_year"),
            F.col("peak.period_name").alias("peak_period"),
            (-F.col("peak.negated")).alias("peak_value"),
        )
    )
