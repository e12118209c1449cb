"""Aggregations. All of them combine map-side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.functions.scores import geo_risk, hhi_from_sums
from segrisk.functions.values import cents, round_even, wide


#: Totals that fit in one small map, and parts of a group where there are more.
FEW_GROUPS = 256
SALTS = 16


def sum_and_count(df: DataFrame, keys: Sequence[str], amount: str, total: str, count: str) -> DataFrame:
    """Cents and number of known amounts per key; NULL keys form a group, no amounts sum to 0."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(cents(F.col(amount))), F.lit(0)).alias(total),
        F.count(amount).alias(count),
    )


def group_profile(
    totals: DataFrame, group: str, entity: str, total: str, count: str | None = None
) -> DataFrame:
    """Value, entities and Herfindahl-Hirschman index per group.

    Expects one row per (group, entity) with a whole-number total. The index
    uses sum(x^2) / sum(x)^2, so a group holding a third of all entities is
    still combined map-side; no group is ever gathered in one task. Nameless
    entities count towards the value but not the index, which is NULL for a
    group without any name.
    """
    x = F.col(total).cast("double")
    named = F.col(entity).isNotNull()
    aggregates = [
        F.coalesce(F.sum(wide(F.col(total))), F.lit(0)).cast("double").alias("group_value"),
        F.count(entity).alias("entities"),
        F.sum(F.when(named, F.coalesce(x * x, F.lit(0.0)))).alias("squares"),
        F.sum(F.when(named, wide(F.coalesce(total, F.lit(0))))).cast("double").alias("named_total"),
    ]
    if count is not None:
        aggregates.append(F.sum(count).alias("row_count"))
    index = hhi_from_sums(F.col("squares"), F.col("named_total")).alias("hhi_score")
    return (
        totals.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(*aggregates)
        .select("*", index)
        .drop("squares", "named_total")
    )


def share_of_total(df: DataFrame, group: str, value: str, share: str = "share") -> DataFrame:
    """Each row's part of its group's total.

    A window over the group would pull a hot group into one task; instead the
    totals are combined map-side and brought back. Up to ``FEW_GROUPS`` totals,
    a number that is measured, reach the rows as one map, so that the rows are
    not shuffled; more are joined with every group cut into ``SALTS`` parts.
    Rows without a group have no total and go.
    """
    total = F.sum(wide(F.col(value))).cast("double")
    totals = df.where(F.col(group).isNotNull()).groupBy(group).agg(total.alias("group_total"))
    if totals.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        entries = F.collect_list(F.struct(group, "group_total"))
        found = totals.agg(F.map_from_entries(entries)).scalar()
        with_total = df.where(F.col(group).isNotNull()).withColumn("group_total", F.try_element_at(found, F.col(group)))
    else:
        salted = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
        with_total = rows.join(salted, [group, "_salt"]).select(*df.columns, "group_total")
    return with_total.withColumn(share, F.try_divide(F.col(value).cast("double"), F.col("group_total")))


def destination_profile(totals: DataFrame, product: str, destination: str, value: str) -> DataFrame:
    """Dependence of each product on its largest destination, one aggregation.

    Expects one row per (product, destination) with a whole-number value. Ties
    for the largest go to the first name. Exports without a destination count
    towards the total only; a product without any value that has one has no
    share and no score.
    """
    v = F.col(value).cast("double")
    named = F.col(destination).isNotNull()
    largest = F.min(F.when(named, F.struct((-v).alias("negated"), F.col(destination).alias("name"))))
    profile = (
        totals.where(F.col(product).isNotNull())
        .groupBy(product)
        .agg(
            F.sum(wide(F.col(value))).cast("double").alias("total_value"),
            F.sum(F.when(named, wide(F.col(value)))).cast("double").alias("named_value"),
            largest.alias("largest"),
            F.count(destination).alias("country_count"),
        )
    )
    share = F.try_divide(-F.col("largest.negated"), F.col("named_value")) * 100.0
    return profile.select(
        product,
        "total_value",
        F.col("largest.name").alias("top_country"),
        round_even(share).alias("top_country_share"),
        "country_count",
        geo_risk(share, F.col("country_count")).alias("geo_risk_score"),
    )


def worst_member(member: str, severity: str, carry: Sequence[str]) -> Column:
    """Aggregate: the columns of the most severe member, the lowest one among equals."""
    known = F.col(severity).isNotNull()
    candidate = F.struct((-F.col(severity)).alias("negated"), F.col(member), *carry)
    return F.min(F.when(known, candidate))


def category_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins included.

    The largest value belongs to the last bin. The two bounds reach the second
    scan as a scalar subquery: nothing is collected by the driver program.
    """
    x = F.col(value)
    data = df.where(x.isNotNull()).select(x.cast("double").alias("x"))
    low, high = F.min("x"), F.max("x")
    bounds = data.agg(
        F.struct(
            F.when(low < high, low).otherwise(low - 0.5).alias("low"),
            F.when(low < high, high).otherwise(high + 0.5).alias("high"),
        ).alias("bounds")
    ).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    number = F.least(F.floor((F.col("x") - low) * bins / (high - low)) + 1, F.lit(bins))
    counts = data.groupBy(number.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    width = (high - low) / bins
    return edges.join(counts, "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("bin_low"),
        (low + F.col("bin") * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("row_count"),
    )
