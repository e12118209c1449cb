"""Summaries of the three sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.values import cents, dollars, round_even, wide
from segrisk.operators.ranking import descending, top_k
from segrisk.operators.series import mean_and_peak
from segrisk.plans.workforce import with_month


def grand_totals(df: DataFrame, amount: str) -> DataFrame:
    """Row count and total, the total also in billions with two digits."""
    total = F.coalesce(F.sum(wide(cents(F.col(amount)))), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("row_count"), dollars(total).alias("total_value")).withColumn(
        "total_bn", round_even(F.col("total_value") / 1e9)
    )


def top_by_total(df: DataFrame, keys: Sequence[str], amount: str, k: int) -> DataFrame:
    """Largest groups by total, numbered; a NULL key is a group like any other."""
    total = F.coalesce(F.sum(cents(F.col(amount))), F.lit(0))
    return rank_totals(df.groupBy(*keys).agg(dollars(total).alias("total_value")), keys, k)


def rank_totals(totals: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    ranked = top_k(totals, k, descending("total_value", *keys), rank="rank")
    return ranked.withColumn("total_bn", round_even(F.col("total_value") / 1e9))


def award_summary(awards: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    return grand_totals(awards, "award_amount"), top_by_total(awards, ["recipient_name"], "award_amount", k)


def trade_summary(trade: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    values = trade.withColumn("export_value", F.col("export_value").cast("double"))
    return (
        grand_totals(values, "export_value"),
        top_by_total(values, ["country_code", "country_name"], "export_value", k),
    )


def employment_summary(employment: DataFrame) -> DataFrame:
    return mean_and_peak(with_month(employment))
