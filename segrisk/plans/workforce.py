"""Workforce stress per employment series and industry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.scores import (
    peak_score,
    percent_drop,
    trend_penalty,
    volatility_score,
    workforce_risk,
)
from segrisk.functions.values import month_of_period, round_even, round_exact
from segrisk.operators.keyed import require_keys, upsert
from segrisk.operators.series import series_metrics, yearly_summary
from segrisk.operators.shape import map_codes


def with_month(employment: DataFrame) -> DataFrame:
    return employment.withColumn("month", month_of_period(F.col("period")))


def employment_by_year(employment: DataFrame) -> DataFrame:
    """The one pass over the employment table; see ``yearly_summary``."""
    return yearly_summary(with_month(employment))


def stress_scores(yearly: DataFrame) -> DataFrame:
    """Metrics, component scores and the final score per series.

    A series with a single observation has no changes and no score.
    """
    c = F.col
    return (
        series_metrics(yearly)
        .withColumn("peak_to_current_ratio", percent_drop(c("peak_employment"), c("latest_employment")))
        .withColumns(
            {
                "peak_score": peak_score(c("peak_to_current_ratio")),
                "volatility_score": volatility_score(c("volatility")),
                "trend_penalty": trend_penalty(c("mean_change")),
            }
        )
        .select(
            "series_id",
            "series_label",
            "observations",
            "value_sum",
            "latest_employment",
            "peak_employment",
            "peak_to_current_ratio",
            "volatility",
            round_exact(c("peak_score")).alias("peak_score"),
            round_exact(c("volatility_score")).alias("volatility_score"),
            "trend_penalty",
            workforce_risk(c("peak_score"), c("volatility_score"), c("trend_penalty")).alias(
                "workforce_risk_score"
            ),
        )
    )


def industry_profile(scores: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Mean employment in whole workers (given in thousands) and stress per industry.

    Of several series for one industry, the last one's score counts.
    """
    mapped = map_codes(scores, crosswalk, "series_id", "naics_code", keep_unmapped=False)
    mean = F.sum("value_sum") / F.sum("observations")
    return mapped.groupBy("naics_code").agg(
        round_even(mean * 1000.0, 0).cast("long").alias("employment_count"),
        F.max_by("workforce_risk_score", "series_id").alias("workforce_risk_score"),
    )


def industry_stress(scores: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return industry_profile(scores, crosswalk).select("naics_code", "workforce_risk_score")


def require_series(employment: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Error if a series that an industry relies on has no rows."""
    return require_keys(employment, crosswalk.select("series_id"), "series_id")


def apply_workforce(segments: DataFrame, stress: DataFrame) -> DataFrame:
    nothing = {"workforce_risk_score": F.lit(None).cast("double")}
    return upsert(
        segments,
        stress.select("naics_code", "workforce_risk_score"),
        key="naics_code",
        applies=F.col("state").isNull(),
        defaults=nothing,
        elsewhere=nothing,
    )
