"""Data sets behind the charts, and the summary record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.values import clip
from segrisk.operators.filters import complete_rows
from segrisk.operators.ranking import descending, top_k
from segrisk.operators.totals import histogram

SCORE_COLUMNS = ["geo_risk_score", "workforce_risk_score", "composite_risk_score"]


def states_of(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("row_type") == "STATE")


def top_states(segments: DataFrame, k: int = 20) -> DataFrame:
    """Worst states for a bar chart, drawn from the bottom up: last row is the worst."""
    scored = complete_rows(states_of(segments), ["composite_risk_score"])
    best = top_k(scored, k, descending("composite_risk_score", "state"), rank="rank")
    return best.select("rank", "state", "composite_risk_score", "risk_tier").orderBy(F.desc("rank"))


def score_distribution(segments: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(states_of(segments), "composite_risk_score", bins)


def sector_heatmap(segments: DataFrame) -> DataFrame:
    """Sector by score matrix."""
    sectors = segments.where(F.col("row_type") == "NAICS")
    return sectors.select("naics_label", *SCORE_COLUMNS).orderBy("naics_label")


def heatmap_cells(segments: DataFrame) -> DataFrame:
    """The same matrix with one row per cell."""
    return sector_heatmap(segments).unpivot("naics_label", SCORE_COLUMNS, "dimension", "score")


def value_against_risk(segments: DataFrame) -> DataFrame:
    """States on a logarithmic value axis, marker size from the award count."""
    known = complete_rows(
        states_of(segments), ["total_contract_value", "composite_risk_score", "recipient_count"]
    )
    return known.where(F.col("total_contract_value") > 0).select(
        "state",
        "total_contract_value",
        "composite_risk_score",
        "risk_tier",
        clip(F.col("recipient_count") * 1.5, 25.0, 800.0).alias("marker_size"),
    )


def annotated_states(segments: DataFrame, k: int = 5) -> DataFrame:
    return top_k(
        value_against_risk(segments), k, descending("total_contract_value", "state"), rank="rank"
    )


def summary(segments: DataFrame) -> DataFrame:
    """One record over the state rows, in one aggregation.

    The exact median keeps the distinct scores in its buffer. There is one
    score per state code, so the buffer is bounded by the code list.
    """
    score, value = F.col("composite_risk_score"), F.col("total_contract_value")
    drawable = (value > 0) & score.isNotNull() & F.col("recipient_count").isNotNull()
    top = F.min(F.when(score.isNotNull(), F.struct((-score).alias("negated"), F.col("state"))))
    largest = F.min(
        F.when(drawable, F.struct((-value).alias("negated"), F.col("state"), score.alias("score")))
    )

    def tier(name: str):
        return F.count_if(F.col("risk_tier") == name)

    return (
        states_of(segments)
        .agg(
            top.alias("top"),
            tier("High").alias("high_count"),
            tier("Medium").alias("medium_count"),
            tier("Low").alias("low_count"),
            tier("Minimal").alias("minimal_count"),
            F.avg(score).alias("mean_score"),
            F.median(score).alias("median_score"),
            largest.alias("largest"),
        )
        .select(
            F.col("top.state").alias("top_state"),
            (-F.col("top.negated")).alias("top_score"),
            "high_count",
            "medium_count",
            "low_count",
            "minimal_count",
            "mean_score",
            "median_score",
            F.col("largest.state").alias("top_contract_state"),
            (-F.col("largest.negated")).alias("top_contract_value"),
            F.col("largest.score").alias("top_contract_score"),
        )
    )
