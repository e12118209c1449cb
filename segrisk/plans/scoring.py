"""The whole run: three fact tables in, scored segments out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.dims import hs_crosswalk, naics_labels, series_crosswalk
from segrisk.functions.scores import classify_hhi, composite_state
from segrisk.operators.keyed import align
from segrisk.operators.shape import conform, round_columns
from segrisk.plans import geographic, workforce
from segrisk.plans.composite import Dimension, Registry, score_composite
from segrisk.plans.concentration import (
    apply_concentration,
    award_parts,
    hhi_by_state,
    recipient_totals,
    state_profile,
)
from segrisk.plans.unify import contracts_by_industry, segment_rows, unify
from segrisk.schemas import ROUNDED_ON_EXPORT, SCORED, SEGMENTS
from segrisk.session import stored


def score_segments(awards: DataFrame, trade: DataFrame, employment: DataFrame) -> DataFrame:
    """Segments with all scores over the three silver tables, each scanned once.

    Awards with and without an industry code are summed in one aggregation. Its
    result, a row per industry, state and recipient, is written once, since sums
    by industry and by state both start from it.
    """
    return score_from_totals(
        stored(recipient_totals(award_parts(awards)), "recipient-totals"),
        geographic.destination_totals(trade),
        workforce.employment_by_year(employment),
    )


def score_from_totals(parts: DataFrame, trade_totals: DataFrame, yearly: DataFrame) -> DataFrame:
    """Scored segments from award parts and the two reduced tables.

    Measures and scores of a key come out of the same aggregation, so nothing
    is scanned again or joined back just to add a score column. Same result as
    ``score_stepwise``.
    """
    spark = parts.sparkSession
    products = geographic.product_profile(trade_totals)
    exports = geographic.industry_profile(products, hs_crosswalk(spark))
    stress = workforce.industry_profile(workforce.stress_scores(yearly), series_crosswalk(spark))
    industries = align(
        [
            contracts_by_industry(parts),
            exports.select("naics_code", "export_value", "geo_risk_score"),
            stress,
        ],
        "naics_code",
    )
    # A state without a named recipient has no index row and takes the default.
    index = F.when(F.col("distinct_recipients") > 0, F.col("hhi_score")).otherwise(0.0)
    states = state_profile(parts).select(
        "state",
        "total_contract_value",
        F.col("award_count").alias("recipient_count"),
        index.alias("hhi_score"),
    )
    rows = segment_rows(industries, states, {"hhi_score": F.lit(0.0)})
    label = F.when(F.col("row_type") == "STATE", classify_hhi(F.col("hhi_score"))).otherwise("N/A")
    rows = rows.withColumn("concentration_risk_label", label)
    return conform(score_composite(rows), SCORED)


def score_stepwise(parts: DataFrame, trade_totals: DataFrame, yearly: DataFrame) -> DataFrame:
    """Segments first, then one keyed update per score.

    For rescoring one dimension of a stored segments table; peers' columns
    survive each update.
    """
    spark = parts.sparkSession
    segments = apply_concentration(unify(parts, trade_totals, yearly), hhi_by_state(parts))
    risk = geographic.industry_risk(trade_totals, hs_crosswalk(spark), naics_labels(spark))
    segments = geographic.apply_geographic(segments, risk)
    stress = workforce.industry_stress(workforce.stress_scores(yearly), series_crosswalk(spark))
    segments = workforce.apply_workforce(segments, stress)
    return conform(score_composite(segments), SCORED)


def standard_dimensions(parts: DataFrame, trade_totals: DataFrame, yearly: DataFrame) -> Registry:
    """The three built-in scores as registered dimensions."""
    spark = parts.sparkSession

    def concentration() -> DataFrame:
        hhi = hhi_by_state(parts)
        return hhi.select("state", composite_state(F.col("hhi_score")).alias("score"))

    def destinations() -> DataFrame:
        risk = geographic.industry_risk(trade_totals, hs_crosswalk(spark), naics_labels(spark))
        return risk.select("naics_code", F.col("geo_risk_score").alias("score"))

    def stress() -> DataFrame:
        scores = workforce.stress_scores(yearly)
        found = workforce.industry_stress(scores, series_crosswalk(spark))
        return found.select("naics_code", F.col("workforce_risk_score").alias("score"))

    return Registry(
        [
            Dimension("concentration", "STATE", "state", concentration, 1.0, missing=0.0),
            Dimension("geographic", "NAICS", "naics_code", destinations, 0.5),
            Dimension("workforce", "NAICS", "naics_code", stress, 0.5),
        ]
    )


def canonical(segments: DataFrame) -> DataFrame:
    """The export form and its mark: columns in order, figures rounded to 2 digits."""
    return round_columns(conform(segments, SCORED), ROUNDED_ON_EXPORT)


def exported(segments: DataFrame) -> DataFrame:
    """The 14 columns of an export."""
    return conform(segments, SEGMENTS)


def canonical_keys() -> list[Column]:
    """Industries by code, then states that awards name A-Z, then states that were added."""
    return [F.col("row_type"), F.col("naics_code"), F.coalesce("is_padded", F.lit(False)), F.col("state")]


def marked(segments: DataFrame) -> DataFrame:
    """Segments from an export carry no mark of added states; there none counts as added."""
    return segments if "is_padded" in segments.columns else segments.withColumn("is_padded", F.lit(False))


def canonical_order(segments: DataFrame) -> DataFrame:
    return marked(segments).orderBy(*canonical_keys())


def preview(segments: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of the canonical order, as a top-n."""
    return canonical_order(segments).limit(n)
