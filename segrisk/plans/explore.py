"""Queries behind an interactive view of the segments.

The segments table is meant to be stored once and read here; every function
takes it as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.dims import SECTOR_SHORT_NAMES, mapping_table
from segrisk.functions.formatting import (
    dashboard_int,
    dashboard_metric,
    dashboard_money,
    dashboard_number,
    panel_label,
    segment_identifier,
)
from segrisk.functions.values import code_text
from segrisk.operators.filters import at_least, complete_rows, in_tiers
from segrisk.operators.keyed import same_row
from segrisk.operators.ranking import descending
from segrisk.operators.shape import blank_text, map_codes_or, rename

# The columns shown, and their headings.
DISPLAY_NAMES = {
    "row_type": "Type",
    "state": "State",
    "naics_label": "Sector",
    "composite_risk_score": "Risk Score",
    "risk_tier": "Risk Tier",
    "hhi_score": "HHI",
    "geo_risk_score": "Geo Risk",
    "workforce_risk_score": "Workforce Risk",
}
TIERS = ["High", "Medium", "Low", "Minimal"]


def filtered_view(
    segments: DataFrame,
    tiers: Sequence[str] = TIERS,
    row_type: str | None = None,
    minimum: float = 0.0,
) -> DataFrame:
    """Rows of the chosen tiers, type and minimum score, worst first, NULLs last."""
    keep = in_tiers(F.col("risk_tier"), tiers) & at_least(F.col("composite_risk_score"), minimum)
    if row_type is not None:
        keep = keep & (F.col("row_type") == row_type)
    order = descending("composite_risk_score", "row_type", "state", "naics_code")
    return segments.where(keep).orderBy(*order)


def display_view(view: DataFrame) -> DataFrame:
    """Shown columns under their headings, missing text blank."""
    return rename(blank_text(view.select(*DISPLAY_NAMES)), DISPLAY_NAMES)


def kpis(segments: DataFrame) -> DataFrame:
    contract = F.when(F.col("row_type") == "STATE", F.col("total_contract_value"))
    return segments.agg(
        F.count(F.lit(1)).alias("total_segments"),
        F.count_if(F.col("risk_tier") == "High").alias("high_risk_segments"),
        F.max("composite_risk_score").alias("highest_score"),
        (F.coalesce(F.sum(contract), F.lit(0.0)) / 1e9).alias("contract_value_bn"),
    )


def state_map(segments: DataFrame) -> DataFrame:
    """Rows a state map can draw: state and score both known."""
    states = segments.where(F.col("row_type") == "STATE")
    return complete_rows(states, ["state", "composite_risk_score"]).select(
        "state",
        "composite_risk_score",
        "risk_tier",
        "total_contract_value",
        "recipient_count",
        "hhi_score",
    )


def default_selection(segments: DataFrame) -> DataFrame:
    """The state with the highest score."""
    states = segments.where(F.col("row_type") == "STATE")
    return states.orderBy(*descending("composite_risk_score", "state")).limit(1)


def find_segment(segments: DataFrame, row_type: str, state: str | None, code: str | None) -> DataFrame:
    """The full record of one row; a NULL key equals a NULL key."""
    key = {"row_type": row_type, "state": state, "naics_code": code}
    return segments.where(same_row(key)).limit(1)


def panel_row(
    segments: DataFrame,
    picked: tuple[str, str | None, str | None] | None = None,
    clicked_state: str | None = None,
) -> DataFrame:
    """The row shown in detail: a picked table row, else a clicked state, else the default.

    A choice that matches nothing falls back to the default as well. Choice and
    default are candidates of one top-1 selection, so the table is read once.
    """
    if picked is not None:
        chosen = same_row(dict(zip(("row_type", "state", "naics_code"), picked)))
    elif clicked_state is not None:
        chosen = same_row({"row_type": "STATE", "state": clicked_state})
    else:
        return default_selection(segments)
    candidates = segments.where(chosen | (F.col("row_type") == "STATE"))
    return candidates.orderBy(chosen.desc(), *descending("composite_risk_score", "state")).limit(1)


def _tier_or_na() -> Column:
    return F.coalesce("risk_tier", F.lit("N/A"))


def panel_metrics(rows: DataFrame) -> DataFrame:
    """Detail panel as text; a measure of the other row type shows N/A."""
    is_state = F.col("row_type") == "STATE"
    is_sector = F.col("row_type") == "NAICS"

    def unless(condition: Column, text: Column) -> Column:
        return F.when(condition, F.lit("N/A")).otherwise(text)

    return rows.select(
        segment_identifier(F.col("row_type"), F.col("state"), F.col("naics_code")).alias("identifier"),
        panel_label(F.col("row_type"), F.col("state"), F.col("naics_code"), F.col("naics_label")).alias("title"),
        _tier_or_na().alias("tier"),
        dashboard_metric(F.col("composite_risk_score")).alias("composite_risk"),
        unless(is_state, dashboard_metric(F.col("geo_risk_score"))).alias("geo_risk"),
        unless(is_state, dashboard_metric(F.col("workforce_risk_score"))).alias("workforce_risk"),
        unless(is_sector, dashboard_metric(F.col("hhi_score"))).alias("hhi"),
        dashboard_money(F.col("total_contract_value")).alias("contract_value"),
        dashboard_int(F.col("recipient_count")).alias("recipients"),
    )


def sector_cards(segments: DataFrame) -> DataFrame:
    """One card per industry in code order; without a short name the long one serves."""
    names = mapping_table(segments.sparkSession, SECTOR_SHORT_NAMES, "naics_code", "sector")
    rows = segments.where(F.col("row_type") == "NAICS").withColumn("naics_code", code_text(F.col("naics_code")))
    named = map_codes_or(rows, names, "naics_code", "sector", F.coalesce("naics_label", "naics_code"))
    return named.orderBy("naics_code").select(
        "naics_code",
        "sector",
        dashboard_number(F.col("composite_risk_score")).alias("composite"),
        _tier_or_na().alias("tier"),
        dashboard_number(F.col("geo_risk_score")).alias("geo"),
        dashboard_number(F.col("workforce_risk_score")).alias("workforce"),
    )
