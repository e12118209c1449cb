"""Supplier concentration per state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.scores import classify_hhi
from segrisk.functions.values import blank_to_null, cents, code_text, dollars, normalize_state
from segrisk.operators.keyed import upsert
from segrisk.operators.totals import group_profile

TOTAL_KEYS = ["naics_code", "state", "recipient_name"]


def clean_keys(awards: DataFrame) -> DataFrame:
    """Normalise the keys once, so that every consumer sees the same states."""
    return awards.withColumns(
        {"state": normalize_state(F.col("state")), "naics_code": blank_to_null(code_text(F.col("naics_code")))}
    )


def award_parts(awards: DataFrame, amount: str = "award_amount") -> DataFrame:
    """Awards in the additive form every later sum works on: one part per award.

    Parts may be summed to any coarser grain first, for instance below a join;
    what is computed from them stays the same.
    """
    value = cents(F.col(amount))
    return clean_keys(awards).select(
        *TOTAL_KEYS,
        value.alias("award_cents"),
        value.isNotNull().cast("long").alias("award_count"),
    )


def recipient_totals(parts: DataFrame) -> DataFrame:
    """A row per (industry, state, recipient), NULL keys kept."""
    return parts.groupBy(*TOTAL_KEYS).agg(
        F.sum("award_cents").alias("award_cents"), F.sum("award_count").alias("award_count")
    )


def state_profile(parts: DataFrame) -> DataFrame:
    """Contract value, award count, named recipients and index per state.

    Two combining aggregations: per (state, recipient), then per state.
    """
    entities = parts.groupBy("state", "recipient_name").agg(
        F.sum("award_cents").alias("award_cents"), F.sum("award_count").alias("award_count")
    )
    return group_profile(entities, "state", "recipient_name", "award_cents", "award_count").select(
        "state",
        dollars(F.col("group_value")).alias("total_contract_value"),
        F.col("row_count").alias("award_count"),
        F.col("entities").alias("distinct_recipients"),
        "hhi_score",
    )


def hhi_by_state(parts: DataFrame) -> DataFrame:
    """Index and label of the states with at least one named recipient."""
    return (
        state_profile(parts)
        .where(F.col("distinct_recipients") > 0)
        .select(
            "state",
            "hhi_score",
            classify_hhi(F.col("hhi_score")).alias("concentration_risk_label"),
        )
    )


def apply_concentration(segments: DataFrame, hhi: DataFrame) -> DataFrame:
    """States without a scored award get 0 / Low; industry rows have no index."""
    return upsert(
        segments,
        hhi,
        key="state",
        applies=F.col("naics_code").isNull() & F.col("state").isNotNull(),
        defaults={"hhi_score": F.lit(0.0), "concentration_risk_label": F.lit("Low")},
        elsewhere={
            "hhi_score": F.lit(None).cast("double"),
            "concentration_risk_label": F.lit("N/A"),
        },
    )


def dropped_rows(df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """How many rows the filter on a missing key takes away, in one pass.

    ``weight`` tells how many rows each row of a reduced table stands for.
    """
    rows = F.col(weight) if weight else F.lit(1)
    known = F.col(key).isNotNull()
    return df.agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("rows_before"),
        F.coalesce(F.sum(F.when(~known, rows)), F.lit(0)).cast("long").alias("rows_dropped"),
        F.coalesce(F.sum(F.when(known, rows)), F.lit(0)).cast("long").alias("rows_after"),
        F.count_distinct(key).alias("distinct_keys"),
    )
