"""One table of segments from awards, trade and employment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.dims import hs_crosswalk, naics_labels, required_states, series_crosswalk
from segrisk.functions.values import dollars, round_even, wide
from segrisk.operators.filters import drop_orphans
from segrisk.operators.keyed import align, pad_missing
from segrisk.operators.shape import map_codes
from segrisk.operators.totals import sum_and_count
from segrisk.plans.concentration import clean_keys, state_profile

BASE_COLUMNS = [
    "naics_code",
    "naics_label",
    "state",
    "row_type",
    "total_contract_value",
    "recipient_count",
    "export_value",
    "employment_count",
    "hhi_score",
    "concentration_risk_label",
    "is_padded",
]


def awards_by_key(awards: DataFrame) -> DataFrame:
    """Contract value and award count per (industry, state), NULL keys included.

    Summed per key as written first: the keys are then normalised once per
    spelling instead of once per award.
    """
    spelled = sum_and_count(awards, ["naics_code", "state"], "award_amount", "award_cents", "award_count")
    return parts_by_key(spelled)


def parts_by_key(parts: DataFrame) -> DataFrame:
    """The same from award parts of any grain.

    ``recipient_count`` counts awards with a known amount, as its source does;
    it is not a number of recipients.
    """
    return (
        clean_keys(parts)
        .groupBy("naics_code", "state")
        .agg(
            dollars(F.coalesce(F.sum(wide(F.col("award_cents"))), F.lit(0))).alias("total_contract_value"),
            F.sum("award_count").alias("recipient_count"),
        )
    )


def contracts_by_industry(parts: DataFrame) -> DataFrame:
    """Contract value and award count per industry, where awards carry one."""
    return (
        parts.where(F.col("naics_code").isNotNull())
        .groupBy("naics_code")
        .agg(
            dollars(F.coalesce(F.sum(wide(F.col("award_cents"))), F.lit(0))).alias("total_contract_value"),
            F.sum("award_count").alias("recipient_count"),
        )
    )


def contracts_by_state(parts: DataFrame) -> DataFrame:
    return state_profile(parts).select(
        "state", "total_contract_value", F.col("award_count").alias("recipient_count")
    )


def exports_by_industry(totals: DataFrame, crosswalk: DataFrame) -> DataFrame:
    mapped = map_codes(totals, crosswalk, "hs_code", "naics_code", keep_unmapped=False)
    return mapped.groupBy("naics_code").agg(
        F.sum("export_total").cast("double").alias("export_value")
    )


def employment_by_industry(yearly: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Mean over all months, given in thousands, as whole workers."""
    mapped = map_codes(yearly, crosswalk, "series_id", "naics_code", keep_unmapped=False)
    mean = F.sum("value_sum") / F.sum("n")
    return mapped.groupBy("naics_code").agg(
        round_even(mean * 1000.0, 0).cast("long").alias("employment_count")
    )


def tag_rows(df: DataFrame) -> DataFrame:
    """Row type from the key that is set."""
    code, state = F.col("naics_code"), F.col("state")
    return df.withColumn(
        "row_type", F.when(code.isNotNull(), "NAICS").when(state.isNotNull(), "STATE")
    )


def segment_rows(
    industries: DataFrame, states: DataFrame, padding: Mapping[str, Column] | None = None
) -> DataFrame:
    """Tagged union of both kinds of rows, every required state present."""
    labels = naics_labels(states.sparkSession)
    labelled = map_codes(industries, labels, "naics_code", "naics_label")
    rows = labelled.unionByName(pad_states(states, padding), allowMissingColumns=True)
    return tag_rows(drop_orphans(rows, ["naics_code", "state"]))


def unscored(segments: DataFrame) -> DataFrame:
    """Concentration columns before scoring: no index; industry rows are labelled N/A."""
    return segments.withColumns(
        {
            "hhi_score": F.lit(None).cast("double"),
            "concentration_risk_label": F.when(F.col("naics_code").isNotNull(), "N/A"),
        }
    )


def unify(parts: DataFrame, trade_totals: DataFrame, yearly: DataFrame) -> DataFrame:
    """Segments without scores.

    Awards are summed per state and, separately, per industry, so that exactly
    one key is set on each row.
    """
    spark = parts.sparkSession
    industries = align(
        [
            contracts_by_industry(parts),
            exports_by_industry(trade_totals, hs_crosswalk(spark)),
            employment_by_industry(yearly, series_crosswalk(spark)),
        ],
        "naics_code",
    )
    rows = segment_rows(industries, contracts_by_state(parts))
    return unscored(rows).select(*BASE_COLUMNS)


def pad_states(states: DataFrame, padding: Mapping[str, Column] | None = None) -> DataFrame:
    """Required states without a row get one with value and count 0, marked ``is_padded``."""
    added = {
        "total_contract_value": F.lit(0.0),
        "recipient_count": F.lit(0).cast("long"),
        "is_padded": F.lit(True),
    }
    required = required_states(states.sparkSession)
    present = states.withColumn("is_padded", F.lit(False))
    return pad_missing(present, required, "state", {**added, **(padding or {})})


def coverage_report(segments: DataFrame) -> DataFrame:
    """Row counts by kind and the required states without a row, as one record.

    Missing states come out of an outer join, so the input is read once. Their
    list holds at most the 50 required states.
    """
    code, state = F.col("naics_code"), F.col("state")
    kind = F.when(code.isNotNull(), "naics").when(state.isNotNull(), "state").otherwise("orphan")
    rows = segments.select(kind.alias("kind"), F.when(code.isNull(), state).alias("state"))
    tagged = pad_missing(
        rows, required_states(segments.sparkSession), "state", {"kind": F.lit("missing")}
    )

    def having(name: str) -> Column:
        return F.count_if(F.col("kind") == name)

    listed = F.collect_set(F.when(F.col("kind") == "missing", F.col("state")))
    return tagged.agg(
        F.count_if(F.col("kind") != "missing").alias("total_rows"),
        having("naics").alias("naics_rows"),
        having("state").alias("state_rows"),
        having("orphan").alias("orphan_rows"),
        having("missing").alias("missing_states"),
        F.array_join(F.sort_array(listed), ",").alias("missing_list"),
    )
