"""One dimension of a stored segments table scored anew, peers' columns and files untouched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.dims import NAICS_LABELS, hs_crosswalk, series_crosswalk
from segrisk.functions.scores import classify_hhi
from segrisk.operators.shape import map_literal
from segrisk.plans import geographic, workforce
from segrisk.plans.composite import score_composite
from segrisk.schemas import SCORED
from segrisk.session import stored
from segrisk.sources import keyed_store

KEYS = ["row_type", "naics_code", "state"]


def keep_segments(segments: DataFrame, path: str, buckets: int = keyed_store.BUCKETS) -> None:
    """Segments as a table that can be changed by key."""
    keyed_store.create(segments.select(*SCORED.names), path, KEYS, buckets)


def rescore_workforce(spark: SparkSession, path: str, yearly: DataFrame) -> list[str]:
    """Employment and stress of every industry, from all observations by year."""
    fresh = workforce.industry_profile(workforce.stress_scores(yearly), series_crosswalk(spark))
    return _rescore(spark, path, "NAICS", "naics_code", fresh, {"employment_count": None, "workforce_risk_score": None})


def rescore_geographic(spark: SparkSession, path: str, trade_totals: DataFrame) -> list[str]:
    """Exports and destination dependence of every industry."""
    products = geographic.product_profile(trade_totals)
    fresh = geographic.industry_profile(products, hs_crosswalk(spark)).select("naics_code", "export_value", "geo_risk_score")
    return _rescore(spark, path, "NAICS", "naics_code", fresh, {"export_value": None, "geo_risk_score": None})


def rescore_concentration(spark: SparkSession, path: str, profile: DataFrame) -> list[str]:
    """Contract value, awards and index of every state, from a profile such as ``state_profile`` gives.

    A state without awards has value, count and index 0; it counts as added.
    """
    index = F.when(F.col("distinct_recipients") > 0, F.col("hhi_score")).otherwise(0.0)
    fresh = profile.select(
        "state",
        "total_contract_value",
        F.col("award_count").alias("recipient_count"),
        index.alias("hhi_score"),
        F.lit(False).alias("is_padded"),
    ).withColumn("concentration_risk_label", classify_hhi(F.col("hhi_score")))
    nothing = {
        "total_contract_value": F.lit(0.0), "recipient_count": F.lit(0).cast("long"), "hhi_score": F.lit(0.0),
        "is_padded": F.lit(True), "concentration_risk_label": F.lit("Low"),
    }
    return _rescore(spark, path, "STATE", "state", fresh, nothing)


def _rescore(spark: SparkSession, path: str, row_type: str, key: str, fresh: DataFrame, nothing: dict[str, Column | None]) -> list[str]:
    """Set columns of the rows whose values differ from ``fresh``, and what follows from them.

    A row whose key ``fresh`` lacks takes ``nothing`` and stays; a key without a row
    becomes one. Only the buckets of such keys are read whole and written again.
    """
    columns = list(nothing)
    kind = {f.name: f.dataType for f in SCORED.fields}
    now = keyed_store.read(spark, path).where(F.col("row_type") == row_type).select(
        F.col(key).alias("_key"), F.struct(*columns).alias("_now")
    )
    none = F.struct(*[(F.lit(None) if v is None else v).cast(kind[c]).alias(c) for c, v in nothing.items()])
    target = fresh.where(F.col(key).isNotNull()).select(key, F.struct(*[F.col(c).cast(kind[c]).alias(c) for c in columns]).alias("_set"))
    joined = target.join(now, F.col(key) == F.col("_key"), "full_outer")
    settled = joined.select(
        F.coalesce(key, "_key").alias(key), F.coalesce("_set", none).alias("_set"), "_now", F.col("_key").isNull().alias("_new")
    )
    changed = settled.where(F.col("_new") | ~F.col("_set").eqNullSafe(F.col("_now")))
    other = "state" if key == "naics_code" else "naics_code"
    named = changed.select(F.lit(row_type).alias("row_type"), F.col(key), F.lit(None).cast("string").alias(other), "_set")
    # Written once: the touched buckets are found from it, and then it meets their rows.
    named = stored(named, "changes")

    def change(old: DataFrame) -> DataFrame:
        new = named.select(F.col(key).alias("_k"), "_set")
        rows = old.join(new, (old["row_type"] == row_type) & (old[key] == new["_k"]), "full_outer")
        hit, added = F.col("_k").isNotNull(), F.col("row_type").isNull()
        values = {c: F.when(hit, F.col("_set")[c]).otherwise(F.col(c)) for c in columns}
        values |= {key: F.coalesce(key, "_k"), "row_type": F.when(hit, row_type).otherwise(F.col("row_type"))}
        if key == "naics_code":
            label = map_literal(F.col("_k"), NAICS_LABELS)
            values |= {
                "naics_label": F.when(added, label).otherwise(F.col("naics_label")),
                "concentration_risk_label": F.when(added, "N/A").otherwise(F.col("concentration_risk_label")),
            }
        before = {c: F.col(c).alias(f"_{c}") for c in ("composite_risk_score", "risk_tier")}
        moved = rows.select(*[values.get(c, F.col(c)).alias(c) for c in SCORED.names], hit.alias("_hit"), *before.values())
        # Only rows that were set get a new composite.
        result = {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.col(f"_{c}")) for c in before}
        return score_composite(moved).withColumns(result).select(*SCORED.names)

    return keyed_store.rewrite(spark, path, named.select(*KEYS), change)
