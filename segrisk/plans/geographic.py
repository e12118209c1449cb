"""Dependence of exports on few destinations, per product and per industry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.functions.values import round_even
from segrisk.operators.keyed import upsert
from segrisk.operators.shape import map_codes
from segrisk.operators.totals import destination_profile, worst_member

CARRIED = ["top_country", "top_country_share", "country_count"]


def destination_totals(trade: DataFrame) -> DataFrame:
    """The one pass over the trade table. Unknown values count 0, their country still counts."""
    return trade.groupBy("hs_code", "country_name").agg(
        F.sum(F.coalesce("export_value", F.lit(0))).alias("export_total")
    )


def product_profile(totals: DataFrame) -> DataFrame:
    return destination_profile(totals, "hs_code", "country_name", "export_total")


def product_risk(totals: DataFrame) -> DataFrame:
    """Scored products only: without exports to a known destination there is no dependence to score."""
    return product_profile(totals).where(F.col("top_country_share").isNotNull()).drop("total_value")


def industry_profile(products: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Exports, mean product score and the most dependent product's figures.

    Products no industry claims drop out; see ``unmapped_products``.
    """
    mapped = map_codes(products, crosswalk, "hs_code", "naics_code", keep_unmapped=False)
    return (
        mapped.groupBy("naics_code")
        .agg(
            F.sum("total_value").alias("export_value"),
            round_even(F.avg("geo_risk_score")).alias("geo_risk_score"),
            worst_member("hs_code", "top_country_share", CARRIED).alias("worst"),
        )
        .select(
            "naics_code",
            "export_value",
            "geo_risk_score",
            *[F.col(f"worst.{c}").alias(c) for c in CARRIED],
        )
    )


def industry_risk(totals: DataFrame, crosswalk: DataFrame, labels: DataFrame) -> DataFrame:
    scored = industry_profile(product_profile(totals), crosswalk)
    scored = scored.where(F.col("geo_risk_score").isNotNull()).drop("export_value")
    return map_codes(scored, labels, "naics_code", "naics_label")


def unmapped_products(totals: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Products that silently score nothing because no industry claims them."""
    return (
        totals.join(crosswalk, "hs_code", "left_anti")
        .groupBy("hs_code")
        .agg(F.sum("export_total").alias("export_value"), F.count("country_name").alias("country_count"))
    )


def apply_geographic(segments: DataFrame, risk: DataFrame) -> DataFrame:
    nothing = {"geo_risk_score": F.lit(None).cast("double")}
    return upsert(
        segments,
        risk.select("naics_code", "geo_risk_score"),
        key="naics_code",
        applies=F.col("state").isNull(),
        defaults=nothing,
        elsewhere=nothing,
    )
