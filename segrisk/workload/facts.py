"""Awards, trade and employment derived from the star-schema tables.

Awards are line items of a supplier, whose nation stands for a state; trade is
the events table, with users as destinations; employment is the mean monthly
quantity of a part type. Amounts, values and names are those of the tables. States
are written plainly, loosely, wrongly or not at all by rule, and indebted
suppliers have no name, so that missing and invalid keys occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.dims import (
    NAICS_LABELS,
    REQUESTED_HS_CODES,
    SERIES_LABELS,
    VALID_STATES,
    values_table,
)
from segrisk.functions.values import cents, pad_left
from segrisk.operators.shape import conform, map_literal
from segrisk.plans.concentration import clean_keys
from segrisk.plans.geographic import destination_totals
from segrisk.plans.scoring import canonical, score_from_totals
from segrisk.plans.workforce import employment_by_year
from segrisk.schemas import AWARDS, TRADE
from segrisk.session import stored, stored_once

# Which code each nation, event type and part type stands for.
STATE_OF_NATION = dict(enumerate(VALID_STATES[-25:]))
PRODUCT_OF_EVENT = dict(zip(["click", "error", "purchase", "signup", "view"], REQUESTED_HS_CODES))
SERIES_OF_TYPE = dict(zip(["ECONOMY", "LARGE", "MEDIUM"], SERIES_LABELS))


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan with the known schema; no file is opened before the query runs."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _state_form() -> Column:
    """How an award writes its state: not at all, wrongly, loosely or plainly."""
    return (
        F.when(F.col("l_tax") == 0.0, "none")
        .when(F.col("l_tax") == 0.08, "invalid")
        .when(F.col("l_returnflag") == "A", "loose")
        .otherwise("plain")
    )


def _written_state(form: Column, code: Column) -> Column:
    return (
        F.when(form == "invalid", "ZZ")
        .when(form == "loose", F.concat(F.lit(" "), F.lower(code), F.lit(" ")))
        .when(form == "plain", code)
    )


def _recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier key, name (missing for indebted ones) and state code."""
    states = values_table(spark, ["s_nationkey", "code"], STATE_OF_NATION.items())
    named = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        "s_nationkey",
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("recipient_name"),
    )
    return named.join(states, "s_nationkey").drop("s_nationkey")


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per award."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        _state_form().alias("form"),
        F.col("l_extendedprice").alias("award_amount"),
        F.col("l_shipdate").cast("date").alias("start_date"),
    )
    joined = items.join(_recipients(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    return conform(joined.withColumn("state", _written_state(F.col("form"), F.col("code"))), AWARDS)


def coded_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same awards, those of one return flag with an industry code, some written with a decimal point."""
    code = element_of(list(NAICS_LABELS), F.col("l_suppkey"))
    coded = F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linenumber") == 1, F.concat(code, F.lit(".0"))).otherwise(code))
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        _state_form().alias("form"),
        F.col("l_extendedprice").alias("award_amount"),
        coded.alias("naics_code"),
        F.col("l_shipdate").cast("date").alias("start_date"),
    )
    joined = items.join(_recipients(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    return conform(joined.withColumn("state", _written_state(F.col("form"), F.col("code"))), AWARDS)


def element_of(values: list[str], number: Column) -> Column:
    """One of the values, in turn by number."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(number, F.lit(len(values))).cast("int"))


def award_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the same awards, summed below the join.

    Line items shrink to a few rows per supplier before they meet the supplier
    table, so the join and all that follows handle the reduced rows only.
    """
    items = (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", _state_form().alias("form"), F.col("l_extendedprice").alias("amount"))
        .groupBy("l_suppkey", "form")
        .agg(
            F.sum(cents(F.col("amount"))).alias("award_cents"),
            F.count("amount").alias("award_count"),
            F.count(F.lit(1)).alias("award_rows"),
        )
    )
    joined = items.join(_recipients(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    return clean_keys(
        joined.select(
            F.lit(None).cast("string").alias("naics_code"),
            _written_state(F.col("form"), F.col("code")).alias("state"),
            "recipient_name",
            "award_cents",
            "award_count",
            "award_rows",
        )
    )


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as exports in cents; values under 1 are suppressed."""
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "value", "ts")
    events = events.withColumn("hs_code", map_literal(F.col("event_type"), PRODUCT_OF_EVENT))
    user = F.col("user_id").cast("string")
    return conform(
        events.select(
            "hs_code",
            F.col("event_type").alias("hs_description"),
            pad_left(user, 4).alias("country_code"),
            F.concat(F.lit("Destination "), user).alias("country_name"),
            F.when(F.col("value") >= 1, F.rint(F.col("value") * 100)).alias("export_value"),
            F.year("ts").alias("year"),
        ),
        TRADE,
    )


def monthly_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity per part type and month."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(
        "p_type", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    ).agg(F.avg("l_quantity").alias("value"))


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order count per priority and month."""
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy(
        "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return as_employment(counts, "o_orderpriority")


def as_employment(monthly: DataFrame, series: str, label: str | None = None) -> DataFrame:
    start = F.make_date("year", "month", F.lit(1))
    return monthly.select(
        F.col(series).alias("series_id"),
        "year",
        F.format_string("M%02d", "month").alias("period"),
        F.date_format(start, "MMMM").alias("period_name"),
        "value",
        F.col(label or series).alias("series_label"),
    )


def employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three part types stand for the known series, the others keep their name."""
    known = values_table(
        spark,
        ["p_type", "series_id", "series_label"],
        [(kind, sid, SERIES_LABELS[sid]) for kind, sid in SERIES_OF_TYPE.items()],
    )
    named = monthly_quantity(spark, sf_dir).join(known, "p_type", "left")
    named = named.withColumns(
        {c: F.coalesce(c, "p_type") for c in ("series_id", "series_label")}
    )
    return as_employment(named, "series_id", "series_label")


def reduced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables in the reduced form the scores are computed from."""
    return (
        award_parts(spark, sf_dir),
        destination_totals(trade(spark, sf_dir)),
        employment_by_year(employment(spark, sf_dir)),
    )


def stored_reduced(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The same, written once, for plans that use each of them several times."""
    names = ("parts", "trade-totals", "employment-years")
    return [stored(df, name) for df, name in zip(reduced(spark, sf_dir), names)]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored segments in export form, one lazy plan."""
    return canonical(score_from_totals(*reduced(spark, sf_dir)))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, written once per session and folder, for all that read it."""
    return stored_once(spark, "segments", sf_dir, lambda: scored(spark, sf_dir))
