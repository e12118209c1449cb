"""One query per operator or job, on the star-schema tables.

Each function takes (spark, sf_dir) and returns a lazy DataFrame over whole
tables. Queries whose subject is a sink write to the shared folder and return
what they read back. Doubles are rounded so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from segrisk.dims import (
    AWARD_FISCAL_YEARS,
    hs_crosswalk,
    mapping_table,
    naics_labels,
    required_states,
    series_crosswalk,
    values_table,
)
from segrisk.functions.scores import classify_hhi, classify_tier, composite_sector, composite_state
from segrisk.functions.values import cents, dollars, fiscal_year, pad_left, round_even
from segrisk.operators import filters, intervals, keyed, layout, ranking, selection, series, sketches, totals
from segrisk.operators.shape import rename
from segrisk.plans import (
    briefs,
    concentration,
    eda,
    explore,
    geographic,
    rescoring,
    running,
    scoring,
    summaries,
    unify,
    workforce,
)
from segrisk.plans.composite import Dimension
from segrisk.schemas import AWARDS, MANIFEST
from segrisk.session import LONG_ROWS, scratch_path, shuffles_freed, stored
from segrisk.sources import delimited, keyed_store, landed, ledger, sinks, tables, versions
from segrisk.workload import facts
from segrisk.workload.facts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: round_even(F.col(name), digits) for name in doubles})


def whole_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("long") for name, kind in df.dtypes if kind == "int"})


# --- concentration -----------------------------------------------------------


def _supplier_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value per supplier, summed before the supplier table is joined."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("entity_cents"))
    )


def _nation_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        _supplier_totals(spark, sf_dir)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("n_name", "s_name", "entity_cents")
    )


def _nation_hhi(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = totals.group_profile(_nation_suppliers(spark, sf_dir), "n_name", "s_name", "entity_cents")
    return profile.select("n_name", round_even(F.col("hhi_score"), 4).alias("hhi_score")).withColumn(
        "concentration_risk_label", classify_hhi(F.col("hhi_score"))
    )


@query
def hhi_by_nation(spark, sf_dir):
    return _nation_hhi(spark, sf_dir)


@query
def entity_shares(spark, sf_dir):
    shares = totals.share_of_total(_nation_suppliers(spark, sf_dir), "n_name", "entity_cents")
    return rounded(
        shares.select("n_name", "s_name", dollars(F.col("entity_cents")).alias("entity_total"), "share"),
        6,
    )


@query
def top_hhi_nations(spark, sf_dir):
    hhi = _nation_hhi(spark, sf_dir)
    return ranking.top_k(hhi, 10, ranking.descending("hhi_score", "n_name"), rank="rank")


@query
def hhi_padded(spark, sf_dir):
    """Nations stand for states; every required state has a row, those without a supplier the default."""
    codes = values_table(spark, ["n_nationkey", "state"], facts.STATE_OF_NATION.items())
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").join(codes, "n_nationkey")
    return keyed.upsert(
        required_states(spark),
        _nation_hhi(spark, sf_dir).join(names, "n_name"),
        key="state",
        applies=F.lit(True),
        defaults={"hhi_score": F.lit(0.0), "concentration_risk_label": F.lit("Low")},
        elsewhere={"hhi_score": F.lit(None), "concentration_risk_label": F.lit("N/A")},
    )


@query
def hhi_label_counts(spark, sf_dir):
    return totals.category_counts(_nation_hhi(spark, sf_dir), "concentration_risk_label")


@query
def null_state_audit(spark, sf_dir):
    return concentration.dropped_rows(facts.award_parts(spark, sf_dir), "state", weight="award_rows")


# --- destinations ------------------------------------------------------------


@query
def dest_dependence(spark, sf_dir):
    return geographic.product_risk(geographic.destination_totals(facts.trade(spark, sf_dir)))


@query
def dest_dependence_capped(spark, sf_dir):
    """Few destinations: the score reaches its cap."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_customer = (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "p_type")
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("value"))
    )
    per_nation = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("p_type", "n_name")
        .agg(F.sum("value").alias("value"))
    )
    return totals.destination_profile(per_nation, "p_type", "n_name", "value").drop("total_value")


def _brand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("p_brand", "o_custkey")
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("export_total"))
        .select(
            F.col("p_brand").alias("hs_code"),
            F.col("o_custkey").cast("string").alias("country_name"),
            "export_total",
        )
    )


@query
def dest_rollup_worst(spark, sf_dir):
    """Brands stand for products, groups of five brands for industries; brand 25 has none."""
    groups = {f"Brand#{n}": f"Group {n // 5}" for n in range(1, 25)}
    crosswalk = mapping_table(spark, groups, "hs_code", "naics_code")
    products = geographic.product_profile(_brand_totals(spark, sf_dir))
    rolled = geographic.industry_profile(products, crosswalk)
    named = rename(rolled, {"naics_code": "brand_group", "export_value": "total_value"})
    return rounded(named.withColumn("total_value", dollars(F.col("total_value"))), 2)


@query
def unmapped_products(spark, sf_dir):
    return geographic.unmapped_products(
        geographic.destination_totals(facts.trade(spark, sf_dir)), hs_crosswalk(spark)
    )


@query
def trade_by_industry(spark, sf_dir):
    risk = geographic.industry_risk(
        geographic.destination_totals(facts.trade(spark, sf_dir)), hs_crosswalk(spark), naics_labels(spark)
    )
    return risk


# --- workforce ---------------------------------------------------------------

STRESS_COLUMNS = [
    "series_id",
    "observations",
    "latest_employment",
    "peak_employment",
    "peak_to_current_ratio",
    "volatility",
    "peak_score",
    "volatility_score",
    "trend_penalty",
    "workforce_risk_score",
]


def _stress(employment: DataFrame) -> DataFrame:
    scores = workforce.stress_scores(workforce.employment_by_year(employment))
    return rounded(scores.select(*STRESS_COLUMNS))


@query
def series_stress(spark, sf_dir):
    return _stress(facts.as_employment(facts.monthly_quantity(spark, sf_dir), "p_type"))


@query
def series_stress_volatile(spark, sf_dir):
    return _stress(facts.monthly_orders(spark, sf_dir))


@query
def series_changes(spark, sf_dir):
    changes = series.changes(workforce.with_month(facts.monthly_orders(spark, sf_dir)))
    return whole_numbers(changes.select("series_id", "year", "month", "value", "change"))


@query
def series_peak_month(spark, sf_dir):
    return whole_numbers(rounded(summaries.employment_summary(facts.monthly_orders(spark, sf_dir))))


@query
def missing_states(spark, sf_dir):
    """Required states none of the awards falls in."""
    return keyed.missing_keys(facts.award_parts(spark, sf_dir), required_states(spark), "state")


# --- unification and composite ----------------------------------------------


@query
def awards_by_key(spark, sf_dir):
    return unify.parts_by_key(facts.award_parts(spark, sf_dir))


@query
def recipient_profile(spark, sf_dir):
    return rounded(concentration.state_profile(facts.award_parts(spark, sf_dir)), 4)


@query
def exports_by_industry(spark, sf_dir):
    trade_totals = geographic.destination_totals(facts.trade(spark, sf_dir))
    return unify.exports_by_industry(trade_totals, hs_crosswalk(spark))


@query
def employment_by_industry(spark, sf_dir):
    yearly = workforce.employment_by_year(facts.employment(spark, sf_dir))
    return unify.employment_by_industry(yearly, series_crosswalk(spark))


@query
def unify_segments(spark, sf_dir):
    return unify.unify(*facts.reduced(spark, sf_dir)).drop("is_padded")


@query
def coverage_report(spark, sf_dir):
    """Coverage before padding: which required states have awards."""
    return unify.coverage_report(unify.parts_by_key(facts.award_parts(spark, sf_dir)))


@query
def scored_segments(spark, sf_dir):
    return scoring.exported(facts.scored(spark, sf_dir))


@query
def scored_row_level(spark, sf_dir):
    """The run a user starts: single awards, some with an industry code, trade rows and employment."""
    inputs = (facts.coded_awards(spark, sf_dir), facts.trade(spark, sf_dir), facts.employment(spark, sf_dir))
    return scoring.exported(scoring.canonical(scoring.score_segments(*inputs)))


@query
def coded_awards_by_key(spark, sf_dir):
    return unify.awards_by_key(facts.coded_awards(spark, sf_dir))


@query
def export_order(spark, sf_dir):
    """Line of every segment in the export."""
    numbered = ranking.number_rows(facts.segments(spark, sf_dir), scoring.canonical_keys(), rank="line")
    return numbered.select("line", "row_type", "naics_code", "state")


@query
def scored_stepwise(spark, sf_dir):
    return scoring.exported(scoring.canonical(scoring.score_stepwise(*facts.stored_reduced(spark, sf_dir))))


@query
def segment_preview(spark, sf_dir):
    return scoring.preview(facts.segments(spark, sf_dir), 6).select(
        "row_type", "naics_code", "state", "composite_risk_score", "risk_tier"
    )


@query
def registry_scores(spark, sf_dir):
    """The built-in dimensions and one more, the rate of suppressed trade cells."""
    reduced = facts.stored_reduced(spark, sf_dir)
    registry = scoring.standard_dimensions(*reduced)

    def suppression() -> DataFrame:
        cells = facts.trade(spark, sf_dir).groupBy("hs_code").agg(
            F.count(F.lit(1)).alias("cells"), F.count_if(F.col("export_value").isNull()).alias("hidden")
        )
        return (
            cells.join(hs_crosswalk(spark), "hs_code")
            .groupBy("naics_code")
            .agg((F.sum("hidden") / F.sum("cells") * 100.0).alias("score"))
        )

    registry.add(Dimension("suppression", "NAICS", "naics_code", suppression, 0.25))
    scored = registry.apply(unify.unify(*reduced))
    return rounded(
        scored.select(
            "row_type",
            "naics_code",
            "state",
            "concentration_score",
            "geographic_score",
            "workforce_score",
            "suppression_score",
            "composite_risk_score",
            "risk_tier",
        )
    )


@query
def composite_tiers(spark, sf_dir):
    """Score rules over all customers: every null pattern and every tier occurs."""
    balance = F.col("c_acctbal")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "STATE").otherwise("NAICS").alias("row_type"),
        F.when(balance > 0, balance).cast("string").alias("hhi_score"),
        F.when(F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD"), F.abs(balance) / 100.0).alias("geo"),
        F.when((F.col("c_mktsegment") != "HOUSEHOLD") & (balance > 500), balance / 200.0).alias("workforce"),
    )
    score = F.when(F.col("row_type") == "STATE", composite_state(F.col("hhi_score"))).otherwise(
        composite_sector(F.col("geo"), F.col("workforce"))
    )
    scored = rows.withColumn("composite_risk_score", round_even(score, 6))
    return scored.select(
        "c_custkey",
        "row_type",
        "composite_risk_score",
        classify_tier(F.col("composite_risk_score")).alias("risk_tier"),
    )


# --- views over the segments --------------------------------------------------


@query
def filtered_view(spark, sf_dir):
    view = explore.filtered_view(facts.segments(spark, sf_dir), ["High", "Medium", "Low"], minimum=20.0)
    return explore.display_view(view)


@query
def filtered_view_states(spark, sf_dir):
    view = explore.filtered_view(facts.segments(spark, sf_dir), explore.TIERS, "STATE")
    return view.select("state", "composite_risk_score", "risk_tier")


@query
def dashboard_kpis(spark, sf_dir):
    return rounded(explore.kpis(facts.segments(spark, sf_dir)), 6)


@query
def state_map(spark, sf_dir):
    return explore.state_map(facts.segments(spark, sf_dir))


@query
def default_selection(spark, sf_dir):
    return explore.default_selection(facts.segments(spark, sf_dir)).select(
        "state", "composite_risk_score", "risk_tier"
    )


@query
def panel_selection(spark, sf_dir):
    segments = facts.segments(spark, sf_dir)
    return explore.panel_metrics(explore.panel_row(segments, picked=("NAICS", None, "336411")))


@query
def panel_metrics(spark, sf_dir):
    return explore.panel_metrics(facts.segments(spark, sf_dir))


@query
def sector_cards(spark, sf_dir):
    return explore.sector_cards(facts.segments(spark, sf_dir))


# --- chart data sets ----------------------------------------------------------


@query
def top20_states(spark, sf_dir):
    return eda.top_states(facts.segments(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return rounded(eda.score_distribution(facts.segments(spark, sf_dir)))


@query
def price_histogram(spark, sf_dir):
    return rounded(totals.histogram(table(spark, sf_dir, "orders"), "o_totalprice"))


@query
def sector_heatmap(spark, sf_dir):
    return eda.heatmap_cells(facts.segments(spark, sf_dir))


@query
def value_against_risk(spark, sf_dir):
    return eda.value_against_risk(facts.segments(spark, sf_dir))


@query
def annotated_states(spark, sf_dir):
    return eda.annotated_states(facts.segments(spark, sf_dir)).select(
        "rank", "state", "total_contract_value", "composite_risk_score"
    )


@query
def eda_summary(spark, sf_dir):
    return rounded(eda.summary(facts.segments(spark, sf_dir)))


@query
def tier_counts(spark, sf_dir):
    return totals.category_counts(facts.segments(spark, sf_dir), "row_type", "risk_tier")


@query
def score_coverage(spark, sf_dir):
    """Distinct keys and known scores."""
    return facts.segments(spark, sf_dir).agg(
        F.count_distinct("state").alias("states"),
        F.count_distinct("naics_code").alias("industries"),
        F.count("hhi_score").alias("with_hhi"),
        F.count("geo_risk_score").alias("with_geo"),
        F.count("workforce_risk_score").alias("with_workforce"),
    )


# --- source summaries ---------------------------------------------------------


@query
def award_grand_total(spark, sf_dir):
    return summaries.grand_totals(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query
def top_recipients(spark, sf_dir):
    per_recipient = (
        facts.award_parts(spark, sf_dir).groupBy("recipient_name").agg(F.sum("award_cents").alias("value"))
    )
    totals_ = per_recipient.select("recipient_name", dollars(F.col("value")).alias("total_value"))
    return summaries.rank_totals(totals_, ["recipient_name"], 5)


@query
def top_destinations(spark, sf_dir):
    """Buyer nations by order value, summed per customer before the join."""
    per_customer = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(cents(F.col("o_totalprice"))).alias("value"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    keys = ["n_nationkey", "n_name"]
    per_nation = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(*keys)
        .agg(dollars(F.sum("value")).alias("total_value"))
    )
    return summaries.rank_totals(per_nation, keys, 10)


@query
def largest_awards(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = ranking.descending("l_extendedprice", "l_orderkey", "l_linenumber")
    return ranking.top_k(items, 100, order, rank="rank")


@query
def ranked_orders(spark, sf_dir):
    """Ordinal of every order by price, without a single-task window."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.number_rows(orders, ranking.descending("o_totalprice", "o_orderkey"))


@query
def fiscal_year_totals(spark, sf_dir):
    """Orders of two statuses and four priorities in fiscal years 1997-1999."""
    orders = table(spark, sf_dir, "orders")
    scope = filters.in_award_scope(
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        F.col("o_orderdate"),
        ["F", "O"],
        ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"],
        [year - 25 for year in AWARD_FISCAL_YEARS],
    )
    return (
        orders.where(scope)
        .groupBy(fiscal_year(F.col("o_orderdate")).cast("long").alias("fiscal_year"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            dollars(F.sum(cents(F.col("o_totalprice")))).alias("total_value"),
            F.min("o_orderdate").cast("date").cast("string").alias("first_day"),
            F.max("o_orderdate").cast("date").cast("string").alias("last_day"),
        )
    )


# --- briefs -------------------------------------------------------------------


@query
def brief_selection(spark, sf_dir):
    """The selection with the place of each brief; its rows are ten and the industries."""
    batch = briefs.select_batch(facts.segments(spark, sf_dir), 10)
    place = F.row_number().over(
        Window.partitionBy("branch").orderBy(
            F.when(F.col("branch") == 0, F.col("composite_risk_score")).desc_nulls_last(), *scoring.canonical_keys()
        )
    )
    return whole_numbers(
        briefs.identified(batch.withColumn("place", place), strict=True).select(
            "branch", "place", "identifier", "composite_risk_score", "risk_tier"
        )
    )


@query
def cache_split(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return keyed.split_by_existing(documents, table(spark, sf_dir, "labels"), "doc_id", "cached").select(
        "doc_id", "lang", F.col("cached").cast("long").alias("cached")
    )


@query
def cache_todo(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return keyed.only_new(documents, table(spark, sf_dir, "labels"), "doc_id")


@query
def segment_prompts(spark, sf_dir):
    return briefs.prompts(facts.segments(spark, sf_dir))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry briefs exist; state briefs are new, their token count the award count."""
    table_ = facts.segments(spark, sf_dir)
    segments = briefs.identified(table_)
    day, later = (F.lit(f"2024-01-31 10:20:30{f}Z").cast("timestamp") for f in ("", ".25"))
    existing = segments.where(F.col("row_type") == "NAICS").select("identifier", day.alias("modified_at"))
    written = segments.where(F.col("row_type") == "STATE").select(
        "identifier", F.col("recipient_count").alias("tokens_used"), later.alias("generated_at")
    )
    batch = briefs.select_batch(table_, 10)
    return briefs.manifest(batch, existing, written)


@query
def brief_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


@query
def token_usage(spark, sf_dir):
    return briefs.token_usage(_manifest(spark, sf_dir))


@query
def metric_panel(spark, sf_dir):
    return briefs.metric_panel(facts.segments(spark, sf_dir))


@query
def text_fold(spark, sf_dir):
    return briefs.clean_texts(table(spark, sf_dir, "pages").select("page_id", "html"), "html")


def _marked_text() -> Column:
    """Every marker and every folded character, around columns of the document and its text."""
    lines = [
        F.concat(F.lit("# "), "source"),
        F.concat(F.lit("##  "), "lang", F.lit(" \u2013 part\u00a0one ")),
        F.concat(F.lit("- "), "source", F.lit(" a--b a---b")),
        F.concat(F.lit(" \u2022 \u201cquoted\u201d \u2018"), "lang", F.lit("\u2019 ")),
        F.concat(F.lit("* more\u2026 \u2014 __"), "lang", F.lit("__")),
        F.concat(F.lit("### "), "lang"),
        F.lit(" \u00a0"),
        F.lit("-"),
        F.col("text"),
    ]
    return F.concat_ws("\n", *lines)


@query
def cleaned_lines(spark, sf_dir):
    """Fold, then classify, as one job."""
    documents = table(spark, sf_dir, "documents").select("doc_id", _marked_text().alias("text"))
    return briefs.document_lines(briefs.clean_texts(documents, "text"), "doc_id", "text")


@query
def line_classes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return briefs.document_lines(documents, "doc_id", "text")


# --- selection, periods, sketches, layout ------------------------------------------


@query
def median_price_by_nation(spark, sf_dir):
    """Exact median of every nation's prices, whatever its number of items."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rounded(selection.quantiles(joined, "s_nationkey", "l_extendedprice").withColumnRenamed("quantile", "median_price"))


@query
def scope_totals(spark, sf_dir):
    """Awards in a period of its own for every order, up to a year and a month long, overlapping at will."""
    orders = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("date")
    periods = orders.select(
        "o_orderkey", start.alias("starts"), F.date_add(start, F.pmod("o_custkey", F.lit(400)).cast("int")).alias("ends")
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day"), cents(F.col("l_extendedprice")).alias("price")
    )
    sums = {"award_count": F.lit(1), "total": F.col("price")}
    found = intervals.sums_by_period(items, "day", periods, "o_orderkey", "starts", "ends", sums)
    return found.select(
        "o_orderkey", F.coalesce("award_count", F.lit(0)).alias("award_count"), dollars(F.col("total")).alias("total_value")
    )


@query
def fiscal_scope_pairs(spark, sf_dir):
    """Every award with every fiscal year and every half of one that contains it, from a table of periods."""
    years = [(f"FY{y}", f"{y - 1}-10-01", f"{y}-09-30") for y in range(1995, 2003)]
    halves = [(f"H{y}", f"{y - 1}-10-01", f"{y}-03-31") for y in range(1995, 2003)]
    periods = values_table(spark, ["scope", "starts", "ends"], [*years, *halves])
    periods = periods.withColumns({c: F.col(c).cast("date") for c in ("starts", "ends")})
    awards = facts.awards(spark, sf_dir)
    pairs = intervals.within_periods(awards, "start_date", periods, "starts", "ends")
    return pairs.groupBy("scope").agg(F.count(F.lit(1)).alias("row_count"), dollars(F.sum(cents(F.col("award_amount")))).alias("total_value"))


@query
def merged_distinct_suppliers(spark, sf_dir):
    """Suppliers by nation and year as stored sketches, merged up to nations, regions and all."""
    path = scratch_path(spark, "sketches")
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    joined = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    sketches.sketch(joined, ["n_regionkey", "n_name", "year"], "l_suppkey").write.parquet(path)
    kept = spark.read.schema("n_regionkey int, n_name string, year int, sketch binary").parquet(path)
    levels = []
    for keys in (["n_regionkey", "n_name", "year"], ["n_regionkey", "n_name"], ["n_regionkey"], []):
        merged = sketches.estimate(sketches.merge(kept, keys), "suppliers")
        levels.append(merged.select(F.lit(len(keys)).alias("depth"), *keys, "suppliers", "is_exact"))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
    return union.select("depth", "n_regionkey", "n_name", "year", F.round("suppliers").cast("long").alias("suppliers"), "is_exact")


@query
def laid_out_awards(spark, sf_dir):
    """Awards written along a curve over state, year and recipient; three scans, each by one of them."""
    path = scratch_path(spark, "curve")
    awards = facts.awards(spark, sf_dir).withColumn("year", F.year("start_date"))
    layout.along_curve(awards, ["state", "year", "recipient_name"]).write.parquet(path)
    kept = spark.read.schema(awards.schema).parquet(path)
    scans = {
        "state": kept.where(F.col("state") == "WI"),
        "year": kept.where(F.col("year") == 1997),
        "recipient": kept.where(F.col("recipient_name") == "Supplier#000000007"),
        "none": kept.where(F.col("state").isNull()),
    }
    counted = [
        rows.agg(F.count(F.lit(1)).alias("row_count"), dollars(F.sum(cents(F.col("award_amount")))).alias("total_value")).withColumn("scan", F.lit(name))
        for name, rows in scans.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# --- landed responses ---------------------------------------------------------


def _award_pages(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Pages of one record each; amounts are text, some of them unreadable."""
    items = table(spark, sf_dir, "lineitem")
    unreadable = facts.element_of(["n/a", "NaN", "inf", "1e400", "5d", "1e20"], F.col("l_orderkey"))
    amount = F.when(F.col("l_discount") == 0.1, unreadable).otherwise(
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    )
    record = F.struct(
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("Recipient Name"),
        amount.alias("Award Amount"),
        F.col("l_returnflag").alias("Place of Performance State Code"),
        F.lit(None).cast("string").alias("NAICS Code"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Start Date"),
        F.col("l_linenumber").alias("Internal Id"),
    )
    return items.select(F.to_json(F.array(record)).alias("body"), *keep)


@query
def ingest_awards(spark, sf_dir):
    parsed = landed.parse_awards(_award_pages(spark, sf_dir))
    return (
        parsed.groupBy("state", "naics_code")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("award_amount").alias("amount_count"),
            dollars(F.sum(cents(F.col("award_amount")))).alias("total_value"),
            F.count_distinct("recipient_name").alias("recipients"),
            F.min("start_date").cast("string").alias("first_start"),
            F.max("start_date").cast("string").alias("last_start"),
        )
    )


def _trade_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header-row matrix per priority and year, with region and world totals added.

    A matrix has one row per nation, region, bloc and the world, and one with
    an unreadable value: 33 rows at most.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    per_customer = orders.groupBy(
        "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year")
    ).agg(F.sum(cents(F.col("o_totalprice"))).alias("value"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    per_nation = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("o_orderpriority", "year", "c_nationkey")
        .agg(F.sum("value").alias("value"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    region = F.concat(F.col("n_regionkey").cast("string"), F.lit("XXX"))
    country = F.concat(F.lit("1"), pad_left(F.col("n_nationkey").cast("string"), 3))
    place = F.inline(
        F.array(
            F.struct(country.alias("code"), F.col("n_name").alias("name")),
            F.struct(region.alias("code"), F.lit("REGION").alias("name")),
            F.struct(F.lit("-").alias("code"), F.lit("WORLD").alias("name")),
            F.struct(F.lit("0022").alias("code"), F.lit("BLOC").alias("name")),
            F.struct(F.lit("1999").alias("code"), F.lit("UNREADABLE").alias("name")),
        )
    )
    cells = (
        per_nation.select("o_orderpriority", "year", "value", place)
        .groupBy("o_orderpriority", "year", "code", "name")
        .agg(F.rint(dollars(F.sum("value"))).cast("long").cast("string").alias("value"))
        .withColumn("value", F.when(F.col("code") == "1999", "1e20").otherwise(F.col("value")))
    )
    code = F.substring("o_orderpriority", 1, 1)
    product = F.concat(F.lit("880"), code)
    period = F.concat(F.col("year").cast("string"), F.lit("-12"))
    row = F.array("code", "name", "value", product, F.col("o_orderpriority"), product, period)
    header = F.array(
        *[F.lit(h) for h in ["CTY_CODE", "CTY_NAME", "ALL_VAL_YR", "E_COMMODITY", "E_COMMODITY_LDESC", "E_COMMODITY", "time"]]
    )
    matrices = cells.groupBy("o_orderpriority", "year").agg(F.collect_list(row).alias("rows"))
    bodies = matrices.select(F.to_json(F.concat(F.array(header), F.col("rows"))).alias("body"))
    empty = matrices.select(F.lit("").alias("body"))
    return bodies.unionByName(empty)


@query
def ingest_trade(spark, sf_dir):
    rows = landed.trade_matrix(_trade_matrices(spark, sf_dir))
    scope = filters.in_trade_scope(
        F.col("hs_code"), F.col("period"), ["8801", "8802", "8804", "8805"], ["1996-12", "1998-12", "2000-12"]
    )
    return whole_numbers(landed.clean_trade(rows.where(scope)))


def _series_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested answer per part type; a series holds one entry per month and three unreadable ones."""
    monthly = facts.monthly_quantity(spark, sf_dir)
    month = F.format_string("M%02d", "month")
    entry = F.struct(
        F.col("year").cast("string").alias("year"),
        month.alias("period"),
        F.date_format(F.make_date("year", "month", F.lit(1)), "MMMM").alias("periodName"),
        round_even(F.col("value"), 4).cast("string").alias("value"),
    )
    broken = F.array(
        *[
            F.struct(F.lit("1990").alias("year"), F.lit(m).alias("period"), F.lit(n).alias("periodName"), F.lit(v).alias("value"))
            for m, n, v in (("M01", "January", "NaN"), ("M02", "February", "5d"), ("M03", "March", "1e400"))
        ]
    )
    names = mapping_table(spark, facts.SERIES_OF_TYPE, "p_type", "series_id")
    per_series = monthly.groupBy("p_type").agg(F.concat(F.collect_list(entry), broken).alias("data")).join(names, "p_type", "left")
    response = F.struct(
        F.lit(landed.SUCCESS).alias("status"),
        F.array().cast("array<string>").alias("message"),
        F.struct(
            F.array(F.struct(F.coalesce("series_id", "p_type").alias("seriesID"), F.col("data"))).alias("series")
        ).alias("Results"),
    )
    return per_series.select(F.to_json(response).alias("body"))


@query
def ingest_employment(spark, sf_dir):
    parsed = landed.chronological(landed.parse_employment(_series_responses(spark, sf_dir)))
    return whole_numbers(parsed)


def _damaged(body: Column) -> Column:
    """A body cut short, as a broken transfer leaves it."""
    return F.left(body, F.length(body) - 3)


@query
def ingest_rejects(spark, sf_dir):
    """Damaged responses among intact ones: what is rejected, and the records of the others."""
    line = F.col("l_linenumber")
    pages = _award_pages(spark, sf_dir, "l_linenumber")
    pages = pages.withColumn(
        "body",
        F.when(line == 7, _damaged(F.col("body")))
        .when(line == 6, '{"detail": "too many requests"}')
        .when(line == 5, "<html>busy</html>")
        .when(line == 4, " ")
        .otherwise(F.col("body")),
    ).select("body")
    pages = stored(pages, "pages")
    matrices = stored(_trade_matrices(spark, sf_dir), "matrices")
    matrices = matrices.unionByName(landed.non_empty(matrices).select(_damaged(F.col("body")).alias("body")))
    answers = stored(_series_responses(spark, sf_dir), "answers")
    answers = answers.unionByName(
        answers.select(F.replace("body", F.lit(landed.SUCCESS), F.lit("REQUEST_FAILED")).alias("body"))
    )
    sources = (
        ("awards", pages, landed.parse_awards),
        ("trade", matrices, landed.parse_trade),
        ("employment", answers, landed.parse_employment),
    )
    counts = []
    for kind, bodies, parse in sources:
        rejected = totals.category_counts(landed.rejects(bodies, kind), "kind", "reason")
        records = parse(bodies, strict=False).agg(F.count(F.lit(1)).alias("row_count"))
        counts += [rejected, records.select(F.lit(kind).alias("kind"), F.lit("read").alias("reason"), "row_count")]
    return reduce(DataFrame.unionByName, counts)


@query
def landed_folder(spark, sf_dir):
    """One file per response in a folder, read as whole texts."""
    path = scratch_path(spark, "landed")
    bodies = landed.non_empty(_trade_matrices(spark, sf_dir))
    bodies.withColumn("name", F.sha1("body")).repartition("name").write.partitionBy("name").text(path)
    parsed = landed.parse_trade(landed.read_bodies(spark, path))
    return parsed.groupBy("hs_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("export_value").alias("export_value")
    )


@query
def series_guard(spark, sf_dir):
    """Employment of the series that industries rely on; a missing one would stop the job."""
    employment = facts.employment(spark, sf_dir)
    found = workforce.require_series(employment, series_crosswalk(spark))
    known = found.join(series_crosswalk(spark), "series_id")
    return known.groupBy("series_id", "naics_code").agg(F.count(F.lit(1)).alias("months"))


# --- sinks, written and read back ----------------------------------------------


@query
def raw_landing(spark, sf_dir):
    """Responses to the raw layer and back, unchanged, then parsed."""
    path = scratch_path(spark, "raw")
    sinks.write_raw(_trade_matrices(spark, sf_dir), path)
    bodies = spark.read.schema("body string").json(path)
    parsed = landed.parse_trade(bodies)
    return parsed.groupBy("hs_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("export_value").alias("export_value")
    )


@query
def clean_csv(spark, sf_dir):
    """Silver awards as CSV and back, also as plain text columns."""
    path = scratch_path(spark, "awards-csv")
    sinks.write_clean_csv(facts.awards(spark, sf_dir), path)
    typed = tables.read_awards(spark, path)
    return typed.groupBy("state").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("recipient_name").alias("named"),
        dollars(F.sum(cents(F.col("award_amount")))).alias("total_value"),
        F.max("start_date").cast("string").alias("last_start"),
    )


@query
def clean_csv_text(spark, sf_dir):
    path = scratch_path(spark, "awards-text")
    sinks.write_clean_csv(facts.awards(spark, sf_dir), path)
    text = tables.read_csv_text(spark, path, AWARDS)
    return totals.category_counts(text, "start_date")


@query
def foreign_csv(spark, sf_dir):
    """Files of another writer: line feeds and quotes in fields, columns in a file's own order, all fields quoted."""
    path = scratch_path(spark, "foreign-csv")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.to_json(F.struct("source", "lang")).alias("made"), F.col("lang").eqNullSafe("en").alias("first")
    )
    options = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.where("first").select("doc_id", "text", "made").write.options(**options).csv(f"{path}/a")
    rows.where("NOT first").select("made", "text", F.lit("x").alias("other"), "doc_id").write.options(**options).csv(f"{path}/b")
    read = delimited.read_delimited(spark, [f"{path}/a", f"{path}/b"], ["doc_id", "text", "made"])
    return read.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.get_json_object("made", "$.source").alias("source"),
        F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("line_feeds"),
    )


@query
def stored_segments(spark, sf_dir):
    """Stored table, then a scan with projection and predicate."""
    path = scratch_path(spark, "segments")
    sinks.write_segments(facts.segments(spark, sf_dir), path)
    return tables.read_segments(
        spark, path, ["naics_code", "geo_risk_score", "workforce_risk_score"], F.col("row_type") == "NAICS"
    )


@query
def rescored_segments(spark, sf_dir):
    """A stored table scored without the latest shipments and events, then each dimension scored anew by key."""
    path = scratch_path(spark, "kept-segments")
    parts, trade, yearly = facts.stored_reduced(spark, sf_dir)
    last = yearly.agg(F.max("year")).scalar()
    early = stored(geographic.destination_totals(facts.trade(spark, sf_dir).where(F.col("hs_code") != "8802")), "early-trade")
    first = scoring.score_stepwise(parts.where(F.col("recipient_name").isNotNull()), early, yearly.where(F.col("year") < last))
    rescoring.keep_segments(first, path, buckets=16)
    rescoring.rescore_workforce(spark, path, yearly)
    rescoring.rescore_geographic(spark, path, trade)
    rescoring.rescore_concentration(spark, path, concentration.state_profile(parts))
    return scoring.exported(scoring.canonical(keyed_store.read(spark, path)))


@query
def running_concentration(spark, sf_dir):
    """Concentration by state, kept up to date over three batches of awards by year."""
    path = scratch_path(spark, "running")
    running.start(spark, path, buckets=16)
    awards = facts.awards(spark, sf_dir)
    year = F.coalesce(F.year("start_date"), F.lit(0))
    for name, batch in {"early": year < 1997, "middle": year.between(1997, 1998), "late": year > 1998}.items():
        running.apply_batch(spark, path, concentration.award_parts(awards.where(batch)), name)
    return rounded(running.profile(spark, path))


def _award_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named responses of many records each, of one line number.

    A response holds records of 32,768 consecutive rows at most, so more rows make more responses, not longer ones.
    """
    pages = _award_pages(spark, sf_dir, "l_linenumber")
    stretch = F.shiftright(F.monotonically_increasing_id(), 15)
    bundle = F.concat(F.col("l_linenumber").cast("string"), F.lit("-"), stretch.cast("string"))
    inner = F.substring(F.col("body"), F.lit(2), F.length("body") - 2)
    return (
        pages.select(bundle.alias("name"), inner.alias("record"))
        .groupBy("name")
        .agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("record")), ","), F.lit("]")).alias("body"))
    )


@query
def delivered_awards(spark, sf_dir):
    """Award pages in three deliveries: some are sent again, some of them corrected; each counts once, as last sent."""
    path, store = scratch_path(spark, "deliveries"), scratch_path(spark, "delivered")
    with shuffles_freed(spark):
        bodies = stored(_award_bundles(spark, sf_dir), "bundles", path, **LONG_ROWS, compression="zstd", maxRecordsPerFile="16")
    wrong = F.replace("body", F.lit("Supplier"), F.lit("Suplier"))
    first, late = F.col("name").startswith("1-"), F.col("name") >= "4"
    deliveries = (
        bodies.where(~late).withColumn("body", F.when(first, wrong).otherwise(F.col("body"))),
        bodies.where(late | F.col("name").startswith("2-")),
        bodies.where(first | F.col("name").startswith("5-")),
    )
    for n, sent in enumerate(deliveries):
        # A bundle is one row, so each name gets one file. A delivery is deleted once it is landed.
        sent.write.partitionBy("name").text(f"{path}/{n}", compression="gzip")
        ledger.land(spark, f"{path}/{n}", store, "awards", lambda file: F.regexp_extract(file, "name=([^/]+)/", 1), buckets=16)
        versions.delete(spark, f"{path}/{n}")
    versions.delete(spark, path)
    parsed = ledger.records(spark, store)
    return parsed.groupBy("state").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("award_amount").alias("amount_count"),
        dollars(F.sum(cents(F.col("award_amount")))).alias("total_value"),
        F.count_distinct("recipient_name").alias("recipients"),
    )


@query
def replaced_versions(spark, sf_dir):
    """A frame read before a replacement keeps its version, one read after it sees the new one."""
    path = scratch_path(spark, "versions")
    segments = facts.segments(spark, sf_dir)
    sinks.write_segments(segments.where("row_type = 'NAICS'"), path)
    before = tables.read_segments(spark, path, ["row_type", "risk_tier"])
    sinks.write_segments(segments, path)
    after = tables.read_segments(spark, path, ["row_type", "risk_tier"])
    both = before.withColumn("version", F.lit("first")).unionByName(after.withColumn("version", F.lit("second")))
    return totals.category_counts(both, "version", "row_type", "risk_tier")


@query
def exported_segments(spark, sf_dir):
    path = scratch_path(spark, "segments-csv")
    sinks.export_segments(facts.segments(spark, sf_dir), path)
    return tables.read_segments_csv(spark, path)


@query
def exported_view(spark, sf_dir):
    path = scratch_path(spark, "view-csv")
    sinks.write_view_csv(explore.filtered_view(facts.segments(spark, sf_dir), ["High"]), path)
    headings = StructType(
        [
            StructField(name, StringType() if i in (0, 1, 2, 4) else DoubleType())
            for i, name in enumerate(explore.DISPLAY_NAMES.values())
        ]
    )
    return tables.read_csv(spark, path, headings)


@query
def brief_store(spark, sf_dir):
    """Briefs by key: all are written, the industries' are replaced, then all are loaded."""
    path = scratch_path(spark, "briefs")
    prompts = briefs.prompts(facts.segments(spark, sf_dir))
    first = prompts.select("identifier", F.col("label").alias("brief_text"))
    sinks.write_briefs(first.where(F.col("label") != "STATE WY"), path)
    again = prompts.where(F.col("label").startswith("NAICS")).select(
        "identifier", F.concat(F.lit("second "), "label").alias("brief_text")
    )
    sinks.write_briefs(again, path)
    stored = tables.read_brief_store(spark, path).drop("modified_at")
    return tables.load_briefs(prompts.select("identifier"), stored)


@query
def brief_files(spark, sf_dir):
    """A folder of briefs as text files, one per segment, joined to the segments; two files are missing."""
    path = scratch_path(spark, "brief-files")
    prompts = briefs.prompts(facts.segments(spark, sf_dir)).select("identifier", "label", "prompt")
    texts = prompts.where(~F.col("label").isin("STATE WY", "STATE AK")).select("identifier", "prompt")
    texts.repartition("identifier").write.partitionBy("identifier").text(path, lineSep="\n")
    versions.name_files(spark, path, ".txt")
    found = tables.load_briefs(prompts.select("identifier"), tables.read_briefs(spark, path))
    return found.select("identifier", F.md5("brief_text").alias("brief_md5"), F.length("brief_text").cast("long").alias("n_chars"))


@query
def brief_lookup(spark, sf_dir):
    """All documents as briefs in one store, those with a supplier's number written again, then some found by identifier."""
    path = scratch_path(spark, "brief-lookup")
    name = F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("identifier")
    sinks.write_briefs(table(spark, sf_dir, "documents").select(name, F.col("text").alias("brief_text")), path, buckets=16)
    suppliers = table(spark, sf_dir, "supplier")
    numbered = lambda n: F.concat(F.lit("D"), n.cast("string")).alias("identifier")
    sinks.write_briefs(suppliers.select(numbered(F.col("s_suppkey")), F.col("s_name").alias("brief_text")), path)
    wanted = suppliers.select(numbered(F.col("s_suppkey") * 3))
    return tables.find_briefs(spark, path, wanted).select("identifier", F.md5("brief_text").alias("brief_md5"))


@query
def manifest_array(spark, sf_dir):
    """The manifest as files that hold one JSON array each, one per kind of row."""
    path = scratch_path(spark, "manifest-array")
    record = F.struct(*MANIFEST.names)
    arrays = _manifest(spark, sf_dir).groupBy("row_type").agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.repartition("row_type").write.partitionBy("row_type").text(path)
    return briefs.manifest_listing(tables.read_manifest(spark, f"{path}/*", array_file=True))


@query
def manifest_file(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    sinks.write_manifest(_manifest(spark, sf_dir), path)
    return briefs.manifest_listing(tables.read_manifest(spark, path))
