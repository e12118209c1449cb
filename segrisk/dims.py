"""Reference dimensions: fixed values and the small DataFrames built from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# --- fixed values ---------------------------------------------------------

# Industry codes and their titles.
NAICS_LABELS = {
    "336411": "Aircraft Manufacturing",
    "336412": "Aircraft Engine & Engine Parts Manufacturing",
    "336413": "Other Aircraft Parts & Equipment Manufacturing",
    "336414": "Guided Missile & Space Vehicle Manufacturing",
    "336415": "Guided Missile & Space Vehicle Propulsion Unit Manufacturing",
    "336419": "Other Guided Missile & Space Vehicle Parts Manufacturing",
}

# Short sector names for cards.
SECTOR_SHORT_NAMES = {
    "336411": "Aircraft Mfg",
    "336412": "Engines & Parts",
    "336413": "Other Aircraft Parts",
    "336414": "Missiles & Space",
}

# Traded product code -> industry code. 8803 is requested but has no industry.
HS_TO_NAICS = {
    "8801": "336411",
    "8802": "336411",
    "8804": "336413",
    "8805": "336414",
}
REQUESTED_HS_CODES = ["8801", "8802", "8803", "8804", "8805"]
REQUESTED_PERIODS = ["2022-12", "2023-12", "2024-12"]

# Employment series -> industry code and title.
SERIES_TO_NAICS = {
    "CEU3133641101": "336411",
    "CEU3133641201": "336412",
    "CEU3133641301": "336413",
}
SERIES_LABELS = {
    "CEU3133641101": "Aircraft Manufacturing",
    "CEU3133641201": "Aircraft Engine & Engine Parts",
    "CEU3133641301": "Other Aircraft Parts & Auxiliary Equipment",
}

# The 50 states that must always have a row, and the further codes accepted.
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
OTHER_JURISDICTIONS = ["DC", "PR", "GU", "VI"]
VALID_STATES = US_STATES + OTHER_JURISDICTIONS

# Award scope: contract types, industries and fiscal years.
AWARD_TYPES = ["A", "B", "C", "D"]
AWARD_FISCAL_YEARS = [2022, 2023, 2024]

# --- DataFrames -----------------------------------------------------------


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def values_table(spark: SparkSession, columns: list[str], rows: Iterable[tuple]) -> DataFrame:
    """Constant rows as a local relation, whose exact size the planner knows.

    Because the size is known, joins against it become broadcast joins without
    a hint, and the planner can fold it away entirely when it is empty.
    """
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def mapping_table(spark: SparkSession, mapping: Mapping, key: str, value: str) -> DataFrame:
    return values_table(spark, [key, value], mapping.items())


def naics_labels(spark: SparkSession) -> DataFrame:
    return mapping_table(spark, NAICS_LABELS, "naics_code", "naics_label")


def hs_crosswalk(spark: SparkSession) -> DataFrame:
    return mapping_table(spark, HS_TO_NAICS, "hs_code", "naics_code")


def series_crosswalk(spark: SparkSession) -> DataFrame:
    return mapping_table(spark, SERIES_TO_NAICS, "series_id", "naics_code")


def required_states(spark: SparkSession) -> DataFrame:
    return values_table(spark, ["state"], [(s,) for s in US_STATES])
