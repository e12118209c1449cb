"""Explicit schemas. Codes are always strings; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


AWARDS = _struct(
    recipient_name=StringType(),
    award_amount=DoubleType(),
    state=StringType(),
    naics_code=StringType(),
    start_date=DateType(),
)

TRADE = _struct(
    hs_code=StringType(),
    hs_description=StringType(),
    country_code=StringType(),
    country_name=StringType(),
    export_value=LongType(),
    year=IntegerType(),
)

EMPLOYMENT = _struct(
    series_id=StringType(),
    year=IntegerType(),
    period=StringType(),
    period_name=StringType(),
    value=DoubleType(),
    series_label=StringType(),
)

SEGMENTS = _struct(
    row_type=StringType(),
    naics_code=StringType(),
    naics_label=StringType(),
    state=StringType(),
    total_contract_value=DoubleType(),
    recipient_count=LongType(),
    export_value=DoubleType(),
    employment_count=LongType(),
    hhi_score=DoubleType(),
    concentration_risk_label=StringType(),
    geo_risk_score=DoubleType(),
    workforce_risk_score=DoubleType(),
    composite_risk_score=DoubleType(),
    risk_tier=StringType(),
)

# Segments as they are kept: with the mark of a state that was added because no award names it.
SCORED = StructType([*SEGMENTS.fields, StructField("is_padded", BooleanType(), True)])

# Columns rounded to cents / hundredths when the table is exported.
ROUNDED_ON_EXPORT = [
    "total_contract_value",
    "export_value",
    "hhi_score",
    "geo_risk_score",
    "workforce_risk_score",
    "composite_risk_score",
]

MANIFEST = _struct(
    row_type=StringType(),
    state=StringType(),
    naics_code=StringType(),
    composite_risk_score=DoubleType(),
    risk_tier=StringType(),
    brief_file_path=StringType(),
    tokens_used=LongType(),
    generated_at=StringType(),
)
