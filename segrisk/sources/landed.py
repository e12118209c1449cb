"""Raw responses as they were landed, flattened to the three silver tables.

A landed response is one small text: a page of records, one header-row matrix,
or one nested time-series answer. A source is a folder of any number of them,
read in parallel as one DataFrame with the text in column ``body``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    StringType,
    StructField,
    StructType,
)

from segrisk.dims import SERIES_LABELS, mapping_table
from segrisk.functions.values import parse_number, strip, year_of_period
from segrisk.operators.filters import individual_destination
from segrisk.operators.shape import conform, entries, map_codes_or, rename, select_present, unique_headers
from segrisk.schemas import AWARDS, EMPLOYMENT, TRADE

# --- fixed values: field names in the responses -----------------------------

AWARD_FIELDS = {
    "Recipient Name": "recipient_name",
    "Award Amount": "award_amount",
    "Place of Performance State Code": "state",
    "NAICS Code": "naics_code",
    "Start Date": "start_date",
}
TRADE_FIELDS = {
    "E_COMMODITY": "hs_code",
    "E_COMMODITY_LDESC": "hs_description",
    "CTY_CODE": "country_code",
    "CTY_NAME": "country_name",
    "ALL_VAL_YR": "export_value",
    "time": "period",
}
OPTIONAL_TRADE_FIELDS = ["E_COMMODITY_LDESC"]
SUCCESS = "REQUEST_SUCCEEDED"

# ----------------------------------------------------------------------------


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


AWARD_RECORD = _strings(*AWARD_FIELDS)
SERIES_RESPONSE = StructType(
    [
        StructField("status", StringType()),
        StructField("message", ArrayType(StringType())),
        StructField(
            "Results",
            StructType(
                [
                    StructField(
                        "series",
                        ArrayType(
                            StructType(
                                [
                                    StructField("seriesID", StringType()),
                                    StructField(
                                        "data",
                                        ArrayType(_strings("year", "period", "periodName", "value")),
                                    ),
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)


def read_bodies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All responses of a folder; empty ones (no content) are skipped."""
    texts = spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")
    return non_empty(texts)


def non_empty(bodies: DataFrame) -> DataFrame:
    return bodies.where(strip(F.col("body")) != "")


def _intact(what: str, parsed: str, strict: bool) -> Column:
    """The parsed list of a body that is one.

    Anything else, such as a truncated page, an error object or a page of
    markup, stops the job, or is left out if not ``strict``; see ``rejects``.
    """
    problem = F.concat(F.lit(f"unreadable {what} response: "), F.left("body", F.lit(80)))
    damaged = F.raise_error(problem) if strict else F.lit(None)
    return F.when(_is_list(parsed), F.col(parsed)).otherwise(damaged)


def _is_list(parsed: str) -> Column:
    return F.col(parsed).isNotNull() & F.ltrim("body").startswith("[")


def rejects(bodies: DataFrame, kind: str) -> DataFrame:
    """Bodies of a source (awards, trade, employment) that cannot be read, with the reason."""
    found = non_empty(bodies)
    if kind == "employment":
        status = F.coalesce(F.from_json("body", SERIES_RESPONSE)["status"], F.lit("UNKNOWN"))
        reason = F.when(status != SUCCESS, F.concat(F.lit("status "), status))
    else:
        schema = ArrayType(AWARD_RECORD) if kind == "awards" else "array<array<string>>"
        found = found.withColumn("page", F.from_json("body", schema))
        reason = F.when(~_is_list("page"), "no list of records")
    return found.select(F.lit(kind).alias("kind"), reason.alias("reason"), "body").where(F.col("reason").isNotNull())


# --- awards ------------------------------------------------------------------


def read_award_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Folder of JSON arrays of records."""
    return clean_awards(spark.read.schema(AWARD_RECORD).json(path, multiLine=True))


def award_records(bodies: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Records of all pages, every field as text, with the columns ``keep`` of their page."""
    pages = non_empty(bodies).select("body", *keep, F.from_json("body", ArrayType(AWARD_RECORD)).alias("page"))
    return entries(pages, _intact("awards", "page", strict), *keep).select("entry.*", *keep)


def clean_awards(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Source names to ours, only our columns and ``keep``, amount and date by tolerant cast."""
    named = rename(records, AWARD_FIELDS)
    known = select_present(named, [*AWARDS.names, *keep])
    casts = {"award_amount": parse_number(F.col("award_amount").cast("string"))}
    if "start_date" in known.columns:
        casts["start_date"] = F.col("start_date").try_cast("date")
    return known.withColumns(casts)


def parse_awards(bodies: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    return clean_awards(award_records(bodies, strict, keep), keep)


# --- trade -------------------------------------------------------------------


def _cell(name: str, optional: bool) -> Column:
    """Cell under the header of that name, wherever the column stands; the second ``H`` is ``H_1``."""
    place = F.array_position("header", name)
    absent = F.lit(None).cast("string") if optional else F.raise_error(F.lit(f"no column {name} in response"))
    return F.when(place > 0, F.try_element_at("row", place.cast("int"))).otherwise(absent)


def trade_matrix(
    bodies: DataFrame,
    fields: Mapping[str, str] = TRADE_FIELDS,
    optional: Sequence[str] = OPTIONAL_TRADE_FIELDS,
    strict: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of all matrices by header name, everything as text.

    The first row of each response is its header; a repeated header name gets
    its number, so the plain name is its first place. Rows carry the columns ``keep`` of their response.
    """
    pages = non_empty(bodies).select("body", *keep, F.from_json("body", "array<array<string>>").alias("page"))
    matrices = pages.select(_intact("trade", "page", strict).alias("matrix"), *keep)
    rows = entries(
        matrices.withColumn("header", unique_headers(F.try_element_at("matrix", F.lit(1)))), F.col("matrix"), "header", *keep
    )
    rows = rows.where(F.col("position") > 0).withColumnRenamed("entry", "row")
    return rows.select(*[_cell(name, name in optional).alias(ours) for name, ours in fields.items()], *keep)


def _and_kept(schema: StructType, df: DataFrame, keep: Sequence[str]) -> StructType:
    return StructType([*schema.fields, *[df.schema[k] for k in keep]])


def clean_trade(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Single countries only, value as whole number (NULL if suppressed), year from the period."""
    single = rows.where(individual_destination(F.col("country_code")))
    typed = single.withColumns(
        {
            "export_value": parse_number(F.col("export_value")).try_cast("long"),
            "year": year_of_period(F.col("period")),
        }
    )
    return conform(typed, _and_kept(TRADE, typed, keep))


def parse_trade(bodies: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    return clean_trade(trade_matrix(bodies, strict=strict, keep=keep), keep)


# --- employment --------------------------------------------------------------


def series_observations(bodies: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Nested answers flattened twice. A failed answer stops the job with its messages, or is left out.

    The check is part of the column that is read on, so it cannot be optimised away.
    """
    answers = non_empty(bodies).select(F.from_json("body", SERIES_RESPONSE).alias("r"), *keep)
    status = F.coalesce("r.status", F.lit("UNKNOWN"))
    problem = F.concat(
        F.lit("response status "), status, F.lit(": "), F.coalesce(F.array_join("r.message", "; "), F.lit(""))
    )
    failed = F.raise_error(problem) if strict else F.lit(None)
    series = F.when(status == SUCCESS, F.col("r.Results.series")).otherwise(failed)
    one = entries(answers, series, *keep).select(
        F.col("entry.seriesID").alias("series_id"), F.col("entry.data").alias("data"), *keep
    )
    return entries(one, F.col("data"), "series_id", *keep).select(
        "series_id",
        *keep,
        F.col("entry.year").try_cast("int").alias("year"),
        F.col("entry.period").alias("period"),
        F.col("entry.periodName").alias("period_name"),
        parse_number(F.col("entry.value")).alias("value"),
    )


def parse_employment(
    bodies: DataFrame, labels: Mapping[str, str] = SERIES_LABELS, strict: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed observations with the series title, or the series id where it has none."""
    names = mapping_table(bodies.sparkSession, labels, "series_id", "series_label")
    labelled = map_codes_or(series_observations(bodies, strict, keep), names, "series_id", "series_label", F.col("series_id"))
    return conform(labelled, _and_kept(EMPLOYMENT, labelled, keep))


def chronological(employment: DataFrame) -> DataFrame:
    """Ordered output; only needed where a reader wants the rows in order."""
    return employment.orderBy("series_id", "year", "period")
