"""Numbers and keys as text, in the three house styles.

``prompt_*`` write full figures, ``dashboard_*`` and ``report_*`` shorten money.
``format_number`` rounds half to even on the exact binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segrisk.functions.values import code_text, is_missing, strip

DASH = "—"


def _or(value: Column, text: Column, missing: str, kind: str = "double") -> Column:
    return F.when(is_missing(value, kind), F.lit(missing)).otherwise(text)


def _grouped(value: Column, decimals: int) -> Column:
    return F.format_number(value, decimals)


def _plain(value: Column, pattern: str = "0.00") -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def plain_number(value: Column) -> Column:
    """All digits of a double, without an exponent for everyday sizes."""
    everyday = (value == 0) | F.abs(value).between(1e-3, 1e15)
    return F.when(everyday, _plain(value, "0.0" + "#" * 16)).otherwise(value.cast("string"))


def _whole(value: Column) -> Column:
    """Fraction cut off, not rounded."""
    return F.format_number(value.cast("double").cast("long"), 0)


def _short_money(value: Column, units: list[tuple[float, str]], grouped: bool) -> Column:
    def figure(x: Column) -> Column:
        return _grouped(x, 2) if grouped else _plain(x)

    (size, sign), *rest = units
    text = F.when(value >= size, F.concat(F.lit("$"), figure(value / size), F.lit(sign)))
    for size, sign in rest:
        text = text.when(value >= size, F.concat(F.lit("$"), figure(value / size), F.lit(sign)))
    return text.otherwise(F.concat(F.lit("$"), _grouped(value, 0)))


# --- prompt style: missing is N/A ------------------------------------------


def prompt_number(value: Column, decimals: int = 2) -> Column:
    v = value.cast("double")
    return _or(v, _grouped(v, decimals), "N/A")


def prompt_int(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, _whole(v), "N/A")


def prompt_money(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, F.concat(F.lit("$"), _grouped(v, 0)), "N/A")


def prompt_text(value: Column) -> Column:
    return _or(value, strip(value), "N/A", "string")


def prompt_kind(row_type: Column) -> Column:
    return F.upper(prompt_text(row_type))


def prompt_any(value: Column, kind: str) -> Column:
    """Any column as text: digits written out, never in exponent form."""
    if kind == "double":
        return _or(value, plain_number(value), "N/A")
    return prompt_text(value.cast("string"))


# --- dashboard style --------------------------------------------------------


def dashboard_number(value: Column, decimals: int = 2) -> Column:
    v = value.cast("double")
    return _or(v, _grouped(v, decimals), DASH)


def dashboard_metric(value: Column, missing: str = "N/A", decimals: int = 2) -> Column:
    v = value.cast("double")
    return _or(v, _grouped(v, decimals), missing)


def dashboard_int(value: Column) -> Column:
    return prompt_int(value)


def dashboard_money(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, _short_money(v, [(1e9, "B"), (1e6, "M")], grouped=True), "N/A")


# --- report style: missing is n/a -------------------------------------------


def report_score(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, _plain(v), "n/a")


def report_int(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, _whole(v), "n/a")


def report_money(value: Column) -> Column:
    v = value.cast("double")
    return _or(v, _short_money(v, [(1e9, "B"), (1e6, "M"), (1e3, "K")], grouped=False), "n/a")


# --- identifiers and labels --------------------------------------------------


def segment_identifier(row_type: Column, state: Column, code: Column, strict: bool = False) -> Column:
    """State code or industry code of a row; without one: NULL, or an error if strict."""
    kind = F.upper(row_type)
    found = F.when((kind == "STATE") & ~is_missing(state, "string"), F.upper(strip(state))).when(
        (kind == "NAICS") & ~is_missing(code, "string"), code_text(code)
    )
    if not strict:
        return found
    problem = F.concat(F.lit("segment without identifier, row_type: "), F.coalesce(row_type, F.lit("NULL")))
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(problem))


def log_label(row_type: Column, state: Column, code: Column) -> Column:
    kind = F.upper(row_type)
    return (
        F.when(kind == "STATE", F.concat_ws(" ", F.lit("STATE"), state))
        .when(kind == "NAICS", F.concat_ws(" ", F.lit("NAICS"), code_text(code)))
        .when(F.coalesce(kind, F.lit("")) == "", "UNKNOWN")
        .otherwise(kind)
    )


def panel_label(row_type: Column, state: Column, code: Column, label: Column) -> Column:
    def blank(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    return F.when(row_type == "STATE", F.concat(F.lit("State: "), blank(state))).otherwise(
        F.concat(F.lit("NAICS "), blank(code_text(code)), F.lit(f" {DASH} "), blank(label))
    )


def report_title(row_type: Column, state: Column, code: Column, label: Column) -> Column:
    kind = F.upper(row_type)
    sector = F.concat(F.lit("NAICS "), code_text(code), F.lit(f" {DASH} "), F.coalesce(label, F.lit("")))
    return (
        F.when(kind == "STATE", F.concat(F.lit("State of "), state))
        .when(kind == "NAICS", F.rtrim(sector, F.lit(f" {DASH}")))
        .when(F.coalesce(kind, F.lit("")) == "", "UNKNOWN")
        .otherwise(kind)
    )
