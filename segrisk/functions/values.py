"""Coercion, missing values and key normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from segrisk.dims import VALID_STATES

# The characters that count as white space when text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


#: No number in the data is this large: sums of cents stay inside 64 bits.
TOO_LARGE = 9e16
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def strip_right(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def pad_left(text: Column, width: int, fill: str = "0") -> Column:
    """Filled up to ``width``; a longer text stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def finite(number: Column) -> Column:
    """NaN and infinities become NULL; NaN would otherwise outrank every number."""
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def parse_number(text: Column) -> Column:
    """Text to double, NULL where it is no plain number or too large to be summed.

    The pattern keeps out what only the JVM reads as a number (``5d``) and the
    words for NaN and infinity; the bound keeps out ``1e400``, which is read as
    infinity, and what no whole number of cents can hold.
    """
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(number) < TOO_LARGE), number)


def cents(amount: Column) -> Column:
    """Amount as a whole number of cents: exact sums, whatever the row order.

    Summing 64-bit integers stays in generated code, unlike wide decimals. A
    sum past 9.2e16 dollars stops with an overflow error, it never wraps.
    """
    return F.rint(finite(amount) * 100.0).cast("long")


def round_even(value: Column, digits: int = 2) -> Column:
    """Scaled to whole numbers, rounded with ties to even, scaled back."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def round_exact(value: Column, digits: int = 2) -> Column:
    """The decimal nearest to the exact binary value; only true ties go to even."""
    pattern = "0." + "0" * digits
    return F.call_function("format_number", value, F.lit(pattern)).cast("double")


def wide(total: Column) -> Column:
    """A total that is summed again over many groups: no overflow at any size."""
    return total.cast("decimal(20,0)")


def dollars(total_cents: Column) -> Column:
    return total_cents.cast("double") / 100.0


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def is_missing(value: Column, kind: str) -> Column:
    """NULL, NaN (for ``double``) or white space only (for ``string``)."""
    if kind == "double":
        return value.isNull() | F.isnan(value)
    if kind == "string":
        return value.isNull() | (strip(value) == "")
    return value.isNull()


def normalize_state(text: Column, valid: Sequence[str] = VALID_STATES) -> Column:
    """Valid code of any spelling, else NULL. Clean codes skip the costly trimming."""
    code = F.upper(strip(text))
    return F.when(text.isin(*valid), text).when(code.isin(*valid), code)


def month_of_period(period: Column) -> Column:
    """``M07`` -> 7."""
    return F.ltrim(period, F.lit("M")).try_cast("int")


def year_of_period(period: Column) -> Column:
    """``2022-12`` -> 2022."""
    return F.substring(period, 1, 4).try_cast("int")


def fiscal_year(date: Column) -> Column:
    """The fiscal year starts on 1 October of the year before."""
    return F.year(F.add_months(date, 3))


def clip(value: Column, low: float, high: float) -> Column:
    """Bounded value; stays NULL (``least``/``greatest`` alone would skip the NULL)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def iso_utc(moment: Column) -> Column:
    """ISO text in UTC, whatever the session's time zone; a zero fraction is left out.

    Counted from the epoch, since a detour over local time is ambiguous where
    clocks are set back and wrong where they are set forward.
    """
    micros = F.unix_micros(moment.cast("timestamp"))
    second, rest = F.floor(micros / F.lit(1_000_000).cast("decimal(20,0)")), F.pmod(micros, F.lit(1_000_000))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = (epoch + F.make_dt_interval(secs=second.cast("decimal(18,6)"))).cast("string")
    fraction = F.when(rest > 0, F.concat(F.lit("."), pad_left(rest.cast("string"), 6))).otherwise("")
    return F.concat(F.replace(utc, F.lit(" "), F.lit("T")), fraction, F.lit("+00:00"))


def code_text(code: Column) -> Column:
    """Industry code as plain digits, also where it was stored as ``336411.0``."""
    return F.regexp_replace(strip(code.cast("string")), r"\.0*$", "")
