"""Predicates as Columns, and the filters that need more than one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def individual_destination(code: Column) -> Column:
    """Keeps single countries: no world total, no region (``5XXX``), no bloc (``00..``)."""
    return code.isNotNull() & (code != "-") & ~code.contains("X") & ~code.startswith("00")


def in_tiers(tier: Column, tiers: Sequence[str]) -> Column:
    """Nothing selected means no rows."""
    return tier.isin(*tiers) if tiers else F.lit(False)


def at_least(score: Column, minimum: float) -> Column:
    """A missing score counts as 0."""
    return F.coalesce(score, F.lit(0.0)) >= minimum


def in_fiscal_years(date: Column, years: Sequence[int]) -> Column:
    """1 October of the year before up to 30 September, for any of the years.

    Written as ranges on the bare column, so that the scan can use it.
    """
    inside = F.lit(False)
    for year in years:
        start = F.lit(f"{year - 1}-10-01").cast("date")
        after = F.lit(f"{year}-10-01").cast("date")
        inside = inside | ((date >= start) & (date < after))
    return inside


def in_award_scope(
    kind: Column,
    code: Column,
    date: Column,
    kinds: Sequence[str],
    codes: Sequence[str],
    fiscal_years: Sequence[int],
) -> Column:
    return kind.isin(*kinds) & code.isin(*codes) & in_fiscal_years(date, fiscal_years)


def in_trade_scope(
    code: Column, period: Column, codes: Sequence[str], periods: Sequence[str]
) -> Column:
    """Year-to-date figures: the December period holds the year's total."""
    return code.isin(*codes) & period.isin(*periods)


def drop_orphans(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all NULL belong to nothing."""
    return df.na.drop("all", subset=list(keys))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))
