"""Risk score formulas. Thresholds are parameters; the defaults are the model's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from segrisk.functions.values import clip, round_even, round_exact

# --- fixed values: score model -------------------------------------------

HHI_HIGH = 2500
HHI_MODERATE = 1500
TIER_CUTS = [(70, "High"), (40, "Medium"), (1, "Low")]
SHARE_WEIGHT = 0.7
BREADTH_NUMERATOR = 3000.0
# (input, score) corners; scores run straight between corners and stay flat after the last.
PEAK_CORNERS = [(0, 0), (5, 30), (10, 70), (40, 100)]
VOLATILITY_CORNERS = [(0, 0), (2, 30), (5, 70), (10, 100)]
TREND_PENALTY = 20.0
WORKFORCE_WEIGHTS = (0.5, 0.3, 0.2)

# --------------------------------------------------------------------------


def hhi_from_sums(sum_of_squares: Column, total: Column) -> Column:
    """Herfindahl-Hirschman index from the two sums over entity totals.

    All entities at zero give 0; totals that cancel to zero have no shares, NULL.
    """
    return F.when(sum_of_squares == 0, F.lit(0.0)).otherwise(
        F.try_divide(sum_of_squares, total * total) * 10000.0
    )


def classify_hhi(hhi: Column, high: float = HHI_HIGH, moderate: float = HHI_MODERATE) -> Column:
    return F.when(hhi > high, "High").when(hhi > moderate, "Moderate").otherwise("Low")


def classify_tier(score: Column, cuts: Sequence[tuple[float, str]] = TIER_CUTS) -> Column:
    tier = F.when(score.isNull() | F.isnan(score), "Unknown")
    for cut, name in cuts:
        tier = tier.when(score >= cut, name)
    return tier.otherwise("Minimal")


def geo_risk(
    share_percent: Column,
    destinations: Column,
    share_weight: float = SHARE_WEIGHT,
    breadth: float = BREADTH_NUMERATOR,
) -> Column:
    """Dependence on the largest destination plus a term that falls with breadth."""
    raw = share_percent * share_weight + F.try_divide(F.lit(breadth), destinations)
    return F.when(raw.isNotNull(), round_even(F.least(F.lit(100.0), raw)))


def interpolate(x: Column, corners: Sequence[tuple[float, float]]) -> Column:
    """Piecewise straight line through the corners, flat beyond the last one."""
    line = F.lit(float(corners[-1][1]))
    for (x0, y0), (x1, y1) in reversed(list(zip(corners, corners[1:]))):
        line = F.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(line)
    return F.when(x.isNotNull(), line)


def peak_score(drop_percent: Column, corners=PEAK_CORNERS) -> Column:
    return interpolate(drop_percent, corners)


def volatility_score(deviation: Column, corners=VOLATILITY_CORNERS) -> Column:
    return interpolate(deviation, corners)


def percent_drop(peak: Column, latest: Column) -> Column:
    return F.when(peak > 0, (peak - latest) / peak * 100.0).when(peak.isNotNull(), F.lit(0.0))


def trend_penalty(mean_change: Column, penalty: float = TREND_PENALTY) -> Column:
    return F.when(mean_change < 0, F.lit(penalty)).when(mean_change.isNotNull(), F.lit(0.0))


def workforce_risk(
    peak: Column, volatility: Column, penalty: Column, weights=WORKFORCE_WEIGHTS
) -> Column:
    """Weighted blend, bounded to 0..100; NULL as soon as one part is unknown."""
    blend = peak * weights[0] + volatility * weights[1] + penalty * weights[2]
    return round_exact(clip(blend, 0.0, 100.0))


def composite_sector(geo: Column, workforce: Column) -> Column:
    return F.coalesce(geo * 0.5 + workforce * 0.5, geo, workforce)


def composite_state(hhi: Column) -> Column:
    """Index on 0..10000 (number or numeric text) brought to 0..100."""
    return hhi.try_cast("double") / 10000.0 * 100.0


def weighted_mean(parts: Sequence[tuple[Column, float]]) -> Column:
    """Mean of the known scores, weights rescaled to the known ones; NULL if none is."""
    total = sum((F.when(s.isNotNull(), s * w).otherwise(0.0) for s, w in parts), F.lit(0.0))
    weight = sum((F.when(s.isNotNull(), F.lit(float(w))).otherwise(0.0) for s, w in parts), F.lit(0.0))
    return F.try_divide(total, weight)
