"""Composite score and tier, built in or from registered dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.functions.scores import (
    classify_tier,
    composite_sector,
    composite_state,
    weighted_mean,
)
from segrisk.functions.values import clip
from segrisk.operators.keyed import upsert


def score_composite(segments: DataFrame) -> DataFrame:
    score = F.when(F.col("row_type") == "STATE", composite_state(F.col("hhi_score"))).when(
        F.col("row_type") == "NAICS",
        composite_sector(F.col("geo_risk_score"), F.col("workforce_risk_score")),
    )
    return segments.withColumn("composite_risk_score", score).withColumn(
        "risk_tier", classify_tier(F.col("composite_risk_score"))
    )


@dataclass(frozen=True)
class Dimension:
    """A risk dimension: scores 0..100 for the rows of one type.

    ``compute`` returns one row per key with the column ``score``; ``column``
    is where the segments keep it. ``missing`` is the score of rows whose key
    was not scored, NULL unless the dimension says otherwise.
    """

    name: str
    row_type: str
    key: str
    compute: Callable[[], DataFrame]
    weight: float = 1.0
    missing: float | None = None

    @property
    def column(self) -> str:
        return f"{self.name}_score"


class Registry:
    """Dimensions in the order they were added; names and columns stay unique."""

    def __init__(self, dimensions: Sequence[Dimension] = ()):
        self._dimensions: dict[str, Dimension] = {}
        for dimension in dimensions:
            self.add(dimension)

    def add(self, dimension: Dimension) -> None:
        if dimension.name in self._dimensions:
            raise ValueError(f"dimension {dimension.name!r} is registered already")
        if dimension.weight <= 0:
            raise ValueError("a weight must be positive")
        self._dimensions[dimension.name] = dimension

    def __iter__(self):
        return iter(self._dimensions.values())

    def apply(self, segments: DataFrame) -> DataFrame:
        """One score column per dimension, then composite and tier.

        Weights are rescaled over the scores a row has, so a row with a single
        score takes that score.
        """
        scored = segments
        for d in self:
            bounded = d.compute().select(d.key, clip(F.col("score"), 0.0, 100.0).alias(d.column))
            scored = upsert(
                scored,
                bounded,
                key=d.key,
                applies=F.col("row_type") == d.row_type,
                defaults={d.column: F.lit(d.missing).cast("double")},
                elsewhere={d.column: F.lit(None).cast("double")},
            )
        return scored.withColumn("composite_risk_score", self._blend()).withColumn(
            "risk_tier", classify_tier(F.col("composite_risk_score"))
        )

    def _blend(self) -> Column:
        by_type: dict[str, list[tuple[Column, float]]] = {}
        for d in self:
            by_type.setdefault(d.row_type, []).append((F.col(d.column), d.weight))
        blend = F.lit(None).cast("double")
        for row_type, parts in by_type.items():
            blend = F.when(F.col("row_type") == row_type, weighted_mean(parts)).otherwise(blend)
        return blend
