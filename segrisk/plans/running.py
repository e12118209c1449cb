"""Supplier concentration kept up to date as awards arrive.

Two keyed tables hold what the index needs: the total of every recipient of a
state, and of every state the sums of x and of x squared over its recipients. New
awards are summed by recipient to d first; a recipient at x then adds 2xd + d*d
to the squares of its state, so a batch reads the totals of the recipients it
names, and no award that came before. Sums are whole cents and exact, whatever
the order of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrisk.functions.scores import hhi_from_sums
from segrisk.functions.values import dollars
from segrisk.session import stored
from segrisk.sources import keyed_store

ENTITY = ["state", "recipient_name"]
ENTITIES = "state string, recipient_name string, cents long, awards long"
GROUPS = "state string, value decimal(38,0), awards long, named decimal(38,0), squares decimal(38,0), recipients long"
#: Factors of a product, so that it has 38 digits.
FACTOR = "decimal(19,0)"


def start(spark: SparkSession, path: str, buckets: int = keyed_store.BUCKETS, group_buckets: int = 8) -> None:
    """Empty tables below ``path``."""
    keyed_store.create(spark.createDataFrame([], ENTITIES), f"{path}/entities", ENTITY, buckets)
    keyed_store.create(spark.createDataFrame([], GROUPS), f"{path}/groups", ["state"], group_buckets)


def apply_batch(spark: SparkSession, path: str, parts: DataFrame, batch: str) -> None:
    """Add a batch of award parts under a name of its own.

    The sums of the states are changed first, then the totals of the recipients
    they were computed from. Each table notes the batch with its change, so a
    batch that was cut off in between, or is sent again, counts once.
    """
    entities, groups = f"{path}/entities", f"{path}/groups"
    in_groups, in_entities = (keyed_store.noted(spark, p, batch) for p in (groups, entities))
    if in_groups and in_entities:
        return
    added = (
        parts.where(F.col("state").isNotNull())
        .groupBy(*ENTITY)
        .agg(F.coalesce(F.sum("award_cents"), F.lit(0)).alias("d"), F.sum("award_count").alias("n"))
    )
    added = stored(added, "batch")
    before = keyed_store.lookup(spark, entities, added)
    known = before.select(*[F.col(c).alias(f"_{c}") for c in before.columns])
    same = added["state"].eqNullSafe(known["_state"]) & added["recipient_name"].eqNullSafe(known["_recipient_name"])
    moved = stored(
        added.join(known, same, "left").select(
            *ENTITY, "d", "n", F.coalesce("_cents", F.lit(0)).alias("x"), F.coalesce("_awards", F.lit(0)).alias("m"),
            F.col("_state").isNull().alias("is_new"),
        ),
        "moved",
    )
    if not in_groups:
        _add_to_groups(spark, groups, moved, batch)
    if not in_entities:
        totals = moved.select(*ENTITY, (F.col("x") + F.col("d")).alias("cents"), (F.col("m") + F.col("n")).alias("awards"))
        keyed_store.update(spark, entities, totals, note=batch)


def _add_to_groups(spark: SparkSession, groups: str, moved: DataFrame, batch: str) -> None:
    x, d = F.col("x").cast(FACTOR), F.col("d").cast(FACTOR)
    named = F.col("recipient_name").isNotNull()
    zero = F.lit(0)
    change = moved.groupBy("state").agg(
        F.sum(d).alias("value"),
        F.sum("n").alias("awards"),
        F.coalesce(F.sum(F.when(named, d)), zero).alias("named"),
        F.coalesce(F.sum(F.when(named, x * d + x * d + d * d)), zero).alias("squares"),
        F.count_if(named & F.col("is_new")).alias("recipients"),
    )
    kept = keyed_store.lookup(spark, groups, change.select("state")).unionByName(
        change.select("state", *[F.col(c).cast(k).alias(c) for c, k in _kinds().items()])
    )
    sums = kept.groupBy("state").agg(*[F.sum(c).cast(k).alias(c) for c, k in _kinds().items()])
    keyed_store.update(spark, groups, stored(sums, "sums"), note=batch)


def _kinds() -> dict[str, str]:
    return dict(pair.split(" ") for pair in GROUPS.split(", ")[1:])


def profile(spark: SparkSession, path: str) -> DataFrame:
    """Value, awards, named recipients and index of every state, as ``concentration.state_profile`` gives them."""
    index = hhi_from_sums(F.col("squares").cast("double"), F.col("named").cast("double"))
    return keyed_store.read(spark, f"{path}/groups").select(
        "state",
        dollars(F.col("value")).alias("total_contract_value"),
        F.col("awards").alias("award_count"),
        F.col("recipients").alias("distinct_recipients"),
        index.alias("hhi_score"),
    )
