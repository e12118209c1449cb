"""Ordered neighbours without a single sorted task: ranges of a key, with copies of the rows at their edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled keys for each range; the sample is the number of ranges times this at most, about.
SAMPLED = 50


def edges_of(df: DataFrame, column: str, n: int) -> list:
    """At most n - 1 keys that cut the distinct values of ``column`` into ranges of about equal size."""
    keys = df.select(column).distinct()
    total = keys.count()
    if n < 2 or total < 2:
        return []
    share = min(1.0, n * SAMPLED / total)
    luck = F.pmod(F.xxhash64(F.col(column), F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = sorted(r[0] for r in keys.filter(luck).collect())
    return sorted({sample[k * len(sample) // n] for k in range(1, n)}) if sample else []


def below(edges: list, x: Column) -> Column:
    """How many of the ascending ``edges`` are at most ``x``: a binary search per row."""
    if not edges:
        return F.lit(0)
    steps = [1 << k for k in range(len(edges).bit_length() - 1, -1, -1)]
    table = F.array(*map(F.lit, edges))
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda a, s: F.when((a + s <= len(edges)) & (F.get(table, a + s - 1) <= x), a + s).otherwise(a),
    )


def with_neighbours(rows: DataFrame, key: str, value: str, depth: int = 1, keys: DataFrame | None = None) -> DataFrame:
    """``rows`` (non-null distinct ``key``, and ``value``) with the values of the rows on either side.

    ``before`` and ``after`` hold the next ones, ``before2``, ``after2`` and so on
    those further away, up to ``depth``. Each range gets copies of the last rows
    before it and of the first rows after it, so its window needs no other range.
    ``2 * depth`` keys per range reach the driver. ``keys`` are the same keys from
    a cheaper source, if there is one.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (rows if keys is None else keys).select(key)
    edges = edges_of(keys, key, n)
    ranged = rows.withColumn("_range", below(edges, F.col(key)))
    targets = F.array(F.struct(F.col("_range").alias("to"), F.lit(False).alias("copy")))
    if edges:
        of_range = Window.partitionBy("_range")
        ends: list[list[list]] = []
        for order in (F.col(key).asc(), F.col(key).desc()):
            numbered = keys.withColumn("_range", below(edges, F.col(key))).withColumn("_n", F.row_number().over(of_range.orderBy(order)))
            ends.append([[] for _ in range(len(edges) + 1)])
            for r in sorted(numbered.filter(F.col("_n") <= depth).select("_range", "_n", key).collect()):
                ends[-1][r[0]].append(r[2])
        first, last = ends
        sent: list[list[tuple]] = [[] for _ in first]  # of each range: a key at its edge, the range that gets a copy
        for to in range(len(first)):
            for table, way in ((last, range(to - 1, -1, -1)), (first, range(to + 1, len(first)))):
                missing = depth
                for r in way if first[to] else ():
                    sent[r] += [(k, to) for k in table[r][:missing]]
                    missing -= len(table[r][:missing])
                    if not missing:
                        break
        nothing = F.array().cast("array<struct<key:string,to:int>>")
        table = F.array(*[
            F.array(*[F.struct(F.lit(k).alias("key"), F.lit(to).alias("to")) for k, to in pairs]) if pairs else nothing for pairs in sent
        ])
        own = F.filter(F.get(table, F.col("_range")), lambda x: x["key"] == F.col(key))
        targets = F.concat(targets, F.transform(own, lambda x: F.struct(x["to"].alias("to"), F.lit(True).alias("copy"))))
    dealt = ranged.withColumn("_to", F.explode(targets))
    order = Window.partitionBy("_to.to").orderBy(key)
    names = [(k, "" if k == 1 else str(k)) for k in range(1, depth + 1)]
    sides = {f"before{s}": F.lag(value, k).over(order) for k, s in names} | {f"after{s}": F.lead(value, k).over(order) for k, s in names}
    around = dealt.withColumns(sides)
    return around.filter(~F.col("_to.copy")).select(*rows.columns, *sides)
