"""Exact join of documents by the Jaccard distance of their word shingles, in regions around pivots.

Jaccard distance is a metric, and a document is linked with what lies within
``RADIUS`` of it. The join goes from the outside inwards:

1. Documents without a possible partner leave. A partner holds all but
   n - ceil(0.8 n) shingles of a document of n; so of its shingles under a hash
   threshold all but so many must occur in other documents. The thresholded
   hashes are counted in blocks of the hash range; each batch of documents sends
   a block only its distinct hashes and gets back one bit for each.
2. Equal sets become one class with its least key.
3. Outer pivots are the single shingles. A set is at 1 - 1/n from each of its
   own and at 1 from all others, so its region is that of its first shingle,
   rarest first. It is replicated into the regions of its first
   n - ceil(0.8 n) + 1 shingles: a set within the radius has one of them as the first that both
   have. The smaller of two sets needs only its first n - ceil(8 n / 9) + 1; a
   region without such a member has no pair and goes.
4. Inner pivots are sets. In every region the members are compared with a few
   pivots. What lies within the radius of a pivot is linked with it and so becomes
   one component, however many members that are. Members leave by the triangle
   inequality: one within the radius of the first pivot can be linked with
   another at distance d from it only if its own distance is at least d - radius.
   Pivots leave, as all their pairs are settled. The rest joins recursively, with
   pivots from outside the largest component of the region, until each region
   is one component. Pairs inside a component need no comparison.

Distances are computed from the shingles that occur twice or more, since only
those can be common. Hashes have 64 bits; sets count as equal if their hashes are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from segrisk.llm.buffers import mix, slices, word_shingles
from segrisk.llm.components import connected
from segrisk.llm.rowhash import quoted, row_hash
from segrisk.session import stored

WIDTH = 5
#: Two documents link when 100 * intersection >= 80 * union: distance at most 0.2.
RADIUS = 0.2
#: Share of all hashes that the first step counts, in 2**-16.
SAMPLE = int(0.4 * (1 << 16))
#: Documents that send their hashes together.
BATCH_ROWS = 2000
#: Inner pivots of a region in the first, second, ... round; the last number holds for all later ones.
PIVOTS = (8, 32, 128)


def shingle_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of the rows of each slice, ascending in each row, and their number per row."""
    for _, _, data, offsets in slices(column):
        hashes, n = word_shingles(data, offsets, lower=True, width=WIDTH)
        row = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        yield hashes[new], np.bincount(row[new], minlength=len(n))


def _all_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = list(shingle_sets(column))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _sampled(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which hashes are counted, the block of each of these and its place in the block, 32 bits."""
    use = (hashes & np.uint64(0xFFFF)) < SAMPLE
    spread = hashes[use] >> np.uint64(16)
    return use, (spread % np.uint64(blocks)).astype(np.int64), ((spread // np.uint64(blocks)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _block_places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Counted hashes of a batch as block * 2**32 + place."""
    use, block, place = _sampled(hashes, blocks)
    return use, block.astype(np.uint64) << np.uint64(32) | place


def _send(table: pa.Table, blocks: int) -> pa.Table:
    """For each block: the distinct places of a batch, those that occur twice in it given twice."""
    hashes, _ = _all_sets(table["_text"].combine_chunks())
    _, code = _block_places(hashes, blocks)
    value, n = np.unique(code, return_counts=True)
    value = np.repeat(value, np.minimum(n, 2))
    block = (value >> np.uint64(32)).astype(np.int64)
    ids, first = np.unique(block, return_index=True)
    place = (value & np.uint64(0xFFFFFFFF)).astype("<u4")
    parts = np.split(place, first[1:]) if len(ids) else []
    batch = table["_batch"][0].as_py() if len(table) else 0
    return pa.table(
        {
            "_batch": pa.array([batch] * len(ids), pa.int64()),
            "block": pa.array(ids, pa.int64()),
            "places": pa.array([p.tobytes() for p in parts], pa.binary()),
        }
    )


def _count(table: pa.Table) -> pa.Table:
    """For each batch of a block: one bit for each distinct place, set if it occurs twice anywhere."""
    rows = [np.frombuffer(b, "<u4") for b in table["places"].to_pylist()]
    value, n = np.unique(np.concatenate(rows), return_counts=True)
    twice = value[n > 1]
    bits = []
    for row in rows:
        distinct = row[np.append(True, row[1:] != row[:-1])] if len(row) else row
        bits.append(np.packbits(np.isin(distinct, twice, assume_unique=True)).tobytes())
    return pa.table({"_batch": table["_batch"], "block": table["block"], "bits": pa.array(bits, pa.binary())})


def _judge(docs: pa.Table, masks: pa.Table, blocks: int) -> pa.Table:
    """Size and hash of every set, and its hashes where it may have a partner."""
    text = docs["_text"].combine_chunks()
    hashes, n = _all_sets(text)
    use, code = _block_places(hashes, blocks)
    value, which = np.unique(code, return_inverse=True)
    block = (value >> np.uint64(32)).astype(np.int64)
    twice = np.zeros(len(value), bool)
    for b, bits in zip(masks["block"].to_pylist(), masks["bits"].to_pylist(), strict=True):
        low, high = np.searchsorted(block, b), np.searchsorted(block, b, "right")
        twice[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
    row = np.repeat(np.arange(len(n)), n)
    alone = np.bincount(row[use][~twice[which]], minlength=len(n))
    alive = (n > 0) & (alone <= n - _ceil(4 * n, 5))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes), out=total[1:], dtype=np.uint64)
    ends = np.cumsum(n)
    identity = mix(total[ends] - total[ends - n] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    kept = [hashes[e - k : e].astype("<u8").tobytes() if a else None for e, k, a in zip(ends.tolist(), n.tolist(), alive.tolist(), strict=True)]
    return pa.table(
        {
            "_key": docs["_key"],
            "n": pa.array(n.astype(np.int64)),
            "v": pa.array(identity.view(np.int64)),
            "set": pa.array(kept, pa.binary()),
        }
    )


def _ceil(a, b):
    return -(-a // b)


def candidates(base: DataFrame) -> DataFrame:
    """base: _key, _text. Columns _key, n, v (hash of the set) and set (its hashes, null without a possible partner)."""
    spark = base.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches = max(1, _ceil(base.count(), BATCH_ROWS))
    kinds = (("n", LongType()), ("v", LongType()), ("set", BinaryType()))
    schema = StructType([base.schema["_key"], *[StructField(*k) for k in kinds]])
    batch = F.pmod(F.xxhash64("_key", "_text"), F.lit(batches)).alias("_batch")
    dealt = base.select("_key", "_text", batch).repartition("_batch")
    sent = dealt.groupBy("_batch").applyInArrow(lambda t: _send(t, blocks), "_batch long, block long, places binary")
    masks = sent.groupBy("block").applyInArrow(_count, "_batch long, block long, bits binary")
    judged = dealt.groupBy("_batch").cogroup(masks.groupBy("_batch"))
    return judged.applyInArrow(lambda d, m: _judge(d, m, blocks), schema)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            raw = part.column(2).to_pylist()
            lengths = np.array([len(b) // 8 for b in raw], np.int64)
            flat = np.frombuffer(b"".join(raw), "<i8")
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["v", "n", "h"]
            )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common hashes of the lists of two sets."""
    for batch in batches:
        found = []
        ends = [batch.column(k).offsets.to_numpy() for k in (2, 3)]
        flat = [batch.column(k).values.to_numpy(zero_copy_only=False) for k in (2, 3)]
        for k in range(len(batch)):
            a, b = (f[e[k] : e[k + 1]] for f, e in zip(flat, ends, strict=True))
            found.append(len(np.intersect1d(a, b, assume_unique=True)))
        columns = [batch.column(0), batch.column(1), pa.array(found, pa.int64()), batch.column(4), batch.column(5)]
        yield pa.RecordBatch.from_arrays(columns, ["v", "p", "both", "n", "pn"])


def _sizes_fit(n: Column, m: Column) -> Column:
    return (10 * n >= 8 * m) & (10 * m >= 8 * n)


def _linked(both: Column, n: Column, m: Column) -> Column:
    return 100 * both >= 80 * (n + m - both)


def region_members(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (s, v, n, place, core) of the regions of outer pivots, and the sets (v, n, shared).

    classes: v, n, set. ``core`` marks members that may be the smaller set of a pair.
    """
    rows = classes.select("v", "n", "set").mapInArrow(_as_array, "v long, n long, h array<long>")
    each = rows.select("v", "n", F.explode("h").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    lists = (
        each.join(often, "s")
        .groupBy("v", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("l"))
        .filter(5 * F.size("l") >= 4 * F.col("n"))
    )
    lists = stored(
        lists.select("v", "n", F.size("l").alias("m"), F.transform("l", lambda x: x["s"]).alias("l")), "shared"
    )
    n, m = F.col("n"), F.col("m")
    reach = (n - F.ceil(4 * n / 5) + 1 - (n - m)).cast("int")
    first = lists.select("v", "n", "m", F.slice("l", F.lit(1), F.least(reach, F.col("m"))).alias("l"))
    members = first.select("v", "n", "m", F.posexplode("l").alias("i", "s"))
    core = (F.col("i") + n - m < n - F.ceil(8 * n / 9) + 1).alias("core")
    return members.select("s", "v", "n", (F.col("i") + n - m).alias("place"), core), lists.select("v", "n", F.col("l").alias("shared"))


def _open(members: DataFrame) -> DataFrame:
    """Members of regions that can hold a link between two components, with the region's largest one."""
    by_component = members.groupBy("s", "c").agg(F.count(F.lit(1)).alias("size"), F.max("core").alias("core"))
    regions = by_component.groupBy("s").agg(
        F.count(F.lit(1)).alias("components"), F.max("core").alias("core"), F.max_by("c", F.struct("size", "c")).alias("largest")
    )
    open_ = regions.filter("components > 1 and core").select("s", "largest")
    return members.join(open_, "s")


def _pivots(members: DataFrame, wanted: Column, most: int) -> DataFrame:
    """For each region its ``most`` first wanted members, in an order that is the same in all regions."""
    first = Window.partitionBy("s").orderBy(F.xxhash64("v"), "v")
    some = members.filter(wanted).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)
    one = F.struct("rank", F.col("v").alias("p"), F.col("n").alias("pn"), F.col("c").alias("pc"), F.col("core").alias("pcore"), F.col("place").alias("pplace"))
    return some.groupBy("s").agg(F.sort_array(F.collect_list(one)).alias("pivots"))


def _may_meet(q: Column) -> Column:
    """A link whose first common shingle is that of the region: the smaller set is a core, and enough is left of both."""
    n, m = F.col("n"), q["pn"]
    smaller = (F.col("core") & (n <= m)) | (q["pcore"] & (m <= n))
    return smaller & (9 * F.least(n - F.col("place"), m - q["pplace"]) >= 4 * (n + m))


def _distances(around: DataFrame, sets: DataFrame, first: bool) -> DataFrame:
    """v, p, n, pn, both of all pairs of a member and a pivot of its region that may link two components.

    In the ``first`` round every member is compared with the first pivot of its region.

    A pair that meets in many regions is compared once: the pivots of all regions
    of a member come together as one list before they become rows.
    """
    fits = lambda q: (q["pc"] != F.col("c")) & _sizes_fit(F.col("n"), q["pn"]) & (_may_meet(q) | all_of(q))
    all_of = lambda q: (q["rank"] == 1) if first else F.lit(False)
    useful = F.transform(F.filter("pivots", fits), lambda q: F.struct(q["p"].alias("p"), q["pn"].alias("pn")))
    lists = around.select("v", "n", useful.alias("q")).filter(F.size("q") > 0)
    merged = lists.groupBy("v", "n").agg(F.array_distinct(F.flatten(F.collect_set("q"))).alias("q"))
    pairs = merged.select("v", "n", F.inline("q"))
    own = pairs.join(sets.select("v", F.col("shared").alias("a")), "v")
    both = own.join(sets.select(F.col("v").alias("p"), F.col("shared").alias("b")), "p")
    return both.select("v", "p", "a", "b", "n", "pn").mapInArrow(_overlaps, "v long, p long, both long, n long, pn long")


def _in_window(around: DataFrame, near: DataFrame) -> DataFrame:
    """Members without those whose distance to the region's first pivot rules out every open link.

    The first pivot is compared with all members whose size fits; sizes that do
    not fit bound the distance from below. Members within the radius of it are
    connected. By the triangle inequality such a member can be linked with one at distance d
    only if its own distance is at least d - radius.
    """
    first = around.withColumn("first", F.get("pivots", F.lit(0))).withColumns({"p": F.col("first.p"), "pn": F.col("first.pn")})
    known = near.select("v", "p", (1 - F.col("both") / (F.col("n") + F.col("pn") - F.col("both"))).alias("d"))
    bound = 1 - F.least("n", "pn") / F.greatest("n", "pn")
    apart = first.join(known, ["v", "p"], "left").withColumn("at", F.when(F.col("v") == F.col("p"), 0.0).otherwise(F.coalesce("d", bound)))
    apart = apart.withColumn("linked", (F.col("v") == F.col("p")) | (F.col("d") <= RADIUS + 1e-9))
    least = apart.filter(~F.coalesce("linked", F.lit(False))).groupBy("s").agg(F.min("at").alias("least"))
    kept = ~F.coalesce("linked", F.lit(False)) | (F.col("at") >= F.col("least") - RADIUS - 1e-9)
    return apart.join(least, "s").filter(kept).select("s", "v", "n", "place", "core", "pivots")


def _without_pivots(around: DataFrame) -> DataFrame:
    """Members that were no pivot of their region: all pairs of a pivot are settled."""
    used = F.exists("pivots", lambda q: q["p"] == F.col("v"))
    return around.filter(~used).select("s", "v", "n", "place", "core")


def components(classes: DataFrame) -> DataFrame:
    """``v`` and ``component`` of the sets ``classes`` (v, n, set) that share shingles with others."""
    members, sets = region_members(classes)
    labels = sets.select("v", F.col("v").alias("c"))
    members = stored(members, "members")
    for most in itertools.chain(PIVOTS, itertools.repeat(PIVOTS[-1])):
        first = most == PIVOTS[0]
        open_ = stored(_open(members.join(labels, "v")), "regions")
        if open_.isEmpty():
            return labels.withColumnRenamed("c", "component")
        # Later pivots lie outside the largest component of their region, which is what has to be settled.
        pivots = _pivots(open_, F.col("core") if first else F.col("c") != F.col("largest"), most)
        around = stored(open_.join(pivots, "s"), "around")
        near = stored(_distances(around, sets, first), "distances")
        found = near.filter(_linked(F.col("both"), F.col("n"), F.col("pn"))).select("v", "p")
        if not found.isEmpty():
            ends = [labels.select(F.col("v").alias(x), F.col("c").alias(y)) for x, y in (("v", "a"), ("p", "b"))]
            merged = connected(found.join(ends[0], "v").join(ends[1], "p").select("a", "b"))
            new = labels.join(merged, labels["c"] == merged["node"], "left")
            labels = stored(new.select("v", F.coalesce("component", "c").alias("c")), "labels")
        rest = _in_window(around, near) if first else around
        members = stored(_without_pivots(rest), "members")


def join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_shingles and component_id (the least key reachable by links) of every document.

    Letters A-Z are lowered; words are runs of other than blank and the control
    characters 9 to 13. With fewer than five words the whole sequence is the one
    shingle; null texts and texts without words have none and are linked with
    nothing. Rows with equal keys are documents of their own; a null key counts
    only where a component has no other. Other columns of ``docs`` are not used.
    """
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    judged = stored(candidates(base), "candidates")
    alive = judged.filter("set is not null")
    classes = alive.groupBy("v", "n").agg(F.min("set").alias("set"))
    least = alive.groupBy("v").agg(F.min("_key").alias("least"))
    grouped = least.join(components(classes), "v", "left")
    grouped = grouped.select("v", "least", F.coalesce("component", "v").alias("component"))
    best = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(best, "component").select("v", "component_id")
    linked = judged.filter("set is not null").select("_key", "n", "v").join(named, "v", "left")
    alone = judged.filter("set is null").select("_key", "n", F.col("_key").alias("component_id"))
    return linked.select("_key", "n", F.coalesce("component_id", "_key").alias("component_id")).unionByName(alone).select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id"
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the least key, of equal ones the first by its columns.

    Documents without words are linked with nothing and stay.
    """
    columns = [quoted(c) for c in docs.columns]
    hashes = [row_hash(docs).alias("_h"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("_c")]
    row = F.struct(F.col(key).alias("key"), *hashes)
    found = join(docs.select(row.alias("_row"), F.col(text).alias("_t")), "_t", "_row")
    first = found.filter(F.col("_row") == F.col("component_id")).select("_row._h", "_row._c").distinct()
    whole = docs.select(F.struct(*columns).alias("_own"), *hashes)
    return whole.join(first, ["_h", "_c"], "left_semi").dropDuplicates(["_h", "_c"]).select("_own.*")
