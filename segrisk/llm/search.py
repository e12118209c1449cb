"""Ranked lexical search of many items at once, with the work that items share done once.

Items are sets of terms, and a document's score for an item is a sum over its
terms. Term sets that several items share are mined from the items: terms that
stand in the same items form one set, and the two sets that most items have in
common are joined to a larger one, until no two are shared. The sets form a
directed graph: each is the sum of two smaller ones, and an item is the sum of a
few sets. For a block of documents, the accumulator of every set is computed
once, from the postings or from its two parts, and items add them up.

Items come in blocks of a bounded number of terms, so the graph and the terms
that travel to tasks are bounded. Each block is one pass over the texts, which
stores a document's postings of these terms, one aggregation for the corpus
counts, and one pass over the postings, which returns the best documents of every
item and task. No pair of item and document leaves a task unless it is among them.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrisk.llm.merkle import lower_ascii
from segrisk.session import stored

#: A term is a run of ASCII letters and digits and of any characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms of the items of a block, about, repeats between items included.
BLOCK_TERMS = 50_000
#: Shared sets of an item that are joined with one another; an item with more has several such groups.
GROUP = 64
#: Cells of the accumulators that a task holds at a time.
CELLS = 4_000_000
#: Documents of a slice of postings.
SLICE_ROWS = 1000

#: Bytes of a term in lower case, all others blank.
_SEPARATED = bytes(
    c if c >= 128 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, A to Z in lower case, in order and with repeats."""
    return (text or "").encode().translate(_SEPARATED).split()


@dataclass
class Plan:
    """How the scores of a block of items are added up.

    ``terms`` numbers the terms, ``base`` gives the set each of them is added to.
    Sets of ``steps`` are the sums of two others, in order of depth. An item is the
    sum of the sets ``parts[start[i]:start[i + 1]]``.
    """

    terms: dict[bytes, int]
    base: np.ndarray
    sets: int
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    parts: np.ndarray
    start: np.ndarray
    shared: int = field(default=0)


def mine(items: Sequence[Sequence[bytes]]) -> Plan:
    """Shared term sets of the items, and the graph that adds them up. Items without terms have no parts."""
    holders: dict[bytes, list[int]] = {}
    for i, terms in enumerate(items):
        for t in sorted(set(terms)):
            holders.setdefault(t, []).append(i)
    number = {t: k for k, t in enumerate(sorted(holders))}
    same: dict[tuple[int, ...], int] = {}
    base = np.zeros(len(number), np.int64)
    for t, k in number.items():
        base[k] = same.setdefault(tuple(holders[t]), len(same))
    whole: list[set[int]] = [set() for _ in items]
    shared: dict[int, list[int]] = {}
    size = {s: len(having) for having, s in same.items()}
    for having, s in same.items():
        if len(having) == 1:
            whole[having[0]].add(s)
        else:
            for i in having:
                shared.setdefault(i, []).append(s)
    groups: list[tuple[int, set[int]]] = []  # an item, and sets of it that others have too
    for i, own in sorted(shared.items()):
        own.sort(key=lambda s: (-size[s], s))
        groups += [(i, set(own[k : k + GROUP])) for k in range(0, len(own), GROUP)]
    children, depth = _join(groups, len(same))
    for i, own in groups:
        whole[i] |= own
    by_depth: dict[int, list[tuple[int, int, int]]] = {}
    for node, (a, b) in children.items():
        by_depth.setdefault(depth[node], []).append((node, a, b))
    steps = [tuple(np.array(x) for x in zip(*by_depth[d], strict=True)) for d in sorted(by_depth)]
    parts = [sorted(s) for s in whole]
    start = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    flat = np.array([s for p in parts for s in p], np.int64)
    return Plan(number, base, len(same) + len(children), steps, flat, start, len(children))


def _join(groups: list[tuple[int, set[int]]], first: int) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
    """Join the two sets that most groups have in common, again and again; the groups are changed in place."""
    pairs: dict[tuple[int, int], set[int]] = {}
    for g, (_, own) in enumerate(groups):
        ordered = sorted(own)
        for x, a in enumerate(ordered):
            for b in ordered[x + 1 :]:
                pairs.setdefault((a, b), set()).add(g)
    heap = [(-len(having), pair) for pair, having in pairs.items() if len(having) > 1]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    depth: dict[int, int] = {}
    while heap:
        n, pair = heapq.heappop(heap)
        having = pairs.get(pair, set())
        if len(having) < 2:
            continue
        if len(having) != -n:
            heapq.heappush(heap, (-len(having), pair))
            continue
        node = first + len(children)
        a, b = children[node] = pair
        depth[node] = 1 + max(depth.get(a, 0), depth.get(b, 0))
        fresh = set()
        for g in sorted(pairs.pop(pair)):
            own = groups[g][1]
            own -= {a, b}
            for c in own:
                for old in (a, b):
                    pairs[min(old, c), max(old, c)].discard(g)
                pairs.setdefault((c, node), set()).add(g)
                fresh.add((c, node))
            own.add(node)
        for p in fresh:
            if len(pairs[p]) > 1:
                heapq.heappush(heap, (-len(pairs[p]), p))
    return children, depth


def postings(docs: DataFrame, plan: Plan, text: str, key: str) -> DataFrame:
    """Of every document with a term: key, its number of terms, and the terms of ``plan`` with their occurrences."""
    number = plan.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                kept, sizes, ends, terms, times = [], [], [0], [], []
                for row in range(part.num_rows):
                    words = terms_of(part.column(1)[row].as_py())
                    if words:
                        kept.append(row)
                        sizes.append(len(words))
                        found = Counter(filter(None.__ne__, map(number.get, words)))
                        terms.extend(found)
                        times.extend(found.values())
                        ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(kept, pa.int64())),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                    ],
                    ["key", "n", "terms", "times"],
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, n long, terms array<int>, times array<long>")


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The ``k`` best documents of every item so far: highest score, then least key, null keys last."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.item = self.score = self.key = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, keys: np.ndarray, nulls: np.ndarray) -> None:
        """Take in a table of items by documents."""
        least = self.floor
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, doc = np.nonzero((scores > 0) & (scores >= least[:, None]))
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, doc]])
        key, null = np.concatenate([self.key, keys[doc]]), np.concatenate([self.null, nulls[doc]])
        order = np.lexsort((key, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        use = order[place < self.k]
        self.item, self.score, self.key, self.null = item[use], score[use], key[use], null[use]
        last = place[place < self.k] == self.k - 1
        self.floor = self.floor.copy()
        self.floor[self.item[last]] = self.score[last]


def score_block(plan: Plan, weight: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Scores of all items (rows) for some documents, whose lengths give ``m`` and whose postings are listed."""
    sets = np.zeros((plan.sets, len(m)), np.int64)
    value = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
    np.add.at(sets, (plan.base[term], doc), value)
    for node, a, b in plan.steps:
        sets[node] = sets[a] + sets[b]
    out = np.zeros((len(plan.start) - 1, len(m)), np.int64)
    full = np.flatnonzero(np.diff(plan.start))
    if len(full):
        out[full] = np.add.reduceat(sets[plan.parts], plan.start[full], axis=0)
    return out


def best_of_tasks(stored_postings: DataFrame, plan: Plan, weight: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """Rows (number, key, score): the ``k`` best documents of every item among those of each task."""
    width = max(1, CELLS // max(1, plan.sets + len(plan.parts) + len(plan.start)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(plan.start) - 1, k)
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                key, n, terms, times = part.columns
                size = np.diff(np.asarray(terms.offsets))
                doc = np.repeat(np.arange(len(size)), size)
                m = 10 + (90 * n.to_numpy() * n_docs) // length
                flat = [np.asarray(x.flatten()).astype(np.int64) for x in (terms, times)]
                nulls = np.asarray(key.is_null())
                scores = score_block(plan, weight, m, doc, *flat)
                best.add(scores, key.fill_null(0).to_numpy(), nulls)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int64()), pa.array(best.key, pa.int64(), mask=best.null), pa.array(best.score, pa.int64())],
            ["number", "key", "score"],
        )

    return stored_postings.mapInArrow(run, "number long, key long, score long")


def first_of_each(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of every group with their ``rank``: first within 64 parts of it, then of these."""
    order = [F.desc("score"), F.col("key").asc_nulls_last()]
    parted = rows.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(64)))
    for keys in ([*group, "_part"], group):
        parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return parted.drop("_part")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", key: str = "doc_id", item: str = "item_id",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: item, rank (from 1), key (a long), score.

    Only scores above 0 count; equal scores stand by ascending key, null keys
    last. A repeated item has rows for each repetition, repeated documents each
    take a rank. Null texts and texts without terms find nothing and are not
    found; empty tables give an empty result. Other columns are not used.
    """
    spark = docs.sparkSession
    terms = F.sort_array(F.array_distinct(F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(TERM), F.lit(0))))
    asked = stored(items.select(F.col(item).alias("item"), terms.alias("terms")).filter(F.size("terms") > 0), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-total // block_terms)
    kind = items.schema[item].dataType.simpleString()
    best = spark.createDataFrame([], f"item {kind}, _block int, number long, key long, score long")
    for b in range(n_blocks):
        block = F.pmod(F.xxhash64("item", "terms"), F.lit(n_blocks)) == b
        rows = sorted(asked.filter(block).collect(), key=lambda r: (str(r["item"]), r["terms"]))
        plan = mine([[t.encode() for t in r["terms"]] for r in rows])
        found = stored(postings(docs, plan, text, key), "postings")
        n_docs, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weight = np.array([_weight(n_docs, df.get(t, 0)) for t in range(len(plan.terms))], np.int64)
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"number long, item {kind}")
        top = best_of_tasks(found, plan, weight, n_docs, length, k).join(names, "number")
        best = best.unionByName(top.withColumn("_block", F.lit(b)))
    ranked = first_of_each(best, ["_block", "number"], k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
