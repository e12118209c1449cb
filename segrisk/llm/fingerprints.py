"""Document fingerprints: a sketch that keeps every shingle hash below a fixed fraction.

The hashes of all five-word shingles of a text that fall into the lowest 1/8 of
their range form the fingerprint. As the threshold is the same for all texts,
fingerprints can be merged (union), and the share of the smaller one that lies in
the larger one estimates containment, also between texts of very unequal length.
A text whose hashes all lie above the threshold keeps its least hash; a merge
drops such a hash as soon as one below the threshold is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import slices, word_shingles
from segrisk.llm.ranges import below

BITS = 40
#: One of so many hashes is kept.
FRACTION = 8
DIGITS = BITS // 4


def sketches(column: pa.Array, fraction: int = FRACTION) -> tuple[np.ndarray, np.ndarray]:
    """Retained hashes of each row, ascending and distinct, and how many each has."""
    found, counts = [], []
    for _, _, data, offsets in slices(column):
        hashes, n = word_shingles(data, offsets)
        row = np.repeat(np.arange(len(n)), n)
        value = hashes >> np.uint64(64 - BITS)
        least = np.full(len(n), 1 << BITS, np.uint64)
        np.minimum.at(least, row, value)
        low = value < (1 << BITS) // fraction
        use = low | (least[row] >= (1 << BITS) // fraction) & (value == least[row])
        key = np.unique(row[use].astype(np.uint64) << np.uint64(BITS) | value[use])
        found.append(key & np.uint64((1 << BITS) - 1))
        counts.append(np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=len(n)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(counts)


def texts_of(hashes: np.ndarray, counts: np.ndarray) -> list[str]:
    """Fingerprints as text: ten hexadecimal digits a hash, in ascending order."""
    raw = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()
    ends = np.cumsum(counts) * DIGITS
    return [raw[e - n * DIGITS : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def hashes_of(fingerprint: str) -> set[int]:
    return {int(fingerprint[i : i + DIGITS], 16) for i in range(0, len(fingerprint), DIGITS)}


def merge(a: str, b: str, fraction: int = FRACTION) -> str:
    """Fingerprint of two texts taken together."""
    both = hashes_of(a) | hashes_of(b)
    low = {h for h in both if h < (1 << BITS) // fraction} or ({min(both)} if both else set())
    return "".join(f"{h:0{DIGITS}x}" for h in sorted(low))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row: share of the smaller sketch that lies in the other. Two empty ones are alike, one is not."""
    keyed = [np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(BITS) | h for h, n in (a, b)]
    both = np.intersect1d(*keyed, assume_unique=True)
    common = np.bincount((both >> np.uint64(BITS)).astype(np.int64), minlength=len(a[1]))
    least = np.minimum(a[1], b[1])
    return np.where(least > 0, common / np.maximum(least, 1), (a[1] == b[1]).astype(float))


def with_next(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``docs`` dealt by ranges of ``key``, each range in descending order and followed by its next row.

    Columns: _range, _copy, _key, key, text. A range holds all rows between two quantiles of the key.
    The first row of a range is also dealt to the range above it, marked as a
    copy, and the very first row to the lowest range. Only the quantiles and the
    greatest key of each range, both one number per range, reach the driver.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A null key counts as the smallest; equal keys are ordered by text.
    keyed = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_key"), F.col(key), F.col(text).alias("_text"))
    cuts = keyed.select("_key").approxQuantile("_key", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
    edges = sorted({int(c) for c in cuts})
    ranged = keyed.withColumn("_range", below(edges, F.col("_key")))
    heads = dict(ranged.groupBy("_range").agg(F.max("_key")).collect())
    full = sorted(heads)
    above = {r: full[(i + 1) % len(full)] for i, r in enumerate(full)}
    table = lambda d: F.array(*[F.lit(d.get(r)).cast("long") for r in range(len(edges) + 1)])
    own = F.struct(F.col("_range").cast("long").alias("to"), F.lit(0).alias("copy"))
    copy = F.struct(F.get(table(above), F.col("_range")).alias("to"), F.lit(1).alias("copy"))
    first = F.col("_key") == F.get(table(heads), F.col("_range"))
    dealt = ranged.withColumn("_to", F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
    rows = dealt.select(F.col("_to.to").alias("_range"), F.col("_to.copy").alias("_copy"), "_key", key, "_text")
    order = ["_range", "_copy", F.desc("_key"), F.asc_nulls_first("_text")]
    return rows.repartition(n, "_range").sortWithinPartitions(*order)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of the ``following`` text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id", fraction: int = FRACTION) -> DataFrame:
    """``key`` and ``fingerprint`` of every whole text (null or without words: empty)."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(texts_of(*sketches(texts, fraction)), pa.string())

    return docs.select(F.col(key), run(F.col(text)).alias("fingerprint"))


def compare_edited(docs: DataFrame, text: str = "text", key: str = "doc_id", fraction: int = FRACTION) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they are.

    The next document is the one with the next smaller integer ``key``, after the
    last the first; a null key counts as the smallest, rows with equal keys
    follow each other by text, and null texts are empty. A single document is
    its own next. Texts without words have empty fingerprints, alike only to
    empty ones. Other columns of ``docs`` are not used.
    """
    kind = docs.schema[key].dataType.simpleString()
    columns = (
        f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(keys: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
        own, new, after = (sketches(pa.array(t, pa.large_string()), fraction) for t in (texts, changed, following))
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
        columns = [
            pa.array([len(t) for t in texts], pa.int64()), pa.array(sha, pa.string()),
            pa.array(texts_of(*own), pa.string()), pa.array(texts_of(*new), pa.string()),
            pa.array(likeness(own, new)), pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays([keys, *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of a batch waits for its next row.
        waiting: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            for at in range(0, max(0, len(rows) - 1), 1000):
                part = rows.slice(at, min(1001, len(rows) - at))
                texts = [t or "" for t in part["_text"].to_pylist()]
                use = [i for i, c in enumerate(part["_copy"].to_pylist()[:-1]) if c == 0]
                if use:
                    keys = part[key].take(pa.array(use)).combine_chunks()
                    yield compare(keys, [texts[i] for i in use], [texts[i + 1] for i in use])
            waiting = rows.slice(len(rows) - 1)

    return with_next(docs, text, key).mapInArrow(run, columns)
