"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Every text is described by statistics of its whole bytes, words and lines. Scaled
statistics pass through random cosines, whose products approximate a Gaussian
kernel, so a linear model of them is a kernel model. The linear model is a ridge
regression: each task adds up the products of its labelled rows, Spark adds up
the tasks, and the driver solves a system of fixed size. Sums are kept apart by
fold, so models without one fold cost no second pass; their scores of that fold
choose the ridge and fit an increasing calibration on scores that no model has
learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from segrisk.llm.buffers import mix, prefix_hashes, range_hashes, slices, words

#: Random cosines, and the width of the kernel in units of the scaled statistics.
FEATURES = 128
WIDTH = 4.0
FOLDS = 5
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
#: Tasks that add up products; each sends (FEATURES + 2)^2 / 2 sums a fold.
SUM_TASKS = 64
#: Equal steps of raw scores in which calibration counts labels, over raw scores -1 to 2.
STEPS = 3000
SEED = 20
#: Scaled statistics are held within these bounds, so that no odd text leaves the range that was learned.
FARTHEST = 6.0

STATISTICS = (
    "bytes", "words", "word_bytes", "upper", "lower", "digits", "symbols", "exclamations", "points", "beyond_ascii", "space",
    "lines", "line_bytes", "distinct_words", "same_as_before", "distinct_pairs", "distinct_lines", "entropy", "marked_ends",
)

# Classes of bytes.
_CLASS = np.zeros(256, np.int64)
for _n, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>@^~_=+\\/{}[]", b"!?", b".,;:'\"()-", bytes(range(128, 256)), b" \t\n\v\f\r"),
    1,
):
    _CLASS[list(_bytes)] = _n


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each row."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    fresh = np.ones(len(r), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[fresh], minlength=n)


def describe_slice(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics (rows by ``STATISTICS``) of the texts of a slice."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    least = np.maximum(size, 1)
    classes = np.bincount(row * 16 + _CLASS[data], minlength=16 * n).reshape(n, 16)[:, 1:9] / least[:, None]
    start, end, counts = words(data, offsets)
    some, owner = np.maximum(counts, 1), np.repeat(np.arange(n), counts)
    prefix = prefix_hashes(data)
    hashes = range_hashes(prefix, start, end)
    follows = np.zeros(len(owner), bool)
    follows[1:] = owner[1:] == owner[:-1]
    again = follows.copy()
    again[1:] &= hashes[1:] == hashes[:-1]
    pairs = mix(hashes[1:] + mix(hashes[:-1]))[follows[1:]] if len(hashes) else hashes
    pair_owner = owner[follows]
    marked = np.zeros(len(owner), bool) if not len(end) else np.isin(_CLASS[data[end - 1]], (4, 5))
    # Lines: cut after each line feed and at the ends of texts.
    cut = np.flatnonzero(data == 10) + 1
    edges = np.unique(np.concatenate([offsets, cut]))
    line_start, line_end = edges[:-1], edges[1:]
    line_owner = np.searchsorted(offsets, line_start, "right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    lines = range_hashes(prefix, line_start, np.where(data[line_end - 1] == 10, line_end - 1, line_end)) if len(line_start) else hashes[:0]
    share = np.bincount(row * 256 + data, minlength=256 * n).reshape(n, 256) / least[:, None]
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    by_row = lambda flags, own: np.bincount(own[flags], minlength=n)
    columns = [
        np.log1p(size), np.log1p(counts), np.log1p(np.bincount(owner, end - start, n) / some), *np.sqrt(classes).T,
        np.log1p(n_lines), np.log1p(size / np.maximum(n_lines, 1)), _distinct(owner, hashes, n) / some, np.sqrt(by_row(again, owner) / some),
        _distinct(pair_owner, pairs, n) / np.maximum(counts - 1, 1), _distinct(line_owner, lines, n) / np.maximum(n_lines, 1), entropy,
        np.sqrt(by_row(marked, owner) / some),
    ]
    return np.column_stack(columns).astype(np.float32)


@F.arrow_udf(ArrayType(FloatType()))
def _describe(texts: pa.Array) -> pa.Array:
    found = [describe_slice(data, offsets) for _, _, data, offsets in slices(texts)]
    flat = np.concatenate(found).ravel() if found else np.zeros(0, np.float32)
    ends = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def describe(text: Column) -> Column:
    """Statistics of a whole text as an array; a null text is described as an empty one."""
    return _describe(F.coalesce(text, F.lit("")))


def _table(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Cosines:
    """Scaling of the statistics, and the random directions and phases drawn for them."""

    mean: np.ndarray
    spread: np.ndarray
    direction: np.ndarray
    phase: np.ndarray

    def __call__(self, statistics: np.ndarray) -> np.ndarray:
        """Features of rows, and a last column of ones."""
        x = np.clip((statistics - self.mean) / self.spread, -FARTHEST, FARTHEST)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.direction + self.phase)
        return np.column_stack([z, np.ones(len(z))])


def draw(mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> Cosines:
    rng = np.random.default_rng(seed)
    direction = rng.normal(0, 1 / width, (len(mean), features))
    return Cosines(mean, np.where(spread > 1e-6, spread, 1.0), direction, rng.uniform(0, 2 * np.pi, features))


@dataclass(frozen=True)
class QualityModel:
    """Features, ridge weights, and the calibrated score at ascending raw scores."""

    cosines: Cosines
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.interp(self.cosines(statistics) @ self.weights, self.raw, self.calibrated)


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights of summed products (features, ones, label); the last feature, the ones, is not held back."""
    n = sums[-2, -2]
    held = np.full(len(sums) - 1, ridge * max(n, 1.0))
    held[-1] = 1e-9
    return np.linalg.solve(sums[:-1, :-1] + np.diag(held), sums[:-1, -1])


def loss(sums: np.ndarray, weights: np.ndarray) -> float:
    """Summed squared error of weights on the rows of the sums."""
    w = np.append(weights, -1.0)
    return float(w @ sums @ w)


def increasing(raw: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares increasing shares of positives by pooling neighbours that violate the order.

    Result: raw scores, and the share of the pool at each of them, one point for
    each end of a pool. Half an average label is added to every pool, so that no share is 0 or 1.
    """
    pools: list[list[float]] = []  # positives, rows, least raw, greatest raw
    for x, k, p in zip(raw, n, positive, strict=True):
        pools.append([p, k, x, x])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, k2, _, last = pools.pop()
            pools[-1][0] += p2
            pools[-1][1] += k2
            pools[-1][3] = last
    mean = positive.sum() / n.sum()
    value = [(p + 0.5 * mean) / (k + 0.5) for p, k, _, _ in pools]
    value = np.maximum.accumulate(value)
    points = [(x, v) for (_, _, first, last), v in zip(pools, value, strict=True) for x in ((first, last) if last > first else (first,))]
    return np.array([x for x, _ in points]), np.array([v for _, v in points])


def sums_by_fold(labelled: DataFrame, cosines: Cosines) -> np.ndarray:
    """Summed products of (features, ones, label) of the rows (statistics, label, fold), for each fold."""
    size = len(cosines.phase) + 2
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, size, size))
        for batch in batches:
            z = np.column_stack([cosines(_table(batch.column(0))), batch.column(1).to_numpy()])
            fold = batch.column(2).to_numpy()
            for f in range(FOLDS):
                own = z[fold == f]
                total[f] += own.T @ own
        yield pa.RecordBatch.from_pydict({"fold": pa.array(range(FOLDS), pa.int32()), "sums": [t[upper] for t in total]})

    parts = labelled.select("statistics", "label", "fold").repartition(SUM_TASKS).mapInArrow(run, "fold int, sums array<double>")
    added = parts.select("fold", F.posexplode("sums").alias("at", "x")).groupBy("fold", "at").agg(F.sum("x").alias("x"))
    out = np.zeros((FOLDS, size, size))
    for r in added.collect():
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        out[r["fold"], i, j] = out[r["fold"], j, i] = r["x"]
    return out


def counts_by_step(labelled: DataFrame, cosines: Cosines, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of raw scores that have rows, their rows and positives; fold ``f`` is scored by ``weights[f]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, STEPS))
        for batch in batches:
            raw = (cosines(_table(batch.column(0))) * weights[batch.column(2).to_numpy()]).sum(axis=1)
            step = np.clip((raw + 1) * (STEPS / 3), 0, STEPS - 1).astype(np.int64)
            label = batch.column(1).to_numpy()
            count += [np.bincount(step, minlength=STEPS), np.bincount(step, label, STEPS)]
        use = np.flatnonzero(count[0])
        yield pa.RecordBatch.from_pydict({"step": pa.array(use, pa.int32()), "n": count[0][use], "positive": count[1][use]})

    found = labelled.select("statistics", "label", "fold").mapInArrow(run, "step int, n double, positive double")
    rows = found.groupBy("step").agg(F.sum("n"), F.sum("positive")).collect()
    table = np.array(sorted(tuple(r) for r in rows), np.float64).reshape(-1, 3)
    return (table[:, 0] + 0.5) * (3 / STEPS) - 1, table[:, 1], table[:, 2]


def fit(described: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> QualityModel:
    """Learn from the rows of ``described`` (key, statistics) that have a label of 0 or 1.

    Null labels and keys teach nothing, a row with several labels counts for each.
    All labelled rows are used. What reaches the driver has a fixed size: means,
    sums of products and counts by step. Without labelled rows every score is 0.5.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("label")).filter(F.col("label").isin(0.0, 1.0))
    rows = described.select(F.col(key).alias("_key"), "statistics").join(known, "_key")
    labelled = rows.select("statistics", "label", F.pmod(F.xxhash64("_key", F.lit(SEED)), F.lit(FOLDS)).cast("int").alias("fold"))
    each = [F.get("statistics", F.lit(i)).cast("double") for i in range(len(STATISTICS))]
    scale = labelled.agg(F.count(F.lit(1)), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    if not scale[0]:
        cosines = draw(np.zeros(len(each)), np.ones(len(each)))
        return QualityModel(cosines, np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    mean, spread = np.array(scale[1 : len(each) + 1]), np.array(scale[len(each) + 1 :])
    cosines = draw(mean, spread)
    folds = sums_by_fold(labelled, cosines)
    total = folds.sum(axis=0)
    without = lambda ridge: np.array([solve(total - f, ridge) for f in folds])
    ridge = min(RIDGES, key=lambda r: sum(loss(f, w) for f, w in zip(folds, without(r), strict=True)))
    raw, calibrated = increasing(*counts_by_step(labelled, cosines, without(ridge)))
    return QualityModel(cosines, solve(total, ridge), raw, calibrated)


def score(model: QualityModel, statistics: Column) -> Column:
    """Calibrated score, 0 to 1, of described rows."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(model.score(_table(column)), pa.float64())

    return run(statistics)
