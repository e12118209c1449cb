"""Language identification: averaged subword embeddings and a linear softmax.

A text is cut into hashed subwords of two and three bytes inside its letter runs
(a mark stands before and after a run). The embeddings of all subwords are
averaged, and a linear layer gives a score per language. Embeddings and layer
are learned together by stochastic gradient descent in numpy, on a bounded
sample chosen by hash. Rows of the sample that training does not see set the
temperature of the scores and the score below which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import mix, slices

UNKNOWN = "und"
BUCKETS = 1 << 14
DIMENSION = 16
#: Bounds of the sample on the driver: rows of a language (about), and bytes in all (about); rows are taken whole.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 48_000_000
#: Training ends when the loss of the rows kept apart has not fallen for so many epochs, or after the most.
PATIENCE = 5
MOST_EPOCHS = 400
RATE = 2.0
BATCH = 32
#: Share of right predictions that the rejection threshold may cost; it is never above STRICTEST.
LOST = 0.001
STRICTEST = 0.5

# Codes of bytes: letters without case, bytes of longer characters, 0 for all others.
_LETTER = np.zeros(256, np.uint32)
_LETTER[97:123] = _LETTER[65:91] = np.arange(1, 27)
_LETTER[128:] = np.arange(27, 155)


@dataclass(frozen=True)
class LanguageModel:
    """Learned tables. Scores under ``threshold`` count as rejected."""

    languages: tuple[str, ...]
    scores: np.ndarray  # language x bucket: embedding times layer
    bias: np.ndarray
    temperature: float
    threshold: float


def subwords(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of ``width`` bytes in each row, and the row of each."""
    code = np.zeros(len(data) + 2 + len(offsets), np.uint32)  # a mark after each row and before the first
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code[np.arange(len(data)) + row + 1] = _LETTER[data]
    owner = np.zeros(len(code), np.int64)
    owner[np.arange(len(data)) + row + 1] = row
    grams, n = np.zeros(len(code) - width + 1, np.uint32), len(code) - width + 1
    for k in range(width):
        grams |= code[k : k + n] << np.uint32(8 * k)
    middle = code[1 : n + 1] if width == 3 else np.maximum(code[:n], code[1 : n + 1])
    use = np.flatnonzero(middle)
    at = use + 1 if width == 3 else use + (code[use] == 0)
    return _buckets(grams[use], width), owner[at]


def _buckets(grams: np.ndarray, width: int) -> np.ndarray:
    return (mix(grams.astype(np.uint64) * np.uint64(8) + np.uint64(width)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: its buckets and their shares."""
    out = []
    for _, _, data, offsets in slices(texts, 1):
        found = np.concatenate([subwords(data, offsets, w)[0] for w in (2, 3)])
        bucket, n = np.unique(found, return_counts=True)
        out.append((bucket, (n / max(1, n.sum())).astype(np.float32)))
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> LanguageModel:
    """Model of the languages among ``labels``. Every fifth row is kept for calibration."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    rows = _counts(pa.array([texts[i] for i in order], pa.string()))
    y = np.array([languages.index(labels[i]) for i in order])
    tuning = np.arange(len(y)) % 5 == 4 if len(y) >= 5 * len(languages) else np.zeros(len(y), bool)
    seen = np.flatnonzero(~tuning)
    held = np.flatnonzero(tuning) if tuning.any() else seen
    # Rows of rare languages count more, so that every language has the same weight.
    number = np.bincount(y[seen], minlength=len(languages))
    weight = (len(seen) / np.maximum(number, 1) / len(languages)).clip(max=20).astype(np.float32)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    layer = np.zeros((DIMENSION, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    best, scores, waited, epoch = np.inf, np.zeros((len(languages), BUCKETS), np.float32), 0, 0
    best_bias = bias
    shares = np.zeros((BATCH, BUCKETS), np.float32)
    while waited < PATIENCE and epoch < MOST_EPOCHS:
        rng.shuffle(seen)
        for at in range(0, len(seen), BATCH):
            batch = seen[at : at + BATCH]
            share = shares[: len(batch)]
            share[:] = 0
            for k, i in enumerate(batch):
                share[k, rows[i][0]] = rows[i][1]
            mean = share @ embed
            grad = _softmax(mean @ layer + bias).astype(np.float32)
            grad[np.arange(len(batch)), y[batch]] -= 1
            grad *= weight[y[batch]][:, None] / len(batch)
            back = grad @ layer.T
            layer -= RATE * (mean.T @ grad)
            bias -= RATE * grad.sum(axis=0)
            embed -= RATE * len(batch) * (share.T @ back)
        epoch += 1
        now = (embed @ layer).T
        logits = np.array([now[:, rows[i][0]] @ rows[i][1] for i in held]) + bias
        loss = -(np.log(_softmax(logits)[np.arange(len(held)), y[held]] + 1e-12) * weight[y[held]]).mean()
        waited += 1
        # A loss that falls by less than a hundredth counts as standing still.
        if loss < best * 0.99:
            best, scores, best_bias, waited = loss, now.copy(), bias.copy(), 0
    bias = best_bias
    logits = np.array([scores[:, rows[i][0]] @ rows[i][1] for i in held]) + bias
    grid = np.geomspace(0.25, 20, 60)
    temperature = float(min(grid, key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean()))
    sure = _softmax(logits / temperature)
    right = sure.max(axis=1)[sure.argmax(axis=1) == y[held]]
    threshold = min(STRICTEST, float(np.quantile(right, LOST, method="lower"))) if len(right) else 0.0
    return LanguageModel(languages, scores, bias, temperature, threshold)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Learn from a bounded sample of the labelled rows of ``docs``.

    Rows with a null language or a text without letters teach nothing. A row is
    taken, whole, if a hash of its key falls under the share that gives about
    ``SAMPLE_ROWS`` rows of its language, and about ``SAMPLE_BYTES`` bytes in all,
    so copies cannot fill the sample. Every language is learned.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    size = F.sum(F.octet_length(text))
    sizes = known.groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).collect()
    if not sizes:
        return train([], [])
    # Rows of a language: a number of them, or fewer where they are long.
    most = SAMPLE_BYTES / len(sizes)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["l"], min(1.0, SAMPLE_ROWS / r["n"], most / max(1, r["bytes"])))])
    luck = F.pmod(F.xxhash64(F.col(key), F.lit(20)), F.lit(1 << 20)) / F.lit(1 << 20)
    taken = known.filter(luck < F.element_at(share, F.col(lang))).select(
        F.xxhash64(F.col(key)).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")
    )
    rows = sorted(taken.collect(), key=lambda r: (r["k"], r["l"], r["t"]))
    return train([r["t"] for r in rows], [r["l"] for r in rows])


def predict(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language of each whole text, and its calibrated score."""
    best, score = [], []
    for _, _, data, offsets in slices(texts):
        total = np.zeros((len(offsets) - 1, len(model.languages)))
        n = np.zeros(len(offsets) - 1)
        for width in (2, 3):
            bucket, row = subwords(data, offsets, width)
            n += np.bincount(row, minlength=len(n))
            for k, table in enumerate(model.scores):
                total[:, k] += np.bincount(row, table[bucket], len(n))
        p = _softmax((total / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
        best.append(p.argmax(axis=1))
        score.append(p.max(axis=1))
    return np.concatenate(best), np.concatenate(score)


def guess(model: LanguageModel, text: Column) -> Column:
    """Struct (lang_pred, score, rejected) of a text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected,
    whatever the model. A model without languages says ``und`` and rejects no
    text that has letters. Ties go to the first language in sort order.
    """
    kind = "struct<lang_pred:string,score:double,rejected:boolean>"

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        if not len(texts) or not model.languages:
            n = len(texts)
            return pa.StructArray.from_arrays(
                [pa.array([UNKNOWN] * n, pa.string()), pa.array([0.0] * n, pa.float64()), pa.array([False] * n, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )
        best, score = predict(model, texts)
        names = pa.array(model.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays(
            [names, pa.array(score, pa.float64()), pa.array(score < model.threshold)], ["lang_pred", "score", "rejected"]
        )

    found = run(F.coalesce(text, F.lit("")))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return F.when(text.rlike(r"\p{L}"), found).otherwise(none)


def keep_known(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents whose language is not rejected, with their own columns only."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = docs.select(whole.alias("_own"), guess(model, F.col(text)).alias("_lang"))
    return judged.filter(~F.col("_lang.rejected")).select("_own.*")
