"""Token counts of a unigram model by dynamic programming over a trie.

The distinct words of a slice, sorted, are a walk through their trie: neighbours
share the path of their common prefix. The forward score of a prefix (best sum of
piece scores, and the fewest pieces that reach it) is computed once and kept on
the path; the count at the end of a word is stored for all its occurrences.
"""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import slices, word_hashes, words
from segrisk.llm.piececache import Memory

#: Mark before every word, as in the vocabulary.
MARK = "▁"
#: Extra cost of each byte of a character that is written as bytes.
BYTE_COST = 10.0


@functools.cache
def vocabulary(path: str) -> tuple[dict[str, float], int, float]:
    """Score of each piece, length of the longest, and score of a byte.

    The file lists pieces by falling frequency; the score is the logarithm of a
    frequency by Zipf's law, 1 / (place in the list + 1).
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    scores = {piece: -math.log(place + 1) for place, piece in enumerate(plain, 1)}
    return scores, max(map(len, plain)), -math.log(len(plain) + 2) - BYTE_COST


def count_pieces(distinct: list[str], scores: dict[str, float], longest: int, byte: float) -> dict[str, int]:
    """Pieces on the best path of each word; of equal paths the shorter counts."""
    out = {}
    path, best, count = "", [0.0], [0]
    for word in sorted(distinct):
        own = MARK + word
        shared = len(os.path.commonprefix([path, own]))
        del best[shared + 1 :], count[shared + 1 :]
        for i in range(shared + 1, len(own) + 1):
            n = len(own[i - 1].encode())
            score, pieces = best[i - 1] + n * byte, count[i - 1] + n
            for j in range(max(0, i - longest), i):
                piece = scores.get(own[j:i])
                if piece is not None:
                    other = best[j] + piece
                    if other > score or other == score and count[j] < pieces - 1:
                        score, pieces = other, count[j] + 1
            best.append(score)
            count.append(pieces)
        path = own
        out[word] = count[-1]
    return out


@functools.cache
def _memory(path: str) -> Memory:
    return Memory(np.uint32)


def count(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_words and n_tokens of every whole text.

    ``model`` is the path of a vocabulary file on every machine. Null and empty
    texts have no words and no tokens. Repeated rows each get a row; other
    columns of ``docs`` are not used.
    """
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = narrow.schema[key].dataType.simpleString()

    def work_out(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        distinct = [p.decode() for p in pieces]
        found = count_pieces(distinct, *vocabulary(model))
        return np.ones(len(pieces), np.int64), np.fromiter(map(found.__getitem__, distinct), np.uint32, len(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_tokens = [], []
            for _, _, data, offsets in slices(batch.column(1)):
                start, end, counts = words(data, offsets)
                hashes = word_hashes(data, start, end)
                each, _ = _memory(model).rows(data, hashes, start, end, work_out)
                total = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
                n_words.append(counts)
                n_tokens.append(np.diff(total[np.concatenate([[0], np.cumsum(counts)])]))
            if n_words:
                columns = [np.concatenate(c).astype(np.int64) for c in (n_words, n_tokens)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, columns)], [key, "n_words", "n_tokens"]
                )

    return narrow.mapInArrow(run, f"`{key}` {kind}, n_words long, n_tokens long")
