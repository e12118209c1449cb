"""Sequence packing by power-of-two decomposition.

The token ids of a document, with an end id, are cut into pieces whose lengths
are the binary digits of its length, longest first, none above the longest
sequence. Every piece is a sequence of its own, so no sequence crosses
documents and none is padded; sequences of one length form a bucket.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import slices, word_hashes
from segrisk.llm.piececache import Memory
from segrisk.llm.pretokens import cut

LONGEST = 1024
END_ID = 0
#: Pre-tokens that a worker remembers, and those it encodes at a time (the library's results are large).
KNOWN = 500_000
AT_A_TIME = 4096
PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket long"
)


@functools.cache
def _encoder(path: str, ordinary: bool = True):
    """The tokenizer; ``ordinary``: its added tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = ordinary
    return tokenizer


def _with_added(column: pa.Array, path: str) -> np.ndarray:
    """Which rows hold an added token, as ``<|endoftext|>``; the library gives it its id before it cuts the text."""
    out = np.zeros(len(column), bool)
    for token in _encoder(path).get_added_tokens_decoder().values():
        out |= pc.match_substring(column, token.content).fill_null(False).to_numpy(zero_copy_only=False)
    return out


@functools.cache
def _memory(path: str) -> Memory:
    return Memory(np.uint32, KNOWN)


def token_ids(column: pa.Array, path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of all rows of each slice, and how many each row has (null: none)."""

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[list[int]] = []
        for at in range(0, len(pieces), AT_A_TIME):
            part = [p.decode() for p in pieces[at : at + AT_A_TIME]]
            ids += [e.ids for e in _encoder(path).encode_batch_fast(part, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return lengths, np.fromiter((i for row in ids for i in row), np.uint32, lengths.sum())

    added = _with_added(column, path)
    for at, after, data, offsets in slices(column):
        start, end, counts = cut(data, offsets)
        hashes = word_hashes(data, start, end)
        ids, lengths = _memory(path).rows(data, hashes, start, end, encode)
        total = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.diff(total[np.concatenate([[0], np.cumsum(counts)])])
        if added[at:after].any():
            rows = np.split(ids, np.cumsum(counts)[:-1])
            for k in np.flatnonzero(added[at:after]).tolist():
                whole = _encoder(path, False).encode(column[at + k].as_py(), add_special_tokens=False)
                rows[k] = np.array(whole.ids, np.uint32)
            ids, counts = np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        yield ids, counts


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Piece lengths of a document of ``n`` ids: whole sequences, then binary digits."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", ids: bool = True,
    longest: int = LONGEST, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``key``, the columns ``PIECES`` and, if asked for, its ``ids``.

    ``tokenizer`` is the path of a tokenizer file on every machine, ``longest`` a
    power of two. Null and empty texts consist of the end id alone. Rows with
    equal keys are packed each for itself. ``sequence_id`` is the number of the
    input partition and the place in it, so it is the same when a task is run
    again; ``offset`` is 0, as a piece fills its sequence. Other columns of
    ``docs`` are not used.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest sequence must be a power of two")
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = narrow.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, {PIECES}" + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            keys, at = batch.column(0), 0
            for found, counts in token_ids(batch.column(1), tokenizer):
                rows, first = [], np.cumsum(counts) - counts
                pieces = []
                for k, n in enumerate(counts.tolist()):
                    own = np.append(found[first[k] : first[k] + n], np.uint32(end_id)).astype("<u4")
                    place = 0
                    for length in binary_lengths(n + 1, longest):
                        piece = own[place : place + length]
                        rows.append((at + k, place, length, zlib.crc32(piece), n + 1, sequence))
                        if ids:
                            pieces.append(piece)
                        sequence += 1
                        place += length
                at += len(counts)
                table = np.array(rows, np.int64).reshape(-1, 6)
                out = [keys.take(pa.array(table[:, 0]))]
                out += [pa.array(table[:, c]) for c in (1, 2, 3, 4, 5)]
                out += [pa.array(np.zeros(len(table), np.int64)), pa.array(table[:, 2])]
                names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
                if ids:
                    ends = np.concatenate([[0], np.cumsum(table[:, 2])]).astype(np.int32)
                    flat = np.concatenate(pieces) if pieces else np.zeros(0, "<u4")
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return narrow.mapInArrow(run, columns)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)
