"""Byte-level BPE by DuckDB recursive queries, one small database per Python worker.

Spark deals the documents; each task cuts its texts into pre-tokens and hands the
distinct ones it has not met to DuckDB as token-position rows. A recursive query
joins every adjacent pair with the merge table and contracts each pre-token's
leftmost pair of least rank until none is left. An ordered aggregation of the
last rows gives the ids, and, over the vocabulary, the bytes they decode to. The ids
of whole texts are decoded by an aggregation of their own.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import slices, word_hashes
from segrisk.llm.piececache import Memory
from segrisk.llm.pretokens import cut

#: Bytes of pre-tokens per recursive query.
CHUNK = 400_000
#: The rows of a recursion grow with the square of a pre-token's length; longer
#: ones (bytes) are contracted in the same order with a heap.
LONG = 256
#: Ids that are decoded at a time; a longer list is decoded in parts.
DECODED = 200_000

ENCODE = """
WITH RECURSIVE state(step, w, p, id, next_id) AS (
  SELECT 0, w, p, id, coalesce(lead(id) OVER (PARTITION BY w ORDER BY p), -1) FROM tok
  UNION ALL (
    WITH pairs AS (
      SELECT step, w, p, id, next_id, rank FROM state LEFT JOIN merges ON pair = id::BIGINT * 65536 + next_id
    ), best AS (
      SELECT w, min(rank::BIGINT * 1048576 + p) AS b FROM pairs WHERE rank IS NOT NULL GROUP BY w
    ), live AS (
      SELECT step, pairs.w, p, id, next_id, (b >> 20)::INTEGER AS new_id, (b & 1048575)::INTEGER AS spot
      FROM pairs JOIN best USING (w)
    ), gone AS (
      SELECT w, min(p) AS p, arg_min(next_id, p) AS next_id FROM live WHERE p > spot GROUP BY w
    ), before AS (
      SELECT w, max(p) AS p FROM live WHERE p < spot GROUP BY w
    )
    SELECT step + 1, live.w, live.p,
           CASE WHEN live.p = spot THEN new_id ELSE id END,
           CASE WHEN live.p = spot THEN gone.next_id WHEN live.p = before.p THEN new_id ELSE live.next_id END
    FROM live LEFT JOIN gone USING (w) LEFT JOIN before USING (w)
    WHERE live.p IS DISTINCT FROM gone.p
  )
), last AS (
  SELECT w, max(step) AS step FROM state GROUP BY w
)
SELECT w, list(id ORDER BY p) AS ids, string_agg(hex, '' ORDER BY p) AS hex
FROM state JOIN last USING (w, step) JOIN vocabulary USING (id)
GROUP BY w ORDER BY w
"""

DECODE = """
SELECT r, string_agg(hex, '' ORDER BY p) AS hex
FROM ids JOIN vocabulary USING (id) GROUP BY r ORDER BY r
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Tables:
    """Ranks as tables of a DuckDB database in memory: merges (pair, rank) and vocabulary (id, hex)."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (self.ranks[token[:k]] * 65536 + self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        merges = pa.table({"pair": [p for p, _ in pairs], "rank": pa.array([r for _, r in pairs], pa.int32())})
        vocabulary = pa.table(
            {"id": pa.array(list(self.token), pa.int32()), "hex": [t.hex() for t in self.token.values()]}
        )
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def rows(self, name: str, given: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, given)
        found = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return found

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        ids: list[list[int]] = [[]] * len(pieces)
        short = [k for k, piece in enumerate(pieces) if len(piece) <= LONG]
        lengths = np.array([len(pieces[k]) for k in short], np.int64)
        chunk = np.cumsum(lengths) // CHUNK
        edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1)) if len(short) else np.zeros(0, int)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            n = lengths[a:b]
            data = np.frombuffer(b"".join(pieces[k] for k in short[a:b]), np.uint8)
            tok = {
                "w": np.repeat(np.arange(len(n), dtype=np.int32), n),
                "p": (np.arange(len(data)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32),
                "id": self.byte_ids[data],
            }
            found = self.rows("tok", pa.table(tok), ENCODE)
            for k, own in zip(short[a:b], found["ids"].to_pylist(), strict=True):
                ids[k] = own
        for k, piece in enumerate(pieces):
            if len(piece) > LONG:
                ids[k] = contract(piece, self.ranks)
        return ids

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of lists of ids, which follow each other in ``ids`` with ``counts`` each."""
        parts: list[list[bytes]] = [[] for _ in counts]
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        for at in range(0, len(ids), DECODED):
            own = row[at : at + DECODED]
            given = {"r": own, "p": np.arange(len(own), dtype=np.int32), "id": ids[at : at + DECODED].astype(np.int32)}
            found = self.rows("ids", pa.table(given), DECODE)
            for r, text in zip(found["r"].to_pylist(), found["hex"].to_pylist(), strict=True):
                parts[r].append(bytes.fromhex(text))
        return [b"".join(x) for x in parts]


def contract(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction for a long piece: a heap of pairs by rank, then place."""
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    token = [piece[i : i + 1] for i in range(n)]
    heap = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)

    def push(i: int) -> None:
        j = after[i]
        if i >= 0 and j < n and (r := ranks.get(token[i] + token[j])) is not None:
            heapq.heappush(heap, (r, i, token[i], token[j]))

    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if token[i] != left or j >= n or token[j] != right:
            continue
        token[i], token[j] = left + right, b""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[t] for t in token if t]


@functools.cache
def _tables(path: str) -> Tables:
    return Tables(path)


@functools.cache
def _memory(path: str) -> Memory:
    return Memory(np.uint32, 1_500_000)


def encode_column(column: pa.Array, path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each slice: all ids, and ids per row."""

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = _tables(path).encode(pieces)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return lengths, np.fromiter((i for row in ids for i in row), np.uint32, lengths.sum())

    for _, _, data, offsets in slices(column):
        start, end, counts = cut(data, offsets)
        hashes = word_hashes(data, start, end)
        ids, n_ids = _memory(path).rows(data, hashes, start, end, encode)
        row = np.concatenate([[0], np.cumsum(counts)])
        yield ids, np.diff(np.concatenate([[0], np.cumsum(n_ids)])[row])


def encode(docs: DataFrame, ranks: str, text: str = "text", key: str = "doc_id", ids: bool = True) -> DataFrame:
    """``key``, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of every whole text.

    decoded_sha256 is of the bytes that the document's ids decode to.
    ``ranks`` is the path of a rank file on every machine. Special tokens in a
    text are ordinary text. Null and empty texts have no ids. Repeated rows each
    get a row; other columns of ``docs`` are not used.
    """
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = narrow.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found, n_ids in encode_column(batch.column(1), ranks):
                flat, e = found.astype("<u4").tobytes(), np.cumsum(n_ids) * 4
                sha = [hashlib.sha256(flat[b - n * 4 : b]).hexdigest() for b, n in zip(e.tolist(), n_ids.tolist(), strict=True)]
                back = [hashlib.sha256(raw).hexdigest() for raw in _tables(ranks).decode(found, n_ids)]
                out = [batch.column(0).slice(at, len(n_ids)), pa.array(n_ids), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    ends = np.concatenate([[0], np.cumsum(n_ids)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32))))
                    names.append("ids")
                at += len(n_ids)
                yield pa.RecordBatch.from_arrays(out, names)

    return narrow.mapInArrow(run, columns + (", ids array<int>" if ids else ""))


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``raw``, the bytes of every list of ids (null or empty list: empty)."""
    narrow = encoded.select(F.col(key), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids"))
    kind = narrow.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            raw = _tables(ranks).decode(lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [key, "raw"])

    return narrow.mapInArrow(run, f"`{key}` {kind}, raw binary")
