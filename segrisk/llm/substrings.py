"""Removal of repeated substrings over a corpus: a sparse suffix array in regions of equal anchors.

1. Anchors: in every window of ``length`` bytes the gram of 32 bytes with the
   least hash is an anchor. Equal windows choose the same gram at the same
   place, so all copies of a window meet under the hash of its anchor. Anchors
   are about one in eighty bytes; those that occur once go at once.
2. Equal surroundings of an anchor (up to the window length on both sides) are
   counted, not compared: where they occur twice, every window in them is
   repeated. One row of each kind goes on.
3. Where an anchor has several surroundings, the suffixes at it and the reversed
   prefixes before it are sorted by a mergesort that compares prefix hashes
   (``suffixes``); neighbours give the longest agreement to either side and
   with it the windows that are repeated.
4. The spans go back to the documents, are merged and cut out.

No group meets in one task: counts combine before they are shuffled, and an
anchor with very many different surroundings is settled by counting the hashes
of its windows instead of sorting them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import give_back, mix, prefix_hashes, range_hashes, slices
from segrisk.llm.rowhash import quoted, row_hash
from segrisk.llm.suffixes import Texts, repeated_offsets, window_hashes
from segrisk.session import stored

LENGTH = 200
#: Bytes of an anchor.
GRAM = 32
#: Surroundings of one anchor that are sorted in one task (26 MB at most); with more their windows are counted.
SORTED = 1 << 16
#: Parts that an anchor with more is dealt in.
SALTS = 64
#: Surroundings that a task cuts out at a time, and those it sorts at a time, all of one anchor together.
AT_A_TIME = 8192


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """Least (or greatest) of every ``width`` values that follow each other."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Row, place, bytes before and after, hash of the gram and of the surroundings of every anchor.

    Rows shorter than ``length`` have none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    hashes = range_hashes(prefix, at, at + gram)
    value = np.maximum(hashes >> np.uint64(32), np.uint64(1)).astype(np.uint32)  # 0 is for windows that are not whole
    windows = length - gram + 1
    least = _sliding(value, windows, np.minimum, 0xFFFFFFFF)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[: len(least)] == row[np.arange(len(least)) + length - 1]
    least = np.where(whole, least, 0)
    # A place is an anchor if a whole window that holds its gram has its hash as the least.
    padded = np.concatenate([np.zeros(windows - 1, np.uint32), least, np.zeros(windows - 1, np.uint32)])
    best = _sliding(padded, windows, np.maximum, 0)
    place = np.flatnonzero((best == value) & (best > 0))
    owner = row[place]
    place, owner = (x[row[place + gram - 1] == owner] for x in (place, owner))
    before = np.minimum(place - offsets[owner], length - gram)
    after = np.minimum(offsets[owner + 1] - place, length)
    around = mix(range_hashes(prefix, place - before, place + after) + before.astype(np.uint64))
    return owner, place - offsets[owner], before, after, hashes[place], around


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["_row", "_crc", "place", "before", "after", "key", "around"]
    for batch in batches:
        for first, _, data, offsets in slices(batch.column(2)):
            owner, place, before, after, key, around = anchors(data, offsets, length)
            own = pa.array(owner + first)
            columns = [batch.column(0).take(own), batch.column(1).take(own)]
            columns += [pa.array(x.astype(np.int32)) for x in (place, before, after)]
            columns += [pa.array(x.view(np.int64)) for x in (key, around)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes around the wanted anchors of each text, some at a time: they are several times the texts."""
    names = ["key", "around", "n", "kinds", "before", "bytes"]
    for batch in batches:
        for first, after, data, offsets in slices(batch.column(0)):
            lists = batch.column(1).slice(first, after - first)
            count = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            found, begin, raw = lists.flatten(), np.repeat(offsets[:-1], count), data.tobytes()
            for at in range(0, len(found), AT_A_TIME):
                wanted = found.slice(at, AT_A_TIME).flatten()
                wanted = dict(zip((f.name for f in found.type), wanted, strict=True))
                place, before, size = (wanted[c].to_numpy() for c in ("place", "before", "after"))
                own = begin[at : at + AT_A_TIME] + place
                pieces = [raw[s:e] for s, e in zip((own - before).tolist(), (own + size).tolist(), strict=True)]
                columns = [wanted[c] for c in names[:5]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names)


def _texts(rows: pa.Table) -> Texts:
    pieces = rows["bytes"].cast(pa.large_binary()).combine_chunks()
    edges = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    before = rows["before"].to_numpy().astype(np.int64)
    size, start = np.diff(edges), edges[:-1] - edges[0]
    return Texts(data, start + before, before, size - before)


def _repeated(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs (low to high) of offsets of repeated windows of every surrounding; rows come ordered by anchor."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def settle(rows: pa.Table) -> pa.RecordBatch:
        # A row that occurs twice with its key gives the same surroundings twice.
        key, around = rows["key"].to_numpy(), rows["around"].to_numpy()
        again = (key[1:] == key[:-1]) & (around[1:] == around[:-1])
        rows = rows.take(pa.array(np.flatnonzero(np.append(True, ~again))))
        key = rows["key"].to_numpy()
        group = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        found = repeated_offsets(_texts(rows), group, length)
        return _found_runs(rows, found)

    for batch in batches:
        batch = batch.filter(pc.less_equal(batch["kinds"], most))
        waiting.append(batch)
        size += len(batch)
        if size >= AT_A_TIME:
            rows = pa.Table.from_batches(waiting)
            key = rows["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last anchor may go on
            if last:
                yield settle(rows.slice(0, last))
            waiting = rows.slice(last).to_batches()
            size = len(rows) - last
    if size:
        yield settle(pa.Table.from_batches(waiting))
    waiting = []
    give_back()


def _found_runs(rows: pa.Table, found: np.ndarray) -> pa.RecordBatch:
    edge = np.zeros((len(found), 1), bool)
    padded = np.hstack([edge, found, edge])
    item, low = np.nonzero(found & ~padded[:, :-2])
    _, high = np.nonzero(found & ~padded[:, 2:])
    return pa.RecordBatch.from_arrays(
        [*(rows[c].take(pa.array(item)).combine_chunks() for c in ("key", "around")),
         *(pa.array(x.astype(np.int32)) for x in (low, high))],
        ["key", "around", "low", "high"],
    )


def _windows(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[pa.RecordBatch]:
    """Hash of every window of the surroundings of anchors that have too many to be sorted."""
    for batch in batches:
        batch = batch.filter(pc.greater(batch["kinds"], most))
        for at in range(0, len(batch), 2000):
            rows = pa.Table.from_batches([batch.slice(at, 2000)])
            texts = _texts(rows)
            offset = np.arange(int(texts.left.max(initial=0)) + 1)
            item, back = np.nonzero((offset <= texts.left[:, None]) & (length - offset <= texts.right[:, None]))
            hashes = window_hashes(texts, item, back, length)
            columns = [rows[c].take(pa.array(item)).combine_chunks() for c in ("key", "around")]
            columns += [pa.array(back.astype(np.int32)), pa.array(hashes.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "around", "back", "window"])


def _cut(batches: Iterator[pa.RecordBatch], key: str, valid: bool) -> Iterator[pa.RecordBatch]:
    """The texts without their spans, a slice at a time; ``valid``: as strings, without split characters."""
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if valid else pa.binary()]
    for batch in batches:
        for row, after, data, offsets in slices(batch.column(1)):
            out = []
            lists = batch.column(2).slice(row, after - row)
            count = pc.list_value_length(lists).fill_null(0).to_pylist()
            spans = lists.flatten()
            starts, ends = (spans.field(c).to_pylist() for c in ("start", "end"))
            found, first = list(zip(starts, ends, strict=True)), 0
            for begin, end, k in zip(offsets[:-1].tolist(), offsets[1:].tolist(), count, strict=True):
                raw = data[begin:end].tobytes()
                parts, at, n = [], 0, 0
                runs: list[list[int]] = []
                for span in sorted(found[first : first + k]):
                    if runs and span[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span[1])
                    else:
                        runs.append(list(span))
                first += k
                for start, stop in runs:
                    parts.append(raw[at:start])
                    at, n = stop, n + stop - start
                kept = b"".join([*parts, raw[at:]])
                left = kept.decode("utf-8", "ignore") if valid else kept
                out.append((len(raw), n, len(runs), hashlib.sha256(kept).hexdigest(), left))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, after - row), *columns], names)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of every document.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else in the texts, overlaps included. Null and empty texts have no
    bytes. Rows with equal key and text are told apart only by their number, and both lose what they share.
    What is left of a text may begin or end inside a character.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(
        F.col(key).alias("_key"),
        F.xxhash64(F.col(key), whole).alias("_row"),
        F.crc32(whole).cast("long").alias("_crc"),
        whole.alias("_text"),
    )
    return _remove(base, length).withColumnRenamed("_key", key)


def _remove(base: DataFrame, length: int, valid: bool = False) -> DataFrame:
    """base: _key (any type), _row and _crc (name a row), _text. ``valid``: what is kept is a string."""
    kind = base.schema["_key"].dataType.simpleString()
    found = base.select("_row", "_crc", "_text").mapInArrow(
        lambda batches: _anchor_rows(batches, length),
        "_row long, _crc long, place int, before int, after int, key long, around long",
    )
    twice = found.groupBy("key").count().filter("count > 1").select("key")
    repeated = stored(found.join(twice, "key", "left_semi"), "anchors")

    kinds = repeated.groupBy("key", "around").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("_row", "_crc", "place", "before", "after")).alias("one"),
    )
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    known = kinds.join(several, "key")
    wanted = (
        known.filter("kinds > 1")
        .select("one._row", "one._crc", F.struct("key", "around", "n", "kinds", "one.place", "one.before", "one.after").alias("w"))
        .groupBy("_row", "_crc")
        .agg(F.collect_list("w").alias("wanted"))
    )
    shown = (
        base.join(wanted, ["_row", "_crc"], "left")
        .select("_text", "wanted", "_key", "_row", "_crc")
        .mapInArrow(_surroundings, "key long, around long, n long, kinds long, before int, bytes binary")
    )
    # Both ways read the same shuffle, and each takes its own rows from it.
    limit = SORTED
    salt = F.when(F.col("kinds") > limit, F.pmod("around", F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    dealt = shown.withColumn("salt", salt).repartition("key", "salt")
    ordered = dealt.sortWithinPartitions("key", "around")
    sorted_ = ordered.mapInArrow(lambda b: _repeated(b, length, limit), "key long, around long, low int, high int")
    windows = dealt.mapInArrow(lambda b: _windows(b, length, limit), "key long, around long, back int, window long")
    least, most = F.min("around").alias("least"), F.max("around").alias("most")
    common = windows.groupBy("key", "back", "window").agg(least, most).filter("least < most").select("key", "back", "window")
    counted = windows.join(common, ["key", "back", "window"], "left_semi").select("key", "around", "back")
    # Runs of offsets: those of one surrounding are at most as many as a window is long.
    runs = (
        counted.groupBy("key", "around")
        .agg(F.sort_array(F.collect_set("back")).alias("b"))
        .select("key", "around", F.explode(_runs(F.col("b"))).alias("run"))
        .select("key", "around", "run.low", "run.high")
    )
    full = known.filter("n > 1").select(
        "key", "around",
        F.greatest(F.lit(0), length - F.col("one.after")).alias("low"), F.col("one.before").alias("high"),
    )
    settled = sorted_.unionByName(runs).unionByName(full.filter("low <= high"))
    spans = (
        repeated.join(settled, ["key", "around"])
        .select("_row", "_crc", F.struct((F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + length).alias("end")).alias("span"))
        .groupBy("_row", "_crc")
        .agg(F.collect_set("span").alias("spans"))
    )
    return (
        base.join(spans, ["_row", "_crc"], "left")
        .select("_key", "_text", "spans")
        .mapInArrow(
            lambda b: _cut(b, "_key", valid),
            f"_key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {'string' if valid else 'binary'}",
        )
    )


def _runs(offsets):
    """Runs (low, high) of the ascending numbers of an array column."""
    begins = lambda b: F.filter(b, lambda x, i: F.coalesce(F.get(b, i - 1) + 1 != x, F.lit(True)))
    ends = lambda b: F.filter(b, lambda x, i: F.coalesce(F.get(b, i + 1) - 1 != x, F.lit(True)))
    return F.arrays_zip(begins(offsets).alias("low"), ends(offsets).alias("high"))


def keep_unrepeated(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated substrings cut out of the text; all other columns stay.

    A character that a cut splits is dropped. ``n_chars``, where present, is set to the new length.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    others = [quoted(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    others[docs.columns.index(text)] = F.col(text).isNull().alias("none")
    base = docs.select(
        F.struct(*others).alias("_key"),
        row_hash(docs).alias("_row"),
        F.crc32(whole).cast("long").alias("_crc"),
        whole.alias("_text"),
    )

    # One function cuts and decodes: a second one beside it would take a Python worker more for every task.
    left = _remove(base, length, valid=True).select("_key", F.when(~F.col("_key.none"), F.col("kept")).alias("_left"))
    new = []
    for k, c in enumerate(docs.columns):
        if c == text:
            new.append(F.col("_left").alias(c))
        elif c == "n_chars":
            new.append(F.length("_left").cast(docs.schema[c].dataType).alias(c))
        else:
            new.append(F.col(f"_key.c{k}").alias(c))
    return left.select(*new)
