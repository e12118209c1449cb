import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from segrisk.llm import buffers, queries, substrings, suffixes


def brute(texts, length):
    """n_bytes, n_removed, n_spans and digest of what is left, for each text."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def test_repeated_offsets_equal_brute_force():
    rng = random.Random(1)
    for trial in range(200):
        length, letters = rng.choice([4, 8, 12]), "ab" if trial % 2 else "a"
        items, group = [], []
        for g in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 9)):
                left = "".join(rng.choice(letters) for _ in range(rng.randint(0, length)))
                items.append((left, "xy" + "".join(rng.choice(letters) for _ in range(rng.randint(0, length - 2)))))
                group.append(g)
        data = np.frombuffer("".join(a + b for a, b in items).encode(), np.uint8)
        left, right = (np.array([len(x[k]) for x in items]) for k in (0, 1))
        texts = suffixes.Texts(data, np.cumsum(left + right) - right, left, right)
        got = suffixes.repeated_offsets(texts, np.array(group), length)

        def window(k, o):
            a, b = items[k]
            return a[len(a) - o :] + b[: length - o] if o <= len(a) and length - o <= len(b) else None

        for k in range(len(items)):
            others = [q for q in range(len(items)) if q != k and group[q] == group[k]]
            for o in range(got.shape[1]):
                w = window(k, o)
                assert got[k, o] == (w is not None and any(window(q, o) == w for q in others))


def test_equal_windows_share_an_anchor():
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdé") for _ in range(260))
    texts = ["".join(rng.choice("abcdé") for _ in range(rng.randint(0, 300))) for _ in range(8)]
    data = [f"{a}{passage[: rng.randint(200, 260)]}{b}".encode() for a, b in zip(texts[:4], texts[4:], strict=True)]
    offsets = np.cumsum([0, *map(len, data)])
    owner, place, before, after, key, _ = substrings.anchors(np.frombuffer(b"".join(data), np.uint8), offsets)
    shared = [set(key[owner == k]) for k in range(4)]
    assert set.intersection(*shared)
    assert (before <= place).all() and (after <= 200).all()


def corpus(seed=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghié") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(60), prose(90)
    texts = [prose(rng.randint(0, 120)) for _ in range(25)]
    texts += [f"{prose(10)} {passage} {prose(15)}" for _ in range(12)]
    texts += [passage[rng.randint(0, 60) :] + prose(5) + other[: rng.randint(150, 400)] for _ in range(12)]
    texts += [texts[0], texts[30], None, "", "a" * 199, "a" * 200, "b" * 201, "xy" * 150, "日本😀" * 60]
    edited = other.split()
    for k in range(0, len(edited), 30):
        edited[k] = "CHANGED"
    return [*texts, other, " ".join(edited), prose(3000), prose(100) + other + prose(40) + other]


@pytest.mark.parametrize("sorted_", [substrings.SORTED, 3])
def test_removal_equals_brute_force(spark, monkeypatch, sorted_):
    monkeypatch.setattr(substrings, "SORTED", sorted_)
    texts = corpus()
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(0, texts[0], "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, place int").repartition(3)
    found = sorted(tuple(r)[:5] for r in substrings.remove_repeats(docs).collect())
    wanted = brute([r[1] for r in rows], 200)
    assert found == sorted((r[0], *w) for r, w in zip(rows, wanted, strict=True))


def test_keep_unrepeated_keeps_columns(spark):
    texts = corpus()
    rows = [(i, t, "en", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    left = substrings.keep_unrepeated(docs)
    assert left.columns == docs.columns and left.schema.simpleString() == docs.schema.simpleString()
    wanted = {i: w[3] for i, w in enumerate(brute(texts, 200))}
    for r in left.collect():
        if texts[r["doc_id"]] is None:
            assert r["text"] is None
        elif "é" not in texts[r["doc_id"]] and "日" not in texts[r["doc_id"]]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == wanted[r["doc_id"]]
            assert r["n_chars"] == len(r["text"])
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = brute([r["text"] for r in rows], 200)
    found = {tuple(r)[:5] for r in queries.op8_suffix_dedup(spark, sf_dir).collect()}
    assert found == {(r["doc_id"], *w) for r, w in zip(rows, wanted, strict=True)}
    assert any(f[2] for f in found)


def test_surroundings_are_cut_out_some_at_a_time(monkeypatch):
    """Several times the bytes of the texts, they go out in batches of a bounded number, also those of one long text."""
    monkeypatch.setattr(substrings, "AT_A_TIME", 7)
    monkeypatch.setattr(buffers.slices, "__defaults__", (300,))
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé") for _ in range(n)) for n in (40, 0, 900, 90, 250)]
    lists = []
    for k, t in enumerate(texts):
        places = range(0, len(t.encode()), 9) if k != 3 else None
        size = len(t.encode())
        one = lambda p: {"key": p, "around": k, "n": 1, "kinds": 2, "place": p, "before": min(p, 5), "after": min(size - p, 20)}  # noqa: B023, E731
        lists.append(places and [one(p) for p in places])
    names = ("key", "around", "n", "kinds", "place", "before", "after")
    kind = pa.list_(pa.struct([(n, pa.int32() if n in names[4:] else pa.int64()) for n in names]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(lists, kind)], ["_text", "wanted"]).slice(1)
    out = list(substrings._surroundings(iter([batch])))
    assert len(out) > 2 and all(0 < len(b) <= 7 for b in out)
    wanted = [
        (w["key"], k, w["before"], texts[k].encode()[w["place"] - w["before"] : w["place"] + w["after"]])
        for k, own in enumerate(lists) if k for w in own or []
    ]
    rows = pa.Table.from_batches(out).to_pylist()
    assert [(r["key"], r["around"], r["before"], r["bytes"]) for r in rows] == wanted


@pytest.mark.parametrize("valid", [False, True])
def test_texts_are_cut_a_slice_at_a_time(monkeypatch, valid):
    monkeypatch.setattr(buffers.slices, "__defaults__", (100,))
    texts, spans = ["é" * 60, "", "abcdef" * 30, "x"], [[(3, 9), (1, 4)], None, [(0, 6), (170, 180)], []]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    found = pa.array([s and [{"start": a, "end": b} for a, b in s] for s in spans], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts), found], ["_key", "_text", "spans"])
    out = list(substrings._cut(iter([batch, batch.slice(4)]), "_key", valid))
    assert len(out) > 1
    rows = pa.Table.from_batches(out).to_pylist()
    raw = [texts[0].encode()[:1] + texts[0].encode()[9:], b"", (b"abcdef" * 30)[6:170], b"x"]
    assert [r["kept"] for r in rows] == [b.decode("utf-8", "ignore") if valid else b for b in raw]
    assert [(r["_key"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows] == [(0, 120, 8, 1), (1, 0, 0, 0), (2, 180, 16, 2), (3, 1, 0, 0)]
    assert [r["kept_sha256"] for r in rows] == [hashlib.sha256(b).hexdigest() for b in raw]


def test_cutting_takes_one_worker(spark, sf_dir):
    """The texts left come from one Python function: a task with two holds two workers, which stay for later stages."""
    docs = queries.documents(spark, sf_dir)
    plan = substrings.keep_unrepeated(docs)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "EvalPython" not in above and "Join" not in above
