import base64
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from segrisk.llm import bpe, buffers, packing, pretokens, queries, tokencounts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )


def odd_texts(n=400, seed=3):
    rng = random.Random(seed)
    letters = "aB sé'' \n\t 12!?srevltmd 　日本😀½́  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["", None, " ", "\n", "<|endoftext|>", "ab" * 300, "x" * 1025, "it's they'll we've 'tis don't '", "=" * 700]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(odd_texts())] + [(0, "again", 0, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, length long, ids string").repartition(3)


def test_cut_equals_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = odd_texts(3000, 9)
    for first, end, data, offsets in buffers.slices(pa.array(texts, pa.string()), 500):
        start, stop, counts = pretokens.cut(data, offsets)
        raw = data.tobytes()
        mine = [raw[a:b].decode() for a, b in zip(start, stop, strict=True)]
        expected = [pattern.findall(t or "") for t in texts[first:end]]
        assert mine == [m for row in expected for m in row]
        assert counts.tolist() == [len(row) for row in expected]


def test_encode_equals_library_and_round_trips(docs):
    own = library()
    text = {(r["doc_id"], r["length"], r["ids"]): r["text"] or "" for r in docs.collect()}
    encoded = bpe.encode(docs, RANKS)
    back = {(r["doc_id"], bytes(r["raw"])) for r in bpe.decode(encoded, RANKS).collect()}
    wanted = {(k[0], t.encode()) for k, t in text.items()}
    assert back == wanted
    rows = {(r["doc_id"], tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in encoded.collect()}
    for (doc_id, _, _), t in text.items():
        ids = own.encode_ordinary(t)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (doc_id, tuple(ids), sha, hashlib.sha256(t.encode()).hexdigest()) in rows
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_long_piece_contracts_alike():
    rng, own, ranks = random.Random(1), library(), bpe.read_ranks(RANKS)
    for n in (2, 50, 400):
        piece = "".join(rng.choice("abest") for _ in range(n)).encode()
        assert bpe.contract(piece, ranks) == own._encode_single_piece(piece)


def test_bpe_query_equals_library(spark, sf_dir):
    own = library()
    found = {r["doc_id"]: r for r in queries.op3_byte_bpe(spark, sf_dir).collect()}
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(table)
    for row in table:
        ids = own.encode_ordinary(row["text"])
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()


def check_pieces(pieces, expected):
    """expected: key to ids with the end id; keys are distinct."""
    by_key = {}
    for p in pieces:
        by_key.setdefault(p["doc_id"], []).append(p)
    assert by_key.keys() == expected.keys()
    for key, ids in expected.items():
        place = 0
        for p in sorted(by_key[key], key=lambda p: p["start"]):
            own = np.array(ids[place : place + p["length"]], "<u4")
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (place, len(ids), zlib.crc32(own.tobytes()))
            assert p["length"].bit_count() == 1 and p["length"] <= packing.LONGEST and p["offset"] == 0
            place += p["length"]
        assert place == len(ids)
        assert len(by_key[key]) == len(packing.binary_lengths(len(ids)))
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)


def test_pieces_cover_every_id(docs):
    tokenizer = Tokenizer.from_file(JSON)
    one = docs.filter("doc_id > 0")
    expected = {
        r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in one.collect()
    }
    pieces = packing.pack(one, JSON).collect()
    check_pieces(pieces, expected)
    for p in pieces:
        assert p["ids"] == expected[p["doc_id"]][p["start"] : p["start"] + p["length"]]
    assert packing.pack(docs.limit(0), JSON).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, JSON, longest=1000)


def test_packing_query(spark, sf_dir):
    tokenizer = Tokenizer.from_file(JSON)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [0] for r in table}
    check_pieces(queries.op2_packing(spark, sf_dir).collect(), expected)


def test_write_buckets(docs, tmp_path, spark):
    packing.write_buckets(packing.pack(docs, JSON), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.filter("bucket != length or size(ids) != length").count() == 0 and back.count() > 0


def plain_count(word, scores, longest, byte):
    """The best path of one word, without sharing."""
    own = tokencounts.MARK + word
    best = [(0.0, 0)]
    for i in range(1, len(own) + 1):
        n = len(own[i - 1].encode())
        ways = [(best[i - 1][0] + n * byte, best[i - 1][1] + n)]
        ways += [(best[j][0] + scores[own[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if own[j:i] in scores]
        best.append(max(ways, key=lambda w: (w[0], -w[1])))
    return best[-1][1]


def test_token_counts(docs):
    scores, longest, byte = tokencounts.vocabulary(PIECES)
    assert longest < 100 and all(s <= 0 and math.isfinite(s) for s in scores.values())
    split = regex.compile(r"[^\x20\t-\r]+")
    wanted = sorted(
        (r["doc_id"], len(ws), sum(plain_count(w, scores, longest, byte) for w in ws))
        for r in docs.collect()
        for ws in [split.findall(r["text"] or "")]
    )
    got = sorted(tuple(r) for r in tokencounts.count(docs, PIECES).collect())
    assert got == wanted
    assert tokencounts.count(docs.limit(0), PIECES).count() == 0


def test_token_count_query(spark, sf_dir):
    scores, longest, byte = tokencounts.vocabulary(PIECES)
    known = {}
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in queries.op9_token_counts(spark, sf_dir).collect()}
    for row in table:
        words = regex.findall(r"[^\x20\t-\r]+", row["text"])
        for w in words:
            known[w] = known.get(w) or plain_count(w, scores, longest, byte)
        assert found[row["doc_id"]] == (len(words), sum(known[w] for w in words))


def test_rank_file_is_base64():
    with open(RANKS, "rb") as lines:
        assert base64.b64decode(lines.readline().split()[0])


def test_digest_is_of_the_decoded_ids(monkeypatch):
    """Ids in a wrong order show in the digest; lists longer than a part are decoded whole."""
    tables = bpe.Tables(RANKS)
    text = "one two three " * 50
    (ids, counts), *_ = bpe.encode_column(pa.array([text, "", "end"]), RANKS)
    monkeypatch.setattr(bpe, "DECODED", 7)
    assert tables.decode(ids, counts) == [text.encode(), b"", b"end"]
    turned = tables.decode(ids[::-1], counts[::-1])
    assert turned[2] != text.encode() and sorted(b"".join(turned)) == sorted(text.encode() + b"end")
