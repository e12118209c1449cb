import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

from segrisk.llm import bpe, buffers, fingerprints, jaccard, licenses, packing, piececache

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def twins(n=1024):
    """The Thue–Morse word of a and b, and its complement, whose polynomials modulo 2**64 are equal."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def arrays(pieces):
    data = np.frombuffer(b"".join(pieces), np.uint8)
    end = np.cumsum([len(p) for p in pieces])
    return data, end - [len(p) for p in pieces], end


def test_word_hashes_are_of_the_bytes():
    rng = random.Random(3)
    pieces = [bytes(rng.choices(b"ab\x00", k=rng.choice([1, 2, 7, 8, 9, 63, 64, 65, 200]))) for _ in range(4000)]
    pieces += [t.encode() for n in (16, 64, 128, 1024, 4096) for t in twins(n)]
    hashes = buffers.word_hashes(*arrays(pieces)).tolist()
    assert len(set(hashes)) == len(set(pieces)) == len(set(zip(hashes, pieces, strict=True)))


def test_same_words():
    rng = random.Random(5)
    one = [bytes(rng.choices(b"ab", k=rng.choice([1, 2, 3, 8, 9, 70]))) for _ in range(3000)]
    two = [bytes(rng.choices(b"ab", k=len(p))) if rng.random() < 0.5 else p for p in one]
    two[7] = two[7] + b"a"
    a, b = arrays(one), arrays(two)
    got = buffers.same_words(a[0], a[1], a[2] - a[1], b[0], b[1], b[2] - b[1])
    assert got.tolist() == [x == y for x, y in zip(one, two, strict=True)]


@pytest.mark.parametrize("limit", [0, 5, 1000])
def test_memory_survives_equal_hashes(limit):
    """All hashes equal, memories that start anew: every piece still gets its own values."""
    rng = random.Random(limit)
    memory = piececache.Memory(np.uint32, limit)

    def work_out(pieces):
        return [len(p) for p in pieces], np.frombuffer(b"".join(pieces), np.uint8)

    for _ in range(6):
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 3))) for _ in range(60)] + [b"x" * 100, b"x" * 99 + b"y"]
        data, start, end = arrays(pieces)
        values, lengths = memory.rows(data, np.zeros(len(pieces), np.uint64), start, end, work_out)
        assert values.astype(np.uint8).tobytes() == b"".join(pieces)
        assert lengths.tolist() == [len(p) for p in pieces]


def test_twins_get_their_own_ids():
    one, two = twins()
    column = pa.array([one, two, f"{two} {one}"])
    plain = Tokenizer.from_file(JSON)
    got = [x for ids, n in packing.token_ids(column, JSON) for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]
    whole = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS), special_tokens={})
    got = [x for ids, n in bpe.encode_column(column, RANKS) for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [g.tolist() for g in got] == [whole.encode_ordinary(t) for t in column.to_pylist()]


def test_twins_are_different_words():
    one, two = twins()
    column = pa.array([one, two])
    for made in (jaccard.shingle_sets(column), [buffers.word_shingles(d, o) for _, _, d, o in buffers.slices(column)]):
        (hashes, n), *_ = made
        assert n.tolist() == [1, 1] and hashes[0] != hashes[1]
    data, offsets = np.frombuffer((one + two).encode(), np.uint8), np.array([0, 1024, 2048])
    hashes = licenses._word_hashes(data, offsets)[0]
    assert hashes[0] != hashes[1]
    hashes, n = fingerprints.sketches(pa.array([f"{one} {k}" for k in range(200)] + [f"{two} {k}" for k in range(200)]), 1)
    assert len(np.unique(hashes)) == len(hashes) == 400


def test_twins_are_not_linked(spark):
    one, two = twins()
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_packing_reads_added_tokens_as_the_library_does():
    texts = ["a<|endoftext|>b", "<|endoftext|>", "plain", "", "x <|endoftext|> <|endoftext|>y", "<|endoftext", None]
    plain = Tokenizer.from_file(JSON)
    got = [x for ids, n in packing.token_ids(pa.array(texts * 3).slice(1), JSON) for x in np.split(ids, np.cumsum(n)[:-1])]
    wanted = [plain.encode(t or "", add_special_tokens=False).ids for t in (texts * 3)[1:]]
    assert [g.tolist() for g in got] == wanted


def test_memory_goes_back_after_each_column(monkeypatch):
    calls = []
    monkeypatch.setattr(buffers, "_trim", calls.append)
    for _ in buffers.slices(pa.array(["ab", None, "c" * 50]), 4):
        assert not calls
    assert len(calls) == 1
