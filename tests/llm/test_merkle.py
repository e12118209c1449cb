import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from oracle_check import connect, spark_rows, sql_rows
from segrisk.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, n int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """Result rows by the definition, one tree at a time."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))

    def reduce(nodes):
        """Top, and for every node its siblings (before, after) level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                family = nodes[p // 8 * 8 : p // 8 * 8 + 8]
                paths[i].append((family[: p % 8], family[p % 8 + 1 :]))
            at = [p // 8 for p in at]
            nodes = [digest(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        return nodes[0], paths

    below = []
    for g in order:
        trees[g].sort(key=lambda x: x[:3])
        below.append(reduce([x[2] for x in trees[g]]))
    root, upper = reduce([top for top, _ in below])
    out = []
    for g, (subroot, paths), tail in zip(order, below, upper, strict=True):
        for (_, key, leaf, row), path in zip(trees[g], paths, strict=True):
            key = row["doc_id"]
            bad = key is not None and zlib.crc32(str(key).encode()) % 3 == 0
            hash_, proof = leaf_of(row, lowered(row["text"])) if bad else leaf, ""
            for before, after in [*path, *tail]:
                hash_ = digest(*before, hash_, *after)
                proof += "".join(before) + "".join(after)
            out.append((key, leaf, subroot, root, digest(proof), hash_, hash_ == root))
    return sorted(out, key=str)


def run(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return sorted(map(tuple, merkle.document_manifest(docs, F.coalesce(tampered, F.lit(False))).collect()), key=str)


def table(sizes):
    rows, at = [], 0
    for lang, n in sizes:
        for i in range(n):
            text = None if i % 11 == 3 else "" if i % 11 == 5 else f"Text É {i} of {lang}"
            rows.append((at * 7 % 100003, text, lang, None if i % 5 == 0 else f"s{i % 3}", None if i % 4 == 0 else i, "x", 1))
            at += 1
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        [("en", 1)],
        [("en", 3)],
        [(None, 1), ("de", 1)],
        [("en", 8), ("de", 9), (None, 64), ("", 1)],
        [("en", 65), ("é", 2), ("z", 1)],
        [(f"l{i:02}", 1 + i % 10) for i in range(70)],
    ],
)
def test_small_trees_equal_brute_force(spark, sizes):
    docs = spark.createDataFrame(table(sizes), SCHEMA)
    assert run(docs.repartition(3)) == brute(docs.collect())


def test_blocks_equal_brute_force(spark, monkeypatch):
    """Trees over several blocks, with blocks of 64 leaves."""
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "SPAN", 64)
    docs = spark.createDataFrame(table([("en", 1200), (None, 130), ("fr", 64), ("x", 1)]), SCHEMA)
    assert run(docs) == brute(docs.collect())


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(5, "A", "en", "s", 1, "x", 1)] * 10 + [(None, "B", "en", None, None, "x", 1)] * 2 + [(5, None, "en", "s", 1, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert run(docs) == brute(docs.collect())
    assert run(docs.limit(0)) == []


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "Ab é " * 400_000, "en", "s", 2, "x", 1), (2, "b", "en", "s", 1, "x", 1)], SCHEMA)
    assert run(docs) == brute(docs.collect())


def test_query_equals_brute_force_and_sql(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = queries.op13_merkle_manifest(spark, sf_dir)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert spark_rows(found) == sql_rows(connect(sf_dir), queries.TEXT_ORACLE["op13_merkle_manifest"])
