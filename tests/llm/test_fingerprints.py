import hashlib

import pyarrow as pa
import pytest

from segrisk.llm import fingerprints, queries

LONG = " ".join(f"word{i}" for i in range(400))


def wanted(rows):
    """doc_id, n_chars and digest of the edited text by the definition."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 57])
def test_edited_text_of_next_document(spark, n):
    rows = [(i * 3, f"é{i} " * (i % 7) if i % 5 else None) for i in range(n)]
    rows += [(3, "again twice"), (None, "nobody")] if n > 2 else []
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    found = fingerprints.compare_edited(docs.repartition(4)).collect()
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found], key=str) == wanted(rows)
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert fingerprints.compare_edited(docs.limit(0)).count() == 0


def test_likeness_estimates_containment():
    part = " ".join(LONG.split()[:200])
    other = LONG.replace("word", "term")
    both = [fingerprints.sketches(pa.array(t)) for t in ([LONG, LONG, "", "", "a b"], [part, other, "", "x", "a b"])]
    near = fingerprints.likeness(*both)
    assert near[0] > 0.95 and near[1] == 0 and near[2:].tolist() == [1, 0, 1]


def test_fingerprints_merge():
    a, b = " ".join(LONG.split()[:204]), " ".join(LONG.split()[200:])
    whole, x, y = fingerprints.texts_of(*fingerprints.sketches(pa.array([LONG, a, b])))
    assert fingerprints.merge(x, y) == whole
    short = fingerprints.texts_of(*fingerprints.sketches(pa.array(["one", "one two three"])))
    assert all(short) and fingerprints.merge(*short) in (*short, "".join(sorted(short)))


def test_query_separates_edited_from_unrelated(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.op5_fingerprints(spark, sf_dir).collect()
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found], key=str) == wanted(rows)
    text = dict(rows)
    by_text = {}
    for r in found:
        assert by_text.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    long = [r for r in found if r["n_chars"] > 600]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)
