import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_jaccard import roots, shingles
from test_quality import brute as counts
from test_substrings import brute as cuts
from tokenizers import Tokenizer

from segrisk.llm import langid, packing, quality

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def good(text):
    n, chars, symbols, dup, repeat = counts(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    stops = sum(w in set(quality.STOP_WORDS) for w in text.split(" ") for w in w.split())
    return (
        n >= 10
        and 100 * repeat <= 20 * n
        and 2 * n <= chars <= 15 * n
        and 10 * symbols <= n
        and 10 * text.count("!") <= 3 * n
        and 10 * dup <= 4 * len(lines)
        and (n < 40 or 50 * stops >= n)
    )


def test_quality_stage_equals_brute_force(spark, docs, sf_dir):
    kept = STAGE["quality_rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted(tuple(r) for r in docs.collect() if good(r["text"]))


def test_language_stage_equals_model(spark, docs, sf_dir):
    odd = docs.limit(0).unionByName(docs).unionByName(
        spark.createDataFrame([(-1, None, "en", "x", 0), (-2, "123 456", "en", "x", 7), (-3, "", None, "x", 0)], docs.schema)
    )
    kept = rows_of(STAGE["language_id"](spark, odd, sf_dir))
    model = langid.fit(odd)
    table = [tuple(r) for r in odd.collect()]
    _, score = langid.predict(model, pa.array([r[1] or "" for r in table], pa.string()))
    letters = [any(c.isalpha() for c in r[1] or "") for r in table]
    assert kept == sorted(r for r, s, a in zip(table, score, letters, strict=True) if a and s >= model.threshold)
    assert len(kept) >= 0.98 * docs.count()


def test_join_stage_keeps_one_of_each_group(spark, docs, sf_dir):
    table = [tuple(r) for r in docs.collect()]
    kept = rows_of(STAGE["ngram_jaccard_join"](spark, docs.unionByName(docs.limit(3)), sf_dir))
    sets = [shingles(r[1]) for r in table]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for k, i in enumerate(h) for j in h[:k]}
    root = roots(len(table), [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    least = {}
    for r, row in zip(root, table, strict=True):
        least[r] = min(least.get(r, row), row)
    assert kept == sorted(least.values()) and len(kept) < len(table)


def test_substring_stage_equals_brute_force(spark, docs, sf_dir):
    table = sorted(tuple(r) for r in docs.collect())
    kept = STAGE["suffix_array_dedup"](spark, docs, sf_dir)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    left = {r["doc_id"]: r for r in kept.collect()}
    assert len(left) == len(table)
    for row, (_, removed, _, _) in zip(table, cuts([r[1] for r in table], 200), strict=True):
        new = left[row[0]]
        assert new["n_chars"] == len(new["text"])
        gone = len(row[1].encode()) - len(new["text"].encode())
        assert removed <= gone <= removed + 12 and (removed or new["text"] == row[1])


def test_run_packs_what_is_left(spark, sf_dir, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        assert 0 < kept.count() <= docs.count(), name
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [0] for r in kept.collect()}
    pieces = corpus_pipeline.run(spark, sf_dir).orderBy("doc_id", "start").collect()
    found = {}
    for p in pieces:
        assert p["start"] == len(found.setdefault(p["doc_id"], [])) and p["length"] <= packing.LONGEST
        found[p["doc_id"]] += p["ids"]
    assert found == ids
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)


def test_stages_take_empty_and_null_tables(spark, docs, sf_dir):
    nulls = docs.limit(2).select(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    for start in (docs.limit(0), nulls):
        for _, stage in corpus_pipeline.STAGES:
            left = stage(spark, start, sf_dir)
            assert left.count() <= 2
    assert np.isfinite(packing.LONGEST)


@pytest.mark.parametrize("stage", ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup"])
def test_stages_take_columns_of_any_name_and_kind(spark, docs, sf_dir, stage):
    """A dot in a name and a map, beside the rows that the stage returns without them."""
    odd = docs.withColumn("a.b", F.lit("x")).withColumn("_row", F.create_map(F.col("source"), F.col("doc_id")))
    kept = STAGE[stage](spark, odd, sf_dir)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert all(r["a.b"] == "x" and r["_row"] == {r["source"]: r["doc_id"]} for r in rows)
    assert sorted(tuple(r)[:-2] for r in rows) == rows_of(STAGE[stage](spark, docs, sf_dir))
