import zlib

import pytest
from pyspark.sql import functions as F

from segrisk.llm import langid, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", SF])
def test_held_out_languages(spark, sf_dir):
    given = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op1_language_id(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(given)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    right = [r["lang_pred"] == given[r["doc_id"]]["lang"] for r in found if r["held_out"]]
    long = [r["lang_pred"] == given[r["doc_id"]]["lang"] for r in found if r["held_out"] and len((given[r["doc_id"]]["text"] or "").split()) > 50]
    assert sum(right) >= 0.95 * len(right) and sum(long) >= 0.97 * len(long)


def test_held_out_labels_and_other_columns_are_not_seen(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    changed = docs.withColumns({"lang": F.when(out, F.lit("xx")).otherwise(F.col("lang")), "source": F.lit("s"), "n_chars": F.lit(0)})
    changed.write.parquet(f"{tmp_path}/documents.parquet")
    first, second = ({r["doc_id"]: tuple(r) for r in queries.op1_language_id(spark, sf).collect()} for sf in (SF, str(tmp_path)))
    assert first.keys() == second.keys()
    assert all(first[k][:3] == second[k][:3] and first[k][3] == pytest.approx(second[k][3], abs=1e-6) for k in first)


def test_whole_texts_teach(spark):
    """A label that shows only after a long head in another language."""
    head, own = "la maison est dans le jardin avec un chat ", "der hund und die katze sind nicht auf dem dach "
    rows = [(i, head * 60 + own * 40, "de") for i in range(60)] + [(1000 + i, head * (20 + i % 30), "fr") for i in range(400)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = spark.createDataFrame([(own * 5,), (head * 5,)], "t string").select(langid.guess(model, F.col("t")).alias("p")).collect()
    assert [r["p"]["lang_pred"] for r in found] == ["de", "fr"]


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrst"
    rows = [(i, f"{a}{b}{a} {b}{a}{b} " * 8, f"{a}{b}") for i in range(3) for a in letters for b in letters if a < b] * 2
    model = langid.train([r[1] for r in rows], [r[2] for r in rows])
    assert len(model.languages) == 190


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !", "en"), (None, "the dog", None), (4, "word " * 300_000, "en"), (4, "the cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for given in (docs, docs.limit(0), docs.where("lang IS NULL")):
        model = langid.fit(given)
        found = docs.select("text", langid.guess(model, F.col("text")).alias("p")).collect()
        for r in found:
            if not any(c.isalpha() for c in r["text"] or ""):
                assert tuple(r["p"]) == ("und", 0.0, True)
            else:
                assert r["p"]["lang_pred"] == (model.languages[0] if model.languages else "und")
