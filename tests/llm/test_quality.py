import re

import pytest

from oracle_check import connect, spark_rows, sql_rows
from segrisk.llm import quality, queries

WORD = re.compile(r"[^\x20\t-\r]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(hit),
    )


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e", "a b c d e " * 3, "x\n\nx\nx \ny",
    "the cat of the dog is in a house and it was on the mat " * 2,
    "é 日本 😀 #*$%&|<> !!", "a b c\x0bd\x0ce", "w " * 5000,
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, t, True, "k") for i, t in enumerate(TEXTS)] + [(0, None, True, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, _m string")
    return quality.judge(docs).collect()


def test_counts_equal_brute_force(judged):
    assert len(judged) == len(TEXTS) + 1
    for row in judged:
        m = row["_m"]
        got = (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"])
        assert got == brute(TEXTS[row["doc_id"]])


def test_keep_good_returns_own_columns(spark):
    prose = "The cat of the house is in a garden and it was on the mat with that dog"
    rows = [(1, prose, "a"), (1, prose, "a"), (2, None, "b"), (3, "the ## of ** the || and $$ to a in is that", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1]
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = queries.op6_quality_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_equals_sql(spark, sf_dir):
    mine = spark_rows(queries.op6_quality_rules(spark, sf_dir))
    assert mine == sql_rows(connect(sf_dir), queries.TEXT_ORACLE["op6_quality_rules"])
