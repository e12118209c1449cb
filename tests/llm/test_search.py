import math
import random
import re

import numpy as np
import pytest

from oracle_check import connect, spark_rows, sql_rows
from segrisk.llm import queries, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item, rank, key, score) by the definition."""
    bags = [(key, terms(text)) for key, text in docs]
    bags = [(key, bag) for key, bag in bags if bag]
    n_docs, length = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, bag in bags:
        for t in set(bag):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        rows = []
        for key, bag in bags:
            m = 100 - 90 + (90 * len(bag) * n_docs) // length
            score = 0
            for t in set(terms(text)):
                tf = bag.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                rows.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def made(seed, n_docs, n_items):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É日本", "Ab", "x-y", "ÄB9", "🙂"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words[: rng.choice([5, 20, 45])]) for _ in range(n))
    docs = [(i * 3 % 101, rng.choice([None, "", "...", text(rng.randrange(60))]) if i % 6 == 0 else text(rng.randrange(1, 60))) for i in range(n_docs)]
    return docs, [(i, text(rng.randrange(25))) for i in range(n_items)]


def run(spark, docs, items, **args):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, item_id string")
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, rank int")
    return sorted(map(tuple, search.search(d.repartition(3), i, **args).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_ranks_equal_brute_force(spark, seed):
    docs, items = made(seed, 150, 30)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_items_and_small_tables_of_cells(spark, monkeypatch):
    docs, items = made(9, 80, 25)
    monkeypatch.setattr(search, "CELLS", 500)
    assert run(spark, docs, items, block_terms=60, k=3) == brute(docs, items, 3)


def test_ties_repeats_nulls_and_empty_tables(spark):
    docs = [(5, "a b"), (5, "a b"), (3, "a b"), (None, "a b"), (9, "c"), (8, None), (7, "")] + [(100 + i, "a c") for i in range(15)]
    items = [(1, "A a a"), (1, "A a a"), (2, None), (3, "!!"), (None, "b"), (4, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs[:0], items) == [] and run(spark, docs, items[:0]) == [] and run(spark, [(1, None)], items) == []


def test_long_texts(spark):
    docs = [(1, "alpha beta " * 200_000), (2, "beta"), (3, " ".join(f"t{i}" for i in range(30_000)))]
    items = [(1, "beta t7"), (2, " ".join(f"t{i}" for i in range(3000)))]
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize(("group", "most"), [(2, 0.7), (64, 0.5)])
def test_graph_adds_up_every_item_once(monkeypatch, group, most):
    monkeypatch.setattr(search, "GROUP", group)
    rng = np.random.default_rng(1)
    items = [[b"t%d" % t for t in set(rng.zipf(1.3, 40).clip(max=60).tolist())] for _ in range(50)] + [[]]
    plan = search.mine(items)
    assert plan.shared > 10
    n = len(plan.terms)
    sets = [np.zeros(n, int) for _ in range(plan.sets)]
    for t, s in enumerate(plan.base):
        sets[s][t] += 1
    for nodes, left, right in plan.steps:
        for node, a, b in zip(nodes, left, right, strict=True):
            sets[node] = sets[a] + sets[b]
    for i, item in enumerate(items):
        own = sum((sets[s] for s in plan.parts[plan.start[i] : plan.start[i + 1]]), np.zeros(n, int))
        assert own.tolist() == [int(t in item) for t in sorted(plan.terms)]
    assert len(plan.parts) < most * sum(map(len, items)), "items share sums"


def test_query_equals_sql_and_brute_force(spark, sf_dir):
    found = queries.op11_lexical_search(spark, sf_dir)
    assert spark_rows(found) == sql_rows(connect(sf_dir), queries.TEXT_ORACLE["op11_lexical_search"])
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)
