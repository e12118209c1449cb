import random
import re

import pytest

from segrisk.llm import components, jaccard, queries
from segrisk.llm.components import connected


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\t-\r]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def brute(rows):
    """(key, size of the set, least key of the component) of rows (key, text)."""
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for k, i in enumerate(h) for j in h[:k]}
    pairs = [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = roots(len(rows), pairs)
    least = {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return sorted(((k, len(s), least.get(r)) for (k, _), s, r in zip(rows, sets, root, strict=True)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    prose = lambda n: [word() for _ in range(n)]
    texts = [prose(rng.randint(0, 60)) for _ in range(20)]
    passage = prose(50)
    texts += [passage] + [passage + prose(rng.randint(1, 14)) for _ in range(25)]
    for size in (8, 20, 60, 150):
        source = prose(size)
        for _ in range(14):
            copy = list(source)
            for _ in range(rng.randint(0, 1 + size // 40)):
                copy[rng.randrange(size)] = word()
            texts.append(copy[: size - rng.randint(0, size // 8)])
        chain = list(source)
        for _ in range(8):
            chain = chain[size // 20 + 1 :] + prose(size // 20 + 1)
            texts.append(chain)
    rows = [(i + 3, " ".join(t).upper() if i % 7 == 0 else "\n".join(t)) for i, t in enumerate(texts)]
    rows += [(1, None), (2, ""), (900, " \t"), (901, "One two"), (902, "one  TWO"), (903, "É é"), (904, "é é")]
    rows += [rows[30], (rows[31][0], "another text"), (None, rows[32][1]), (None, "quite alone here")]
    return rows


@pytest.mark.parametrize(("seed", "pivots"), [(1, (8, 32, 128)), (2, (1, 2)), (3, (2, 3, 4))])
def test_components_equal_brute_force(spark, monkeypatch, seed, pivots):
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, n long, set string")
    found = sorted(map(tuple, jaccard.join(docs.repartition(3)).collect()), key=str)
    wanted = brute(rows)
    assert found == wanted
    assert len({w[2] for w in wanted}) < len(rows) - 20


def test_keep_one_of_each_component(spark):
    rows = corpus(5)
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, _row string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    sets = [shingles(t) for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    root = roots(len(rows), pairs)
    groups = {}
    for r, row in zip(root, rows, strict=True):
        groups.setdefault(r, set()).add(row)
    assert len(left) == len(groups) and all(sum(x in g for x in left) >= 1 for g in groups.values())
    assert jaccard.keep_one(docs.limit(0)).count() == 0 and jaccard.join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("few", [components.FEW, 0])
def test_connected_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    rng = random.Random(6)
    pairs = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    pairs += [(200, i) for i in range(201, 260)]
    root = roots(300, pairs)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    wanted = {(x, least[root[x]]) for p in pairs if p[0] != p[1] for x in p}
    links = spark.createDataFrame(pairs, "a long, b long")
    assert {tuple(r) for r in connected(links).collect()} == wanted
    assert connected(links.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op4_jaccard_join(spark, sf_dir).collect()), key=str) == brute(rows)
