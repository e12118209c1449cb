import random
import re

import pytest

from segrisk.llm import licenses, queries

MIT = licenses.TEMPLATES["mit-text"]
FILLER = " ".join(f"word{i % 97}" for i in range(300))


def plain(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(words, width):
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def brute(text):
    """Templates of which some stretch of a quarter more shingles holds four fifths."""
    out, words = set(), plain(text)
    for name, wording in licenses.TEMPLATES.items():
        own = plain(wording)
        width = min(licenses.WIDTH, len(own))
        wanted, have = grams(own, width), grams(words, width)
        size = len(wanted) + max(1, len(wanted) // 4)
        for i in range(max(1, len(have) - size + 1)):
            if 100 * len(set(wanted) & set(have[i : i + size])) >= licenses.CONTAINED * len(set(wanted)):
                out.add(name)
                break
    return out


@pytest.fixture(scope="module")
def docs(spark):
    edited = MIT.replace("associated", "related").upper()
    texts = [
        None, "", "...", "All rights reserved", "ALL RIGHTS, RESERVED!", "all right reserved",
        f"{FILLER} {MIT} {FILLER}", f"{FILLER}\n{edited}\n{FILLER}", MIT[: len(MIT) // 2], MIT + " " + FILLER + " " + MIT,
        "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.", FILLER, "Released under the MIT License. " * 5,
    ]
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, template string")


def test_matches_equal_brute_force(docs):
    found = {}
    for r in licenses.scan(docs).collect():
        found.setdefault(r["doc_id"], set()).add(r["template"])
    for r in docs.collect():
        assert found.get(r["doc_id"], set()) == brute(r["text"]), r["text"]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_spans_hold_the_notice(docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = licenses.scan(docs).collect()
    twice = [r for r in rows if r["doc_id"] == 9]
    assert len(twice) == 2 and all(r["containment"] == 1 for r in twice)
    for r in rows:
        part = text[r["doc_id"]].encode()[r["start"] : r["end"]].decode()
        if r["containment"] == 1 and r["doc_id"] != 12:
            assert plain(part) == plain(licenses.TEMPLATES[r["template"]])
    assert sum(r["template"] == "mit" for r in rows) == 5


def test_template_without_words_is_refused(docs):
    with pytest.raises(Exception, match="no words"):
        licenses.scan(docs, {"none": "..."}).collect()


def test_query_equals_brute_force(spark, sf_dir):
    found = {}
    for r in queries.op7_license_scan(spark, sf_dir).collect():
        found.setdefault(r["doc_id"], set()).add(r["template"])
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found and found == {r["doc_id"]: b for r in rows if (b := brute(r["text"]))}


def test_whole_licences_are_found(spark):
    """Every paragraph of a licence text, whole and with a word changed, and the licences by name."""
    whole = {}
    for name, part in licenses.texts().items():
        whole.setdefault(name.split("/")[0], []).append(part)
    rows = [(n, f"{FILLER}\n" + "\n\n".join(parts)) for n, parts in whole.items()]
    changed = {name: part.split() for name, part in licenses.texts().items()}
    for part in changed.values():
        part[len(part) // 2] = "changed"
    rows += [(name, " ".join(part)) for name, part in changed.items()]
    lines = {
        "Licensed under the MIT License": "name:mit", "see the gnu lesser general public license.": "name:lgpl",
        "// SPDX-License-Identifier: MPL-2.0": "spdx:mpl-2.0", "under CC BY-ND 4.0 only": "name:cc-by-nd-4.0",
    }
    rows += list(zip(lines, lines, strict=True))
    found = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string").repartition(4)).collect():
        found.setdefault(r["doc_id"], set()).add(r["template"])
    assert {"gpl-2.0", "lgpl-2.1", "agpl-3.0", "mpl-2.0", "isc", "cc0-1.0", "unlicense"} <= set(whole)
    for n, parts in whole.items():
        assert {f"{n}/{k}" for k in range(1, len(parts) + 1)} <= found[n]
    for name in changed:
        assert name in found[name]
    for line, name in lines.items():
        assert name in found[line]


def test_index_leaves_no_match_out():
    """Templates that share shingles, in one slice with texts that hold some of them."""
    import numpy as np

    given = {"a": MIT, "b": MIT + " and more words here", "c": "of the Software", "d": "free of charge to any person"}
    raw = [f"{FILLER} {MIT}", FILLER, "", "to any person free of charge to any person of the Software " * 2]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    found = licenses.scan_slice(data, offsets, licenses._compiled(tuple(given.items())))
    assert {(r, name) for r, name, *_ in found} == {(0, n) for n in "abcd"} | {(3, "c"), (3, "d")}


def test_copies_that_follow_each_other_are_apart(spark):
    part = next(text for name, text in licenses.texts().items() if name.startswith("gpl-3.0/") and len(text.split()) > 60)
    halves = MIT.split()
    rows = [
        ("mit", f"{MIT} {MIT}", 2), ("mit", f"{FILLER} {MIT}\n{MIT} {MIT} {FILLER} {MIT}", 4),
        ("gpl", f"{part} {part}", 2), ("mit", MIT[: len(MIT) // 2] + " " + MIT, 1),
        ("mit", " ".join([*halves[len(halves) // 2 :], *halves[: len(halves) // 2]]), 1),
    ]
    wanted = {"mit": MIT, "gpl": part}
    docs = spark.createDataFrame([(i, text) for i, (_, text, _) in enumerate(rows)], "doc_id long, text string")
    found = licenses.scan(docs, wanted).collect()
    for i, (name, text, n) in enumerate(rows):
        own = sorted((r["start"], r["end"], r["containment"]) for r in found if r["doc_id"] == i and r["template"] == name)
        assert len(own) == n, (i, own)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:])), (i, own)
        if i < 3:
            assert all(plain(text.encode()[a:b].decode()) == plain(wanted[name]) and c == 1 for a, b, c in own)


def test_recall_on_altered_notices(spark):
    """Words exchanged, dropped and added at random: what stands above four fifths is found."""
    rng = random.Random(4)
    given = {"mit": MIT} | {k: v for k, v in licenses.texts().items() if k.startswith(("apache-2.0/", "mpl-2.0/"))}
    rows = []
    for k in range(600):
        name = rng.choice(list(given))
        words = given[name].split()
        for _ in range(rng.randint(0, max(1, len(words) // 30))):
            place = rng.randrange(len(words))
            words[place : place + rng.choice([0, 1, 1])] = rng.choice([[], ["other"], ["two", "more"]])
        own = plain(given[name])
        have, wanted = grams(plain(" ".join(words)), 5), set(grams(own, 5))
        rows.append((k, f"{FILLER} {' '.join(words)} {FILLER}", name, 100 * len(wanted & set(have)) >= 80 * len(wanted)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["template"]) for r in licenses.scan(docs, given).collect()}
    enough = [(k, name) for k, _, name, near in rows if near]
    assert len(enough) > 300 and sum(pair in found for pair in enough) >= 0.99 * len(enough)
