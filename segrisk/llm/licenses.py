"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

For every template, texts are cut into windows a quarter longer than it, each a
quarter further than the one before, so that any copy lies whole in a window. A
window is a candidate if one of ``BANDS`` MinHash bands equals the template's. A
copy with 4/5 of the template's shingles has a Jaccard similarity of at least
0.8 / 1.45 = 0.55 with its window, so it collides in one of 16 bands of one row
with probability 1 - 0.45**16 > 0.99999. The band of a window can only equal that
of a template if the template's least shingle in this band stands in the window. So the
index over all templates has these least shingles, and only windows around
them are worked out; all others have no band in common with any template.
Candidates are held against the template's shingles one by one. Copies that
follow each other are told apart by the places of their shingles in the template.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.llm.buffers import LOWER, mix, shingles, slices, word_hashes, words

# Wording of public licence notices, names and identifiers.
NAMES = {
    "agpl": "GNU Affero General Public License",
    "apache": "Apache License",
    "artistic": "Artistic License",
    "bsd": "BSD License",
    "bsd-2-clause": "BSD 2-Clause",
    "bsd-3-clause": "BSD 3-Clause",
    "cc0": "CC0 1.0",
    "cc-by": "Creative Commons Attribution",
    "cc-by-4.0": "CC BY 4.0",
    "cc-by-nc": "Creative Commons Attribution-NonCommercial",
    "cc-by-nc-4.0": "CC BY-NC 4.0",
    "cc-by-nc-nd": "Creative Commons Attribution-NonCommercial-NoDerivatives",
    "cc-by-nc-nd-4.0": "CC BY-NC-ND 4.0",
    "cc-by-nc-sa": "Creative Commons Attribution-NonCommercial-ShareAlike",
    "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0",
    "cc-by-nd": "Creative Commons Attribution-NoDerivatives",
    "cc-by-nd-4.0": "CC BY-ND 4.0",
    "cc-by-sa": "Creative Commons Attribution-ShareAlike",
    "cc-by-sa-4.0": "CC BY-SA 4.0",
    "gfdl": "GNU Free Documentation License",
    "gpl": "GNU General Public License",
    "isc": "ISC License",
    "lgpl": "GNU Lesser General Public License",
    "mit": "MIT License",
    "mpl": "Mozilla Public License",
    "unlicense": "the Unlicense",
}
IDENTIFIERS = (
    "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0"
    " CC-BY-ND-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GFDL-1.3 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib"
).split()
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions"
    ),
}
TEMPLATES |= {f"name:{name}": wording for name, wording in NAMES.items()}
TEMPLATES |= {f"spdx:{name.lower()}": f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS}
#: Words of a paragraph of a licence text at least; shorter ones are joined with the next.
PARAGRAPH = 30
WIDTH = 5
BANDS = 16
#: Percent of a template's shingles that a match must hold.
CONTAINED = 80
#: Shingles of windows that are worked out at once.
CELLS = 1 << 16
#: Leading bits of a shingle that are looked up before the shingle itself.
ROUGH = 20

# All ASCII signs but letters and digits part words; letters lose their case.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32
_PLAIN = LOWER[_PLAIN]


@dataclass(frozen=True)
class Template:
    name: str
    width: int  # words of a shingle: five, or all of a shorter template
    hashes: np.ndarray  # distinct shingles, ascending
    places: np.ndarray  # where each stands, -1 if at several places
    length: int  # shingles in a row
    bands: np.ndarray  # least MinHash value in each band
    least: np.ndarray  # the shingles that have one of these


def _word_hashes(data: np.ndarray, offsets: np.ndarray):
    plain = _PLAIN[data]
    start, end, counts = words(plain, offsets)
    return word_hashes(plain, start, end), start, end, counts


def _template(name: str, text: str) -> Template:
    raw = np.frombuffer(text.encode(), np.uint8)
    hashes, _, _, counts = _word_hashes(raw, np.array([0, len(raw)]))
    width = min(WIDTH, int(counts[0]))
    if not width:
        raise ValueError(f"template {name} has no words")
    found, n = shingles(hashes, counts, width)
    distinct, places, times = np.unique(found, return_index=True, return_counts=True)
    places[times > 1] = -1
    table = _rows(distinct)
    bands = table.min(axis=1)
    return Template(name, width, distinct, places, int(n[0]), bands, distinct[(table == bands[:, None]).any(axis=0)])


def _rows(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of every shingle, one row for each band."""
    seeds = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    return (mix(hashes[None, :] ^ seeds[:, None]) >> np.uint64(32)).astype(np.uint32)


def _windows(places: np.ndarray, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end place of the windows that hold any of ``places``, in a text with ``n`` shingles."""
    step = max(1, length // 4)
    size = length + step
    last = max(0, -(-(n - size) // step))
    low = np.maximum(0, -((size - 1 - places) // step))
    high = np.minimum(places // step, last)
    ahead = np.arange(int((high - low).max()) + 1)
    reach = np.unique((low[:, None] + ahead)[ahead <= (high - low)[:, None]])
    return step * reach, np.minimum(step * reach + size, n)


def _colliding(t: Template, own: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether each window of a text's shingles has a band in common with the template."""
    size = int((stop - start).max())
    hit = np.zeros(len(start), bool)
    some = max(1, CELLS // size)
    for k in range(0, len(start), some):
        at = np.minimum(start[k : k + some, None] + np.arange(size), stop[k : k + some, None] - 1)
        least = _rows(own[at.ravel()]).reshape(BANDS, *at.shape).min(axis=2)
        hit[k : k + some] = (least == t.bands[:, None]).any(axis=0)
    return hit


@dataclass(frozen=True)
class Index:
    """The templates with shingles of one width, by the shingles that are least in their bands."""

    templates: tuple[Template, ...]
    known: np.ndarray  # these shingles of all templates, distinct and ascending
    first: np.ndarray  # of each: its first place in ``of``
    of: np.ndarray  # template numbers
    rough: np.ndarray  # whether one begins with these bits


def _index(templates: tuple[Template, ...]) -> Index:
    hashes = np.concatenate([t.least for t in templates])
    of = np.repeat(np.arange(len(templates)), [len(t.least) for t in templates])
    order = np.argsort(hashes, kind="stable")
    known, first = np.unique(hashes[order], return_index=True)
    rough = np.zeros(1 << ROUGH, bool)
    rough[known >> np.uint64(64 - ROUGH)] = True
    return Index(templates, known, np.append(first, len(hashes)), of[order], rough)


def _retrieved(index: Index, grams: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, template number, places in the slice) where shingles stand that are least in a band of the template."""
    place = np.flatnonzero(index.rough[grams >> np.uint64(64 - ROUGH)])
    at = np.minimum(np.searchsorted(index.known, grams[place]), len(index.known) - 1)
    equal = index.known[at] == grams[place]
    place, at = place[equal], at[equal]
    if not len(place):
        return
    n = np.diff(index.first)[at]
    number = index.of[np.repeat(index.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    place = np.repeat(place, n)
    order = np.lexsort((place, number, owner[place]))
    place, number = place[order], number[order]
    row = owner[place]
    edges = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1])]))
    for a, b in zip(edges, [*edges[1:], len(place)], strict=True):
        yield int(row[a]), int(number[a]), place[a:b]


def _copies(t: Template, own: np.ndarray, start: int, stop: int) -> list[tuple[int, int, int]]:
    """(first place, last place, shingles held) of the copies between two places of a text's shingles.

    A new copy begins where the template starts again, that is, more than half of it
    before the furthest place so far. Parts in another order make one copy if
    only together they hold enough.
    """
    at = np.minimum(np.searchsorted(t.hashes, own[start:stop]), len(t.hashes) - 1)
    inside = np.flatnonzero(t.hashes[at] == own[start:stop])
    where = t.places[at[inside]]
    parts, begin, furthest = [], 0, -1
    for k, place in enumerate(where.tolist()):
        if place < 0:
            continue
        if 2 * (furthest - place) > t.length or t.length <= 2 and k > begin and place <= furthest:
            parts.append((begin, k))
            begin, furthest = k, -1
        furthest = max(furthest, place)
    parts.append((begin, len(where)))
    counted = [(a, b, len(np.unique(at[inside[a:b]]))) for a, b in parts]
    enough = [part for part in counted if 100 * part[2] >= CONTAINED * len(t.hashes)]
    chosen = enough or [(0, len(where), len(np.unique(at[inside])))]
    return [(start + int(inside[a]), start + int(inside[b - 1]), held) for a, b, held in chosen]


def scan_slice(data: np.ndarray, offsets: np.ndarray, indexes: tuple[Index, ...]) -> list[tuple]:
    """(row, template, first byte, end byte, shingles held, shingles of the template) of every match."""
    hashes, begin, end, counts = _word_hashes(data, offsets)
    first_word = np.cumsum(counts) - counts
    found = []
    for index in indexes:
        width = index.templates[0].width
        grams, n = shingles(hashes, counts, width)
        if not len(grams):
            continue
        first_gram = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(n)), n)
        for r, number, places in _retrieved(index, grams, owner):
            t = index.templates[number]
            own = grams[first_gram[r] : first_gram[r] + n[r]]
            start, stop = _windows(places - first_gram[r], int(n[r]), t.length)
            hit = _colliding(t, own, start, stop)
            areas: list[list[int]] = []  # between the outermost shingles held of windows that overlap
            for a, b in zip(start[hit].tolist(), stop[hit].tolist(), strict=True):
                held = np.isin(own[a:b], t.hashes)
                if 100 * len(np.unique(own[a:b][held])) < CONTAINED * len(t.hashes):
                    continue
                inner = a + np.flatnonzero(held)
                if areas and inner[0] < areas[-1][1]:
                    areas[-1][1] = max(areas[-1][1], int(inner[-1]) + 1)
                else:
                    areas.append([int(inner[0]), int(inner[-1]) + 1])
            for a, b in areas:
                for first, last, held in _copies(t, own, a, b):
                    word = first_word[r] + min(last + width, counts[r]) - 1
                    span = (int(begin[first_word[r] + first] - offsets[r]), int(end[word] - offsets[r]))
                    found.append((r, t.name, *span, held, len(t.hashes)))
    return found


@functools.cache
def texts() -> dict[str, str]:
    """Paragraphs of the whole licence texts that come with the package, by licence and number."""
    out = {}
    for file in sorted(resources.files("segrisk.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        parts: list[str] = [""]
        for paragraph in re.split(r"\n\s*\n", file.read_text("utf-8")):
            if len(parts[-1].split()) >= PARAGRAPH:
                parts.append("")
            parts[-1] += "\n" + paragraph
        if len(parts) > 1 and len(parts[-1].split()) < PARAGRAPH:
            parts[-2:] = [parts[-2] + "\n" + parts[-1]]
        out |= {f"{file.name.removesuffix('.txt')}/{k}": part for k, part in enumerate(parts, 1)}
    return out


@functools.cache
def _compiled(templates: tuple[tuple[str, str], ...]) -> tuple[Index, ...]:
    known = [_template(name, text) for name, text in templates]
    return tuple(_index(tuple(t for t in known if t.width == w)) for w in sorted({t.width for t in known}))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per match: ``key``, template, start and end (bytes of the text), containment.

    Templates are the notices of ``TEMPLATES`` and the paragraphs of ``texts()``, if
    none are given. Case and signs do not count. Overlapping windows of one match are one row;
    of a template with fewer than five words the whole sequence is the shingle.
    Null texts and texts without words match nothing. Repeated rows each get
    their matches; other columns of ``docs`` are not used.
    """
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = narrow.schema[key].dataType.simpleString()
    given = tuple(sorted((TEMPLATES | texts() if templates is None else templates).items()))
    names = [key, "template", "start", "end", "containment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, data, offsets in slices(batch.column(1)):
                found = sorted(scan_slice(data, offsets, _compiled(given)))
                if found:
                    row, name, start, end, held, size = zip(*found, strict=True)
                    columns = [
                        batch.column(0).take(pa.array([at + r for r in row])), pa.array(name, pa.string()),
                        pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                        pa.array([k / s for k, s in zip(held, size, strict=True)], pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return narrow.mapInArrow(run, f"`{key}` {kind}, template string, start long, end long, containment double")
