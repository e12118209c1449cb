"""Pre-tokens of byte-level BPE, cut without a regular expression engine.

Gives the matches of ``public_tokenizers.PATTERN`` from the classes of the
characters: runs of letters, numbers and other signs, each with one blank before
it; the rest of a run of white space; contractions after an apostrophe.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

SPACES, LETTERS, NUMBERS, OTHERS = 0, 1, 2, 3
# The code points with the Unicode property White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    kind = {"L": LETTERS, "N": NUMBERS}
    table = np.fromiter(
        (kind.get(unicodedata.category(chr(c))[0], OTHERS) for c in range(sys.maxunicode + 1)), np.uint8
    )
    table[WHITE] = SPACES
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and first byte of every character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    wide = np.flatnonzero(code >= 0xC0)
    if len(wide):
        lead, first = code[wide], at[wide]
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32) & 0x3F
        b1, b2, b3 = (padded[first + k] for k in (1, 2, 3))
        two, three = (lead & 0x1F) << 6 | b1, (lead & 0x0F) << 12 | b1 << 6 | b2
        four = (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3
        code[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return code, at


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each pre-token, and how many each row has."""
    code, at = code_points(data)
    n = len(code)
    edge = np.zeros(n + 4, bool)
    edge[np.searchsorted(at, offsets)] = True
    edge[n:] = True
    kind = classes()[code]
    start = edge.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    after = 1 + np.flatnonzero((kind[1:] != SPACES) & (kind[:-1] == SPACES) & ~edge[1:n])
    start[after - 1] = True
    start[after[code[after - 1] == 32]] = False
    quote = np.flatnonzero(start[:n] & (code == ord("'")) & ~edge[1 : n + 1])
    padded = np.concatenate([code, np.zeros(3, np.int32)])
    one, two = padded[quote + 1], padded[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    start[quote[short] + 1] = False
    start[quote[short] + 2] = True
    pair = one * 256 + two
    long = np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]) & ~edge[quote + 2]
    start[quote[long] + 1] = False
    start[quote[long] + 3] = True
    first = at[np.flatnonzero(start[:n])]
    return first, np.append(first[1:], len(data)), np.diff(np.searchsorted(first, offsets))
