"""Suffix sorting inside a task: hash-compared mergesort of the suffixes at given places.

Prefix polynomial hashes give the hash of any range in one step; a binary search
over them finds how far two suffixes agree, so a comparison costs a logarithm of
their length. What the hashes found is verified on the bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from segrisk.llm.buffers import _BASE, _INVERSE, mix, powers
from segrisk.llm.piececache import spread


class Texts:
    """Pieces of text around anchors: ``left`` bytes before each anchor and ``right`` bytes from it on.

    Exponents of the hashes count from the start of a piece, and the prefix sums
    are filled some pieces at a time: memory is eight bytes for each byte of text.
    """

    def __init__(self, data: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.data, self.anchor, self.left, self.right = data, anchor, left, right
        self.first = anchor - left
        # The eight bytes from every place on.
        self.lanes = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(9, np.uint8)), strides=(1,))
        longest = int((left + right).max(initial=0)) + 1
        self.powers, self.inverse = powers(_BASE, longest), powers(_INVERSE, longest)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        for at in range(0, len(anchor), 4096):
            size = (left + right)[at : at + 4096]
            a, b = int(self.first[at]), int(self.first[at] + size.sum())
            exponent = np.arange(b - a) - np.repeat(self.first[at : at + 4096] - a, size)
            sums = np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * self.powers[exponent], dtype=np.uint64)
            self.prefix[a + 1 : b + 1] = sums + self.prefix[a]

    def same(self, i: np.ndarray, x: np.ndarray, j: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n bytes from x on, in piece i, have the hash of the n bytes from y on, in piece j."""
        a = (self.prefix[x + n] - self.prefix[x]) * self.powers[y - self.first[j]]
        return a == (self.prefix[y + n] - self.prefix[y]) * self.powers[x - self.first[i]]

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many bytes after (or before) the anchors i and j agree."""
        size = self.right if forward else self.left
        low, high = np.zeros(len(i), np.int64), np.minimum(size[i], size[j])
        x, y = self.anchor[i], self.anchor[j]
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) // 2
            back = 0 if forward else middle
            equal = self.same(i, x - back, j, y - back, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, np.maximum(low, middle - 1))
        return low

    def less(self, i: np.ndarray, j: np.ndarray, forward: bool, or_equal: np.ndarray) -> np.ndarray:
        """Suffix (or reversed prefix) i comes before j; where both are equal, ``or_equal``."""
        n = self.extend(i, j, forward)
        size = self.right if forward else self.left
        at = (lambda k: self.anchor[k] + n) if forward else (lambda k: self.anchor[k] - n - 1)
        end_i, end_j = n == size[i], n == size[j]
        byte_i, byte_j = self.data[np.where(end_i, 0, at(i))], self.data[np.where(end_j, 0, at(j))]
        return np.where(end_i & end_j, or_equal, np.where(end_i | end_j, end_i, byte_i < byte_j))

    def agree(self, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Verification on the bytes, eight at a time: left bytes before and right bytes after both anchors are the same."""
        out = np.ones(len(i), bool)
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            n = left[part] + right[part]
            x, y = (self.anchor[k[part]] - left[part] for k in (i, j))
            whole, rest = n // 8, n % 8
            step = spread(np.zeros(len(n), np.int64), whole) * 8
            differ = self.lanes[np.repeat(x, whole) + step] != self.lanes[np.repeat(y, whole) + step]
            wrong = np.bincount(np.repeat(np.arange(len(n)), whole), differ, len(n)) > 0
            # Of the last lane, the bytes of the piece: a shift drops those behind it.
            tail = (self.lanes[x + 8 * whole] ^ self.lanes[y + 8 * whole]) << (64 - 8 * rest).clip(max=63).astype(np.uint64)
            out[part] = ~(wrong | ((rest > 0) & (tail != 0)))
        return out


def merge_sort(group: np.ndarray, less: Callable) -> np.ndarray:
    """Stable order of all items by group and, inside a group, by ``less``.

    ``group`` ascends. All runs of all groups are merged at once: the place of an
    item is its place in its own run plus the items of the other run before it,
    which a binary search finds.
    """
    n = len(group)
    order = np.arange(n)
    if not n:
        return order
    starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    sizes = np.diff(np.append(starts, n))
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max():
        active = np.flatnonzero(size > width)
        begin, end = first[active], (first + size)[active]
        own = (active - begin) // width
        pair = begin + (own // 2) * 2 * width
        is_left = own % 2 == 0
        low = np.where(is_left, np.minimum(pair + width, end), pair)
        high = np.where(is_left, np.minimum(pair + 2 * width, end), pair + width)
        other = low.copy()
        item = order[active]
        for _ in range(width.bit_length()):
            open_ = np.flatnonzero(low < high)
            middle = (low[open_] + high[open_]) // 2
            # An item of the right run comes after equal ones of the left run.
            before = less(order[middle], item[open_], ~is_left[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = pair + (active - begin) % width + (low - other)
        order[place] = item.copy()
        width *= 2
    return order


def neighbours(texts: Texts, group: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of items that follow each other in their group's order."""
    order = merge_sort(group, lambda i, j, e: texts.less(i, j, forward, e))
    i, j = order[:-1], order[1:]
    inside = group[i] == group[j]
    return i[inside], j[inside]


def _byte_extension(texts: Texts, i: int, j: int, forward: bool) -> int:
    size = texts.right if forward else texts.left
    n, a, b = int(min(size[i], size[j])), int(texts.anchor[i]), int(texts.anchor[j])
    x = texts.data[a : a + n] if forward else texts.data[a - n : a][::-1]
    y = texts.data[b : b + n] if forward else texts.data[b - n : b][::-1]
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def repeated_offsets(texts: Texts, group: np.ndarray, length: int) -> np.ndarray:
    """Item x offset: the ``length`` bytes that start so far before the anchor are also around another anchor of the group.

    The longest agreement after an anchor is with a neighbour in the order of the
    suffixes, the longest before it with one in the order of the reversed
    prefixes. Offsets that these neighbours settle neither way (the one agrees
    longest after, another longest before) are settled by the hashes of their
    windows among all items of the group.
    """
    n = len(group)
    width = int(texts.left.max(initial=0)) + 1
    offset = np.arange(width)
    possible = (offset <= texts.left[:, None]) & (length - offset <= texts.right[:, None])
    found, most_left, most_right = np.zeros((n, width), bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for forward in (True, False):
        i, j = neighbours(texts, group, forward)
        left, right = texts.extend(i, j, False), texts.extend(i, j, True)
        for bad in np.flatnonzero(~texts.agree(i, j, left, right)):
            left[bad], right[bad] = (_byte_extension(texts, i[bad], j[bad], f) for f in (False, True))
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            covers = (offset <= left[part, None]) & (length - offset <= right[part, None])
            # An item is the former of one pair at most, and the latter of one.
            for k in (i, j):
                found[k[part]] |= covers
        most, own = (most_right, right) if forward else (most_left, left)
        for k in (i, j):
            most[k] = np.maximum(most[k], own)
    open_ = possible & ~found & (offset <= most_left[:, None]) & (length - offset <= most_right[:, None])
    if open_.any():
        hard = np.isin(group, np.unique(group[open_.any(axis=1)]))
        found |= same_windows(texts, group, length, possible & hard[:, None])
    return found & possible


def window_hashes(texts: Texts, item: np.ndarray, offset: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window that starts ``offset`` before the item's anchor."""
    start = texts.anchor[item] - offset
    own = texts.prefix[start + length] - texts.prefix[start]
    return mix(own * texts.inverse[start - texts.first[item]])


def same_windows(texts: Texts, group: np.ndarray, length: int, use: np.ndarray) -> np.ndarray:
    """Item x offset: another item of the group has the same window at that offset."""
    out = np.zeros(use.shape, bool)
    # Who each item was last found to agree with on the bytes, and how far to both sides.
    partner, left, right = np.full(len(group), -1), np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
    for offset in range(use.shape[1]):
        item = np.flatnonzero(use[:, offset])
        back = np.full(len(item), offset)
        hashes = window_hashes(texts, item, back, length)
        order = np.lexsort((hashes, group[item]))
        i, h = item[order], hashes[order]
        at = np.flatnonzero((group[i[1:]] == group[i[:-1]]) & (h[1:] == h[:-1]))
        a, b = i[at], i[at + 1]
        new = (partner[a] != b) | (offset > left[a]) | (length - offset > right[a])
        x, y = a[new], b[new]
        before, after = texts.extend(x, y, False), texts.extend(x, y, True)
        for bad in np.flatnonzero(~texts.agree(x, y, before, after)):
            before[bad], after[bad] = (_byte_extension(texts, x[bad], y[bad], f) for f in (False, True))
        partner[x], left[x], right[x] = y, before, after
        at = at[(partner[a] == b) & (offset <= left[a]) & (length - offset <= right[a])]
        out[i[at], offset] = True
        out[i[at + 1], offset] = True
    return out
