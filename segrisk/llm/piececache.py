"""Per-worker memory of what distinct pre-tokens map to.

Pre-tokens are found by their 64-bit hash, so a slice is mapped with a few array
operations and only pre-tokens that this worker has not met are worked out. The
bytes of every pre-token are compared with those of the entry found; one that
differs looks under the next hash that follows from its own. The memory holds at
most ``LIMIT`` entries or ``BYTES`` bytes and starts anew when full; it saves
time and never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from segrisk.llm.buffers import mix, same_words

LIMIT = 2_000_000
#: Bytes of pre-tokens that are kept beyond those of the last slice.
BYTES = 1 << 26


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length of every item, one item after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Memory:
    """Sorted hashes, each with the bytes it stands for and a row of values."""

    kind: type = np.uint32
    limit: int = LIMIT
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    text: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    values: np.ndarray = None

    def __post_init__(self):
        if self.values is None:
            self.values = np.zeros(0, self.kind)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        return at, known

    def _full(self) -> bool:
        return len(self.hashes) > self.limit or len(self.text) > BYTES

    def _add(self, hashes: np.ndarray, pieces: list[bytes], lengths: np.ndarray, values: np.ndarray) -> None:
        if self._full():
            for name in ("hashes", "starts", "lengths", "places", "sizes", "text", "values"):
                setattr(self, name, getattr(self, name)[:0])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.starts = np.insert(self.starts, at, len(self.values) + np.cumsum(lengths) - lengths)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.places = np.insert(self.places, at, len(self.text) + np.cumsum(sizes) - sizes)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(pieces), np.uint8)])
        self.values = np.concatenate([self.values, values.astype(self.kind)])

    def rows(
        self,
        data: np.ndarray,
        hashes: np.ndarray,
        start: np.ndarray,
        end: np.ndarray,
        work_out: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray]:
        """Values of all pre-tokens in order, and how many each has.

        ``work_out`` gives the lengths and the values of a list of pre-tokens.
        """
        while True:
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            _, known = self._find(distinct)
            new = np.flatnonzero(~known)
            if len(new):
                if self._full():
                    new = np.arange(len(distinct))
                raw = data.tobytes()
                at = first[new]
                pieces = [raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                lengths, values = work_out(pieces)
                self._add(distinct[new], pieces, np.asarray(lengths, np.int64), np.asarray(values))
            at = self._find(distinct)[0][which]
            same = same_words(data, start, end - start, self.text, self.places[at], self.sizes[at])
            if same.all():
                lengths = self.lengths[at]
                return self.values[spread(self.starts[at], lengths)], lengths
            hashes = np.where(same, hashes, mix(hashes + np.uint64(1)))
