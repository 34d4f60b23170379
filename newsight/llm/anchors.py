"""Routing of repeated windows by content.

Every window of ``width`` units (words or bytes) has an anchor: the gram of ``gram`` units
with the smallest hash inside it, the leftmost of equals. Consecutive windows with one
anchor place form a segment. Equal windows have equal anchors, so grouping segments by anchor
brings all equal windows together, at a few segments for each window's length of text.

Texts of a slice are handled as one sequence; windows that would cross from one text into
the next are left out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from newsight.llm.common import mix

# windows looked at together; a longer sequence is taken in overlapping parts
_PART = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_BYTE_HASHES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Segments(NamedTuple):
    start: np.ndarray  # first window of each segment, which is also its first unit
    stop: np.ndarray  # after its last window
    text: np.ndarray  # which text it stands in
    anchor: np.ndarray  # hash of the anchor gram
    content: np.ndarray  # hash of all units of the segment


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


class Hasher:
    """Hashes of unit ranges from prefix sums; keeps the powers it has needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def load(self, units: np.ndarray) -> None:
        """``units``: hashes of words, or bytes."""
        n = len(units)
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_UNDO, n)
        spread = _BYTE_HASHES[units] if units.dtype == np.uint8 else mix(units + np.uint64(1))
        spread *= self.up[:n]
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(spread, out=self.total[1:])

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` units that start at each place."""
        count = len(self.total) - n
        if count <= 0:
            return np.zeros(0, np.uint64)
        raw = self.total[n:] - self.total[:-n]
        raw *= self.down[:count]
        return mix(raw)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.total[stop] - self.total[start]) * self.down[start]
        return mix(raw ^ (stop - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _rolling_least(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` neighbours, by doubling."""
    done = 1
    while done * 2 <= span:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    rest = span - done
    return np.minimum(key[:-rest], key[rest:]) if rest else key


def segments(units: np.ndarray, ends: np.ndarray, width: int, gram: int, hasher: Hasher) -> Segments:
    """Segments of the texts that end before each of ``ends`` in ``units``."""
    n_windows = len(units) - width + 1
    if n_windows <= 0:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    hasher.load(units)
    grams, span = hasher.grams(gram), width - gram + 1
    places = []
    for lo in range(0, n_windows, _PART):
        part = grams[lo : min(lo + _PART, n_windows) + span - 1]
        key = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        places.append((_rolling_least(key, span) & _PLACE).astype(np.int64) + lo)
    place = np.concatenate(places) if len(places) > 1 else places[0]
    # windows that begin in the last width - 1 units of a text would cross its end
    whole = np.ones(n_windows + 1, bool)
    whole[-1] = False
    edge = np.zeros(len(units) + width + 1, np.int32)
    np.add.at(edge, np.maximum(ends - width + 1, np.concatenate([[0], ends[:-1]])), 1)
    np.add.at(edge, ends, -1)
    whole[:-1] = np.cumsum(edge)[:n_windows] == 0
    new = whole[:-1].copy()
    new[1:] &= (place[1:] != place[:-1]) | ~whole[:-2]
    last = whole[:-1] & ~whole[1:]
    last[:-1] |= new[1:] & whole[:-2]
    start, stop = np.nonzero(new)[0], np.nonzero(last)[0] + 1
    return Segments(
        start, stop, np.searchsorted(ends, start, "right"), grams[place[start]],
        hasher.ranges(start, stop + width - 1),
    )
