"""Words of Arrow text columns as 64-bit hashes, by numpy over the UTF-8 bytes.

A text is cut into slices of about half a megabyte, so that memory does not follow the
batch. Within a slice, a prefix sum of ``byte * P**position`` gives the hash of every
word from its two ends. Equal words get equal hashes; different ones differ but for
a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)

# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACES = (32, 9, 10, 11, 12, 13)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class _Powers:
    """Powers of the base and of its inverse. Each process makes its own: functions that
    travel to tasks take an empty object along, not the tables."""

    def __init__(self):
        self.tables = np.ones(0, U), np.ones(0, U)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
            steps = np.empty((2, size), U)
            steps[0], steps[1], steps[:, 0] = U(_P), U(_PINV), U(1)
            self.tables = tuple(np.cumprod(steps, axis=1, dtype=U))
        return self.tables


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each hash over all 64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Slice:
    """Some rows of a batch. ``raw``: their bytes; ``at``: row ends in ``raw``;
    ``first``: the number of the first row within the batch."""

    first: int
    raw: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1


@dataclass
class Words:
    """``hashes`` of all words in order; those of row i are ``[ends[i], ends[i + 1])``.
    ``start``, ``stop``: the bytes of each word within the slice."""

    first: int
    hashes: np.ndarray
    ends: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.ends))


def slices(column, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Runs of rows with about ``limit`` bytes each; a longer text is one run.
    NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield Slice(i, raw[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def split_words(s: Slice, kind: str = "space") -> Words:
    """Words of a slice, lower-cased A-Z.

    ``space``: runs without white space. ``runs``: runs of letters, digits and bytes
    above 127, and runs of other marks, each apart. ``letters``: the former runs only;
    capital letters of Latin-1 are lower-cased, too."""
    raw, n = s.raw, len(s.raw)
    if kind == "space":
        inside = ~_SPACE[raw]
        group = inside
    else:
        letter = _LETTER[raw]
        inside = letter if kind == "letters" else ~_SPACE[raw]
        group = letter.view(np.int8) + inside.view(np.int8)
    change = np.empty(n + 1, bool)
    if n:
        change[0] = change[n] = True
        np.not_equal(group[1:], group[:-1], out=change[1:n])
        change[s.at] = True
    cuts = np.flatnonzero(change) if n else np.zeros(0, np.int64)
    start, stop = cuts[:-1], cuts[1:]
    keep = inside[start] if n else np.zeros(0, bool)
    start, stop = start[keep], stop[keep]
    low = _LOWER[raw]
    if kind == "letters" and n:
        wide = np.zeros(n, bool)
        wide[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        low = low + (wide.view(np.uint8) << 5)
    return Words(s.first, _hashes(low, start, stop), np.searchsorted(start, s.at), start, stop)


def _hashes(low: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    power, inverse = _powers.upto(len(low) + 1)
    total = np.zeros(len(low) + 1, U)
    np.cumsum((low.astype(U) + U(1)) * power[: len(low)], out=total[1:])
    return mix((total[stop] - total[start]) * inverse[start])


def prefix_hashes(s: Slice, w: Words, length: int) -> np.ndarray:
    """Hashes of the first ``length`` bytes of each word (of all, where shorter),
    lower-cased as by ``letters``."""
    low = _LOWER[s.raw]
    if len(low):
        wide = np.zeros(len(low), bool)
        wide[1:] = (s.raw[:-1] == 0xC3) & (s.raw[1:] >= 0x80) & (s.raw[1:] <= 0x9E) & (s.raw[1:] != 0x97)
        low = low + (wide.view(np.uint8) << 5)
    return _hashes(low, w.start, np.minimum(w.stop, w.start + length))


def words(column, kind: str = "space") -> Iterator[Words]:
    """The words of a text column, slice by slice."""
    for s in slices(column):
        yield split_words(s, kind)


def shingles(w: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles and the row of each, not yet distinct. A row of
    fewer words gives its whole sequence as one; one without words gives none."""
    count = np.diff(w.ends)
    total = len(w.hashes)
    rows = w.rows()
    width = max(0, total - n + 1)
    h = np.full(width, U(n))
    for k in range(n):
        h = h * U(_P) + w.hashes[k : k + width]
    whole = rows[:width] == rows[n - 1 :] if width else np.zeros(0, bool)
    h, at = h[whole], rows[:width][whole]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        few = count[short]
        own = few.astype(U)
        for k in range(n - 1):
            has = few > k
            own[has] = own[has] * U(_P) + w.hashes[w.ends[short[has]] + k]
        h, at = np.concatenate([h, own]), np.concatenate([at, short])
    return mix(h), at


def distinct_sets(w: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ordered by row and hash; and row ends."""
    h, at = shingles(w, n)
    order = np.lexsort((h, at))
    h, at = h[order], at[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
    h, at = h[keep], at[keep]
    return h, np.searchsorted(at, np.arange(len(w) + 1))
