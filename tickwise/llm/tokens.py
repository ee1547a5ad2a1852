"""Words and shingles of Arrow text columns, hashed by numpy without making a
Python string: a text is a range of UTF-8 bytes, a word a range without the
six blank bytes, and its hash a difference of prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits (the splitmix64 finisher)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """``n`` fixed 64-bit numbers that look random."""
    return mix(np.arange(start, start + n, dtype=np.uint64) * U(BASE))


BYTES = seeds(256, 1000) | U(1)


class _Powers:
    """Powers of BASE and of its inverse, made longer when asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, PIECE)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


POWERS = _Powers()


def groups(column: pa.Array, most: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column (null: empty) into runs of texts of at most ``most``
    bytes: first and last row, bytes, offsets.  A longer text comes alone, in
    pieces that end at a blank (one after the other, with the same rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        hi = min(hi, lo + 65536, n)
        a, z = int(offsets[lo]), int(offsets[hi])
        if z - a <= most:
            yield lo, hi, data[a:z], offsets[lo : hi + 1] - a
        while z - a > most:
            blanks = np.flatnonzero(SPACE[data[a + most : min(z, a + 2 * most)]])
            to, step = a + most, 2 * most
            while not len(blanks) and a + step < z:  # a word longer than a piece
                blanks, to, step = np.flatnonzero(SPACE[data[a + step : min(z, a + 2 * step)]]), a + step, 2 * step
            cut = to + int(blanks[0]) if len(blanks) else z
            yield lo, hi, data[a:cut], np.array([0, cut - a])
            a = cut
            if z - a <= most and z > a:
                yield lo, hi, data[a:z], np.array([0, z - a])
        lo = hi


def word_ranges(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of each word.  Texts stand back to back."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid & edge[:-1]
    first[1:] |= solid[1:] & ~solid[:-1]
    last = solid & edge[1:]
    last[:-1] |= solid[:-1] & ~solid[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order of their starts.
    Long data is summed piece by piece, cut where no range is open."""
    out = np.empty(len(starts), np.uint64)
    table, at = BYTES[fold], 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        end = int(ends[at:to].max())
        up, down = POWERS.upto(end - base)
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum(table[data[base:end]] * up[: end - base], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out)


def shingles(words: np.ndarray, owner: np.ndarray, texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of ``width`` words inside one text, in
    order; a shorter text has its whole sequence as one, an empty text none."""
    counts = np.bincount(owner, minlength=texts)
    n = len(words) - width + 1
    if n > 0:
        h = np.full(n, U(width))
        for k in range(width):
            h = mix(h * U(BASE) + words[k : k + n])
        whole = owner[: n] == owner[width - 1 :]
        h, of = h[whole], owner[:n][whole]
    else:
        h, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])[short]
        g = counts[short].astype(np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            g[has] = mix(g[has] * U(BASE) + words[first[has] + k])
        h, of = np.concatenate([h, g]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        h, of = h[order], of[order]
    return h, of


def whole(parts: Iterator[tuple]) -> Iterator[tuple]:
    """Join the pieces of a long text again: items are (first row, last row,
    arrays..., owner); pieces of one text follow each other."""
    held: list[tuple] = []
    for part in parts:
        if held and part[0] != held[0][0]:
            yield held[0] if len(held) == 1 else (*held[0][:2], *(np.concatenate(x) for x in zip(*(h[2:] for h in held))))
            held = []
        held.append(part)
    if held:
        yield held[0] if len(held) == 1 else (*held[0][:2], *(np.concatenate(x) for x in zip(*(h[2:] for h in held))))


def hashed_words(column: pa.Array, fold: np.ndarray = LOWER) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, word hashes and their text index, for runs of whole texts."""
    def parts():
        for lo, hi, data, offsets in groups(column):
            starts, ends, owner = word_ranges(data, offsets)
            yield lo, hi, range_hashes(data, starts, ends, fold), owner
    return whole(parts())


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text of the column."""
    for lo, hi, words, owner in hashed_words(column):
        h, of = shingles(words, owner, hi - lo, width)
        cut = np.searchsorted(of, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield lo + i, np.unique(h[cut[i] : cut[i + 1]])
