"""Periodic runs in the words of a document, by difference-cover extensions.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends, at least ``max(LEAST, TIMES * q)`` words long.  For
each candidate period ``p`` the words ``i`` and ``i + p`` are compared on a grid
of steps ``max((TIMES - 1) * p, LEAST - p)`` only: any run with period ``p``
holds a grid point whose partner it holds too, so all periods together take
``n/1 + n/2 + n/3 + ...`` comparisons.  From a grid point where both agree the
match is extended to both sides.

An extension compares ``FEW`` words directly; only what is left asks for a
longest common extension over a difference cover of ``COVER``: positions whose
remainder is in the cover are sampled, the suffixes at sampled positions are
sorted (word by word up to ``COVER`` words, then by doubling, each time only
those that are still alike), and the common prefixes of neighbours get a
sparse table of minima.  Any two positions reach a pair of sampled ones within
``COVER`` words, and the table answers from there.  Of runs over the same
stretch the smallest period is kept; by the periodicity lemma that is the
smallest period of the stretch.

A document is one row and is worked on as a whole by one task, in memory of
some 40 bytes a word; short ones share one sorted structure.

Edge cases: a null or empty text has no words, no runs and an empty collapsed
text; with fewer than ``LEAST`` words there is no run; a null doc_id is kept
(and, in the query, its text is never stretched); repeated rows of a doc_id
each get their row; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, table

LEAST, TIMES = 24, 3
FEW = 8
ROOT = 8
COVER = ROOT * ROOT
#: 0..7 and the multiples of 8: every difference modulo 64 is one of the latter less one of the former.
SAMPLED = np.array(sorted({*range(ROOT), *range(0, COVER, ROOT)}))
#: Words that share one sorted structure, and grid points looked at together, about.
TOGETHER, GRID = 1 << 18, 1 << 20
WORDS = re.compile(WORD.encode())


def _meeting_points() -> np.ndarray:
    """Words to go until both positions, given by their remainders, are sampled."""
    go = np.full((COVER, COVER), COVER, np.int64)
    rest = np.arange(COVER)
    for x in SAMPLED:
        for y in SAMPLED:
            d = (x - rest) % COVER
            other = (y - d) % COVER
            go[rest, other] = np.minimum(go[rest, other], d)
    return go


GO = _meeting_points()
PLACE = np.full(COVER, -1)
PLACE[SAMPLED] = np.arange(len(SAMPLED))


class Extensions:
    """Longest common extensions between positions of ``w``, a sequence in
    which no two positions agree up to its end (its last number is unique)."""

    def __init__(self, w: np.ndarray):
        self.w = w
        at = (np.arange(-(-len(w) // COVER))[:, None] * COVER + SAMPLED).ravel()
        self.at = at[at < len(w)]
        levels = self._sort()
        self._minima(levels)

    def _index(self, positions: np.ndarray) -> np.ndarray:
        return positions // COVER * len(SAMPLED) + PLACE[positions % COVER]

    def _refine(self, some: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Order the samples of groups that are alike so far by one more key;
        a rank is the number of smaller samples.  Returns what is still alike."""
        order = np.lexsort((by, self.rank[some]))
        some, by = some[order], by[order]
        rank, k = self.rank[some], np.arange(len(some))
        group = np.concatenate([[True], rank[1:] != rank[:-1]])
        run = group | np.concatenate([[True], by[1:] != by[:-1]])
        start = np.maximum.accumulate(np.where(run, k, 0))
        self.rank[some] = rank + start - np.maximum.accumulate(np.where(group, k, 0))
        alone = run & np.concatenate([run[1:], [True]])
        return some[~alone]

    def _sort(self) -> list[np.ndarray]:
        self.rank = np.zeros(len(self.at), np.int64)
        some = np.arange(len(self.at))
        for t in range(COVER):
            if not len(some):
                break
            to = self.at[some] + t
            some = self._refine(some, np.where(to < len(self.w), self.w[np.minimum(to, len(self.w) - 1)], -1))
        levels, length = [self.rank.copy()], COVER
        while len(some):
            to = self.at[some] + length
            inside = to < len(self.w)
            by = np.full(len(some), -1)
            by[inside] = self.rank[self._index(to[inside])]
            some = self._refine(some, by)
            levels.append(self.rank.copy())
            length *= 2
        return levels

    def _minima(self, levels: list[np.ndarray]) -> None:
        order = np.argsort(self.rank)
        a, b = self.at[order[:-1]].copy(), self.at[order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < len(self.w)) & (b < len(self.w)))
            same = inside[levels[level][self._index(a[inside])] == levels[level][self._index(b[inside])]]
            for x in (a, b, common):
                x[same] += COVER << level
        common += self._direct(a, b, np.full(len(a), COVER))[0]
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from i and j on, up to ``most``; which ones got there."""
        return equal_words(self.w, i, j, most)

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from positions i and j (i != j) on."""
        out, there = self._direct(i, j, GO[i % COVER, j % COVER])
        if len(there):
            x, y = self.rank[self._index(i[there] + out[there])], self.rank[self._index(j[there] + out[there])]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            more = np.empty(len(there), np.int64)
            for k in np.unique(level):
                at = level == k
                t = self.table[k]
                more[at] = np.minimum(t[low[at]], t[high[at] - (1 << k)])
            out[there] += more
        return out


def equal_words(w: np.ndarray, i: np.ndarray, j: np.ndarray, most, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Equal words from i and j on (step -1: backwards), up to ``most`` for
    each pair; the pairs that got there."""
    most = np.broadcast_to(most, len(i))
    out, open_, there, t = np.zeros(len(i), np.int64), np.arange(len(i)), [], 0
    while len(open_):
        at = most[open_] == t
        there.append(open_[at])
        open_ = open_[~at]
        same = w[i[open_] + step * t] == w[j[open_] + step * t]
        out[open_[~same]] = t
        open_ = open_[same]
        t += 1
    there = np.concatenate(there) if there else np.zeros(0, np.int64)
    out[there] = most[there]
    return out, there


def anchors(w: np.ndarray):
    """(position, period) on the grid whose words agree and that a run might
    hold: both sides together reach far enough, or go on after FEW words.
    ``w`` has a number of its own before the first and after the last word."""
    n = len(w) - 2
    p = np.arange(1, n // TIMES + 1)
    step = np.maximum((TIMES - 1) * p, LEAST - p)
    count = -(-(n - p) // step)
    piece = (np.cumsum(count) - count) // GRID
    for k in np.unique(piece):
        of = slice(*np.searchsorted(piece, [k, k + 1]))
        c = count[of]
        period = np.repeat(p[of], c)
        i = (np.arange(len(period)) - np.repeat(np.cumsum(c) - c, c)) * np.repeat(step[of], c) + 1
        hit = w[i] == w[i + period]
        i, period = i[hit], period[hit]
        after, on = equal_words(w, i, i + period, FEW)
        before, off = equal_words(w, i - 1, i + period - 1, FEW, -1)
        keep = after + before >= np.maximum((TIMES - 1) * period, LEAST - period)
        keep[on] = keep[off] = True
        if keep.any():
            yield i[keep], period[keep]


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each sequence of word numbers (0 and up) its runs: rows of start,
    length, period, by start and then period."""
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    held, size = [], 0
    for k, words in enumerate(texts):
        if len(words) < LEAST:
            continue
        found = list(anchors(np.concatenate([[-1], words, [-2]])))
        if found:
            held.append((k, *(np.concatenate(x) for x in zip(*found))))
            size += len(words)
        if size >= TOGETHER:
            _extended(texts, held, out)
            held, size = [], 0
    if held:
        _extended(texts, held, out)
    return out


def _extended(texts: list[np.ndarray], held: list[tuple], out: list[np.ndarray]) -> None:
    """Extend the anchors of some texts over one structure for each direction."""
    most, parts, starts, at = max(int(texts[k].max()) for k, _, _ in held) + 1, [], [], 0
    for n, (k, _, _) in enumerate(held):
        parts += [[most + n], texts[k]]
        starts.append(at)
        at += 1 + len(texts[k])
    w = np.concatenate([*parts, [most + len(held)]]).astype(np.int64)
    owner = np.concatenate([np.full(len(i), n) for n, (_, i, _) in enumerate(held)])
    i = np.concatenate([i + starts[n] for n, (_, i, _) in enumerate(held)])
    p = np.concatenate([p for _, _, p in held])
    after = Extensions(w).extend(i, i + p)
    last = len(w) - 1
    before = Extensions(w[::-1].copy()).extend(last - (i - 1), last - (i + p - 1))
    length = after + before + p
    good = length >= np.maximum(TIMES * p, LEAST)
    rows = np.stack([owner, i - before - 1 - np.array(starts)[owner], length, p], 1)[good]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)  # the smallest period of a stretch
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cut = np.searchsorted(rows[:, 0], np.arange(len(held) + 1))
    for n, (k, _, _) in enumerate(held):
        out[k] = rows[cut[n] : cut[n + 1], 1:]


def stretched(words: list, doc_id: int) -> list:
    """The query's input: every tenth document, by the hash of its id, repeats
    the words from some place on with some period."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def period_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", stretch: bool = False) -> DataFrame:
    """(key, runs, collapsed) of every row: the runs as structs of start,
    length and period in order, and the text without the repetitions (what a
    run has after its first period goes; words joined by one space)."""
    def run(batches):
        for b in batches:
            ids, column = b.column(0).to_pylist(), b.column(1).cast(pa.large_binary())
            done: list[tuple[np.ndarray, bytes]] = []
            held: list[tuple[list, np.ndarray]] = []
            number: dict[bytes, int] = {}
            size = 0
            for k in range(len(ids)):
                words = WORDS.findall(column[k].as_py() or b"")
                if stretch and ids[k] is not None:
                    words = stretched(words, ids[k])
                held.append((words, np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))))
                size += len(words)
                if size >= TOGETHER or k + 1 == len(ids):
                    for (words, _), runs in zip(held, runs_of([x for _, x in held])):
                        done.append((runs, collapsed(words, runs)))
                    held, number, size = [], {}, 0
            ends = np.concatenate([[0], np.cumsum([len(r) for r, _ in done])]).astype(np.int32)
            flat = np.concatenate([r for r, _ in done]) if done else np.zeros((0, 3), np.int64)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, c].copy(), pa.int64()) for c in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), structs), pa.array([t for _, t in done], pa.binary())], ["key", "runs", "collapsed"])

    out = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, "key long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.select(F.col("key").alias(key), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def collapsed(words: list, runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return b" ".join(words[i] for i in kept)


def op13_periods(spark, sf_dir):
    found = period_runs(table(spark, sf_dir, "documents", "doc_id", "text"), stretch=True)
    # the greatest length / period; of equal ones the first, which has the smallest start and then period
    best = F.reduce("runs", F.expr("CAST(NULL AS struct<start:long,length:long,period:long>)"), lambda a, r: F.when(
        a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
