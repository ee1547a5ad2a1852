import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tickwise.llm import periods as P


def brute(words):
    """All runs by looking at every period and every stretch."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(120):
        words = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([0, 5, 23, 24, 60, 300]))]
        for _ in range(rng.randrange(4)):
            unit = [rng.randrange(5) for _ in range(rng.choice([1, 2, 3, 7, 8, 12, 40, 90]))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * rng.randrange(2, 14))[: rng.randrange(10, 400)]
        out.append(words)
    return out


def test_runs_equal_brute_force():
    for seed in range(3):
        some = texts(seed)
        got = P.runs_of([np.array(t, np.int64) for t in some])
        for t, g in zip(some, got):
            assert [tuple(x) for x in g.tolist()] == brute(t)


def test_runs_together_or_alone(monkeypatch):
    some = [np.array(t, np.int64) for t in texts(9)]
    whole = P.runs_of(some)
    monkeypatch.setattr(P, "TOGETHER", 100)
    monkeypatch.setattr(P, "GRID", 50)
    assert all((a.shape == b.shape) and (a == b).all() for a, b in zip(whole, P.runs_of(some)))


def test_extensions_equal_brute_force():
    rng = random.Random(4)
    unit = [rng.randrange(3) for _ in range(150)]
    w = np.array((unit * 9)[:1300] + [rng.randrange(2) for _ in range(700)] + [5], np.int64)
    e = P.Extensions(w)
    i, j = np.array([rng.randrange(1999) for _ in range(4000)]), np.array([rng.randrange(2000) for _ in range(4000)])
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, e.extend(i, j)):
        n = 0
        while max(a, b) + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        assert got == n


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def check(spark, tables, docs_of, rows):
    got = sorted((tuple(r) for r in P.op13_periods(spark, tables(documents=docs_of(rows))).collect()), key=str)
    assert got == sorted((expected(*r[:2]) for r in rows), key=str)


def test_query_equals_brute_force(spark, tables, docs_of):
    rows = [(i, " ".join(f"w{x}é" for x in t)) for i, t in enumerate(texts(5))]
    rows += [(1000 + i, " ".join(f"v{(i * 7 + k) % 400}" for k in range(300))) for i in range(60)]
    check(spark, tables, docs_of, rows)


def test_odd_rows(spark, tables, docs_of):
    long = " \t".join(["a"] * 30 + [str(i) for i in range(3000)] + ["x", "y"] * 5000)
    check(spark, tables, docs_of, [(1, None), (2, ""), (3, " \n"), (None, "a " * 40), (5, long), (5, long), (6, "b c " * 30), (6, "other")])


def test_empty_table(spark, tables, docs_of):
    out = P.op13_periods(spark, tables(documents=docs_of([(1, "x")]).where("false")))
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "n_runs"]
