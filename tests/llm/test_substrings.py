import hashlib
import random
import re

import numpy as np
import pytest

from tickwise.llm import substrings as S


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - 12 if i is not None else 0):
            g = tuple(w[k : k + 13])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = {k + j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(13)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    fresh = lambda k, of=400: [f"w{rng.randrange(of)}" for _ in range(k)]
    shared = [fresh(rng.choice([12, 13, 14, 30, 80])) for _ in range(8)] + [["a"] * 40, ["a", "b"] * 30, ["x", "y", "z"] * 50]
    texts = []
    for _ in range(n):
        w = fresh(rng.choice([0, 3, 20, 120]), rng.choice([4, 400]))
        for _ in range(rng.randrange(4)):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[a : a + rng.randrange(5, 90)] if rng.random() < 0.5 else p
        texts.append(w)
    for _ in range(n // 3):  # near and exact copies
        w = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            if w:
                w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
        texts.append(w)
    ids = rng.sample(range(5000), len(texts))
    return [(i, " ".join(w)) for i, w in zip(ids, texts)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, docs_of, seed):
    rows = corpus(seed)
    found = S.without_repeats(docs_of(rows).repartition(4)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str) == brute(rows)
    # every span is where it says in its source, which is a smaller document
    text = {i: words_of(t) for i, t in rows}
    for r in found:
        for s in r.spans:
            assert s.source < r.doc_id and s.length >= 13
            assert text[r.doc_id][s.start : s.start + s.length] == text[s.source][s.source_start : s.source_start + s.length]


def test_a_long_copy_is_one_span(spark, docs_of):
    rng = random.Random(1)
    body = [f"w{rng.randrange(10**6)}" for _ in range(700)]
    rows = [(1, " ".join(["new"] * 3 + body)), (2, " ".join(body + ["end"])), (3, "other " + " ".join(body[100:400]))]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in S.without_repeats(docs_of(rows)).collect()}
    assert got[1] == [] and got[2][0][:1] == (0,) and sum(s[1] for s in got[2]) - 12 * (len(got[2]) - 1) == 700
    assert got[3][0][0] == 1 and got[3][-1][0] + got[3][-1][1] == 301


def test_odd_rows(spark, tables, docs_of):
    s = " ".join(f"s{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "too short to have a window"), (None, s), (7, s), (7, s), (7, s + " more"), (9, "start " + s), (9, s), (-5, " ".join(f"s{i}" for i in range(4, 17)))]
    got = S.op12_substrings(spark, tables(documents=docs_of(rows))).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, n, m, sha(t)) for i, n, m, t in brute(rows)), key=str)


def test_empty_and_without_repeats(spark, docs_of):
    assert S.without_repeats(docs_of([(1, "x")]).where("false")).count() == 0
    r = S.without_repeats(docs_of([(1, "a b  c")])).first()
    assert (r.n_words, r.n_removed, r.kept, r.spans) == (3, 0, "a b c", [])


@pytest.mark.parametrize("bits", [15, 28])
def test_joins_without_broadcast_and_with_a_small_bitmap(spark, docs_of, monkeypatch, bits):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(S, "BITS", bits)
    rows = corpus(7, 60)
    found = S.without_repeats(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str) == brute(rows)


def test_pieces_cover_every_window_once():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 6, 500).astype(np.uint64)
    owner = np.sort(rng.integers(0, 20, 500))
    starts, n, _ = S.cut(words, owner)
    covered = np.concatenate([np.arange(s, s + k) for s, k in zip(starts, n)])
    assert sorted(covered.tolist()) == [i for i in range(488) if owner[i] == owner[i + 12]]


def test_bitmap_holds_the_repeated_anchors(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-(2**63), 2**63), 1) for _ in range(500)] + [(m, d) for m in (0, 1, 2**28 - 1, 2**28, -1, 7 << 40) for d in (1, 2)] + [(55, 3), (55, 3)]
    bits = S.repeated_anchors(spark.createDataFrame(rows, "m long, doc long"))
    on = {i * 8 + k for i in np.flatnonzero(bits) for k in range(8) if bits[i] >> k & 1}
    assert on == {0, 1, 2**28 - 1, (7 << 40) % 2**28}
