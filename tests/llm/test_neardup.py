import random
import re

import numpy as np
import pyarrow as pa

from tickwise.llm import neardup as N
from tickwise.llm import tokens as T


def brute_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def brute_components(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, brute_set(t))
    label = {i: i for i in sets if i is not None}
    links = [(a, b) for a in label for b in label if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                moved = True
    return sets, label


def corpus(seed=1, groups=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "ß!", "Ab"]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            t = list(base)
            for _ in range(rng.randrange(0, max(1, len(t) // 14) + 1)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((" " * rng.randrange(2)).join(["", rng.choice([" ", "\n", "\t "]).join(t)]))
    rows += ["", None, " \n\t", "one two", "ONE two", "one  two ", "one two three", rows[5], rows[5].upper() if rows[5].isascii() else rows[5]]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(7 * k + 3, rows[i]) for k, i in enumerate(order)]


def test_equals_brute_force(spark, docs_of):
    for seed in (1, 2):
        rows = corpus(seed)
        sets, label = brute_components(rows)
        got = N.near_duplicates(docs_of(rows)).collect()
        assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
        for r in got:
            assert r.n_shingles == len(sets[r.doc_id]), r
            assert r.component_id == label[r.doc_id] and r.kept == (r.doc_id == label[r.doc_id]), r


def test_null_ids_repeats_and_empty_table(spark, docs_of):
    t = " ".join(f"a{i}" for i in range(50))
    got = N.near_duplicates(docs_of([(None, t), (5, t), (5, t), (9, t + " end"), (None, None)])).collect()
    by = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in got), key=str)
    assert by == sorted([(0, None, True), (0, None, True), (5, 5, True), (5, 5, True), (9, 5, False)], key=str)
    assert N.near_duplicates(docs_of([])).count() == 0


def test_a_hub_and_its_near_copies_make_few_pairs(spark, docs_of):
    rng = random.Random(3)
    base = [f"b{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for i in range(300):
        t = list(base)
        for _ in range(i % 4):
            t[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    _, label = brute_components(rows)
    assert {r.doc_id: r.component_id for r in N.near_duplicates(docs_of(rows)).collect()} == label


def test_keys_keep_the_promise_of_the_chunks(spark):
    """Signatures that differ in as many minima as the pigeonhole principle
    allows share a key, wherever the differences are."""
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 1 << 16, N.MINIMA).astype(np.uint16)
    rows = [(0, sig.tobytes())]
    for i in range(1, 60):
        other = sig.copy()
        other[rng.choice(N.MINIMA, N.CHUNKS * (N.ERRORS + 1) - 1, replace=False)] ^= 1
        rows.append((i, other.tobytes()))
    df = spark.createDataFrame([(a, bytearray(b)) for a, b in rows], "node long, sig binary")
    keys = {}
    for r in N.chunk_keys(df).collect():
        keys.setdefault(r.node, set()).add(r.key)
    assert all(len(k) == N.MINIMA and k & keys[0] for k in keys.values())


def test_long_text_in_pieces_has_the_same_set():
    t = " ".join(f"é{i % 9973} x{i % 7919}" for i in range(150_000))
    (_, h), = T.shingle_sets(pa.array([t]))
    assert len(h) == len(brute_set(t))
    same = dict(T.shingle_sets(pa.array(["a", t.replace(" ", "\n "), None, "", "b c"])))
    assert np.array_equal(same[1], h) and len(same[2]) == len(same[3]) == 0 and len(same[4]) == 1
    word = "y" * 2_500_000
    sets = dict(T.shingle_sets(pa.array([word + " a b c d e", "z", word + "\ta B c d e"])))
    assert np.array_equal(sets[0], sets[2]) and len(sets[0]) == 2


def test_pairs_of_small_sets_share_keys_and_pass_the_sketches(spark):
    """4,800 pairs of 4 to 40 shingles at 0.75 to 0.80, and larger ones."""
    rng = np.random.default_rng(8)
    rows, far = [], 0
    for union, meet in [(4, 3), (8, 6), (12, 9), (20, 15), (40, 30), (5, 4), (10, 8), (20, 16)]:
        for _ in range(600):
            h = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            split = meet + (union - meet) // 2
            a, b = N.minima(h[:split]), N.minima(np.concatenate([h[:meet], h[split:]]))
            far += int((N.two_bits(a) != N.two_bits(b)).sum() > N.FARTHEST)
            rows += [(len(rows), N.signature(a).tobytes()), (len(rows) + 1, N.signature(b).tobytes())]
    df = spark.createDataFrame([(i, bytearray(s)) for i, s in rows], "node long, sig binary")
    keyed = N.chunk_keys(df).selectExpr("key", "node", "node div 2 as pair")
    together = keyed.groupBy("pair", "key").count().where("count > 1").select("pair").distinct().count()
    assert together == len(rows) // 2 and far == 0


def test_short_near_copies_are_all_linked(spark, docs_of):
    """Three thousand pairs of texts of 4 to 40 shingles, at 0.75 to 0.80."""
    rng = random.Random(9)
    rows, pairs = [], 0
    for union, meet in [(4, 3), (8, 6), (12, 9), (20, 15), (40, 30), (5, 4)]:
        for _ in range(500):
            words = [f"p{pairs}w{k}" for k in range(union + 4)]
            rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(words[: meet + 4]))]
            pairs += 1
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs_of(rows)).collect()}
    assert [i for i in range(pairs) if got[2 * i + 1] != 2 * i] == []


def test_rows_of_one_id_link_all_that_they_hold(docs_of):
    """Pairs of ids that share no text, joined by a third id with a near copy of
    each; and an id with three texts.  200 such groups."""
    rng = random.Random(12)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(30)]
    rows = []
    for g in range(200):
        a, b = text(), text()
        rows += [(10 * g + 3, " ".join(a)), (10 * g + 2, " ".join(b)), (10 * g + 5, " ".join(a + ["x"])), (10 * g + 5, " ".join(b + ["y"]))]
    rows += [(9000, " ".join(text())), (9000, " ".join(text())), (9000, " ".join(text())), (9000, None)]
    rng.shuffle(rows)
    got = N.near_duplicates(docs_of(rows)).collect()
    for r in got:
        want = 10 * (r.doc_id // 10) + 2 if r.doc_id < 9000 else 9000
        assert r.component_id == want and r.kept == (r.doc_id == want)
