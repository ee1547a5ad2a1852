import math
import random

from tickwise.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, k):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asks = {}
    for i, v in fine:
        if i % K.EVERY == 0:
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, a in asks.items():
        found = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in fine if i != q and len(v) == len(a))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def case(seed, n=700):
    rng = random.Random(seed)
    half = lambda: rng.randrange(-6, 7) / 2  # noqa: E731  exact in a float, many ties
    rows = [(i, [half() for _ in range(4)]) for i in range(n)]
    rows += [(n + i, [1.5, -1.0, 0.5, 3.0]) for i in range(300)]
    rows += [(5000, None), (5100, [float("nan"), 1.0, 1.0, 1.0]), (5200, [None, 1.0, 1.0, 1.0]), (5300, [float("inf")] * 4), (None, [1.0] * 4),
             (5400, []), (5401, []), (5500, [1.0]), (5501, [2.0]), (5600, [1.0, 2.0]), (200, [3.0, 3.0, 3.0, 3.0]), (201, [0.5] * 4), (201, [0.5] * 4)]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force_in_one_cell_and_in_many(spark, monkeypatch):
    for seed, shard, block in ((1, 10_000, 10_000), (2, 90, 3)):
        monkeypatch.setattr(K, "SHARD", shard)
        monkeypatch.setattr(K, "BLOCK", block)
        monkeypatch.setattr(K, "LEAF", 8)
        rows = case(seed)
        t = table(spark, rows)
        assert rows_of(K.top_k(t, t.where("vec_id % 100 = 0"))) == brute(rows, 10)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2**40 + 2**20 * (i % 7)), float(-(2**39)), 1.0]) for i in range(120)]
    t = table(spark, rows)
    got, want = rows_of(K.top_k(t, t.where("vec_id % 100 = 0"))), brute(rows, 10)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [max(-(2**63), min(2**63 - 1, r[3])) for r in want]


def test_boxes_are_closed_without_being_opened():
    import numpy as np
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.1, (500, 3)) for c in ([9, 0, 0], [-9, 0, 0], [0, 9, 0], [0, -9, 0])])
    tree = K.Tree(np.arange(2000), points)
    opened = []
    tree.rows = type("Seen", (dict,), {"__getitem__": lambda s, n: opened.append(n) or dict.__getitem__(s, n)})(tree.rows)
    found = tree.search(-1, np.array([1.0, 0, 0]), 10, K.LEAST)
    assert [i for _, i in found] == np.argsort(-points[:, 0], kind="stable")[:10].tolist() and len(opened) <= len(tree.rows) / 3


def test_empty_and_one_row(spark):
    t = table(spark, [])
    assert K.top_k(t, t).count() == 0
    t = table(spark, [(100, [1.0])])
    assert K.top_k(t, t).count() == 0
