import hashlib
import math
import random

import numpy as np
import pytest

from tickwise.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, key string, cluster int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dims):
    """Plain rounds over whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    raw = lambda v: np.array(v, np.int32).tobytes()
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", raw(r[1])))
    c = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        to = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            of = [v for (_, v), t in zip(kept, to) if t == j]
            if of:
                c[j] = [sum(x) // len(of) for x in zip(*of)]
    return sorted(((i, *reversed(near(v))) for i, v in kept), key=str), c


def clouds(n, dims, seed):
    rng = random.Random(seed)
    mids = [[rng.uniform(-2, 2) for _ in range(dims)] for _ in range(9)]
    pick = lambda: [round((m + rng.gauss(0, 0.2)) * 64) / 64 for m in rng.choice(mids)]
    return [(i, pick()) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_rounds_equal_brute_force(spark, seed):
    rows = clouds(400, 6, seed)
    state, history = C.clusters(table(spark, rows).repartition(5), k=12, dims=6)
    want, centroids = brute(rows, 12, 5, 6)
    assert history[-1].tolist() == centroids and len(history) == 6
    assert sorted((tuple(r) for r in C.exact(state, history[-1], 6).collect()), key=str) == want
    # the bounds spare most of the work
    assert state.agg({"computed": "sum"}).first()[0] < 400 * 12 / 3


def test_query_with_odd_rows(spark, tables):
    rows = clouds(150, 64, 3) + [(900 + i, [1.0] * 64) for i in range(60)] + [(5, [0.5] * 64), (5, [0.5] * 64), (None, [0.25] * 64)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [None] + [1.0] * 63), (304, [float("nan")] * 64), (305, [float("inf")] * 64)]
    want, c = brute(rows, 40, 5, 64)
    got = C.op11_centroids(spark, tables(embeddings=table(spark, rows))).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    for r in got:
        assert r.centroid_sha256 == sha[r.cluster] and r.inertia == sum(w[2] for w in want)
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)


def test_large_components_are_exact(spark):
    rows = [(i, [float((i * 7919 + k) % 400000 - 200000) for k in range(4)]) for i in range(60)]
    state, history = C.clusters(table(spark, rows), k=5, dims=4, rounds=3)
    want, centroids = brute(rows, 5, 3, 4)
    assert history[-1].tolist() == centroids
    assert sorted((tuple(r) for r in C.exact(state, history[-1], 4).collect()), key=str) == want


def test_few_and_no_vectors(spark, tables):
    got = C.op11_centroids(spark, tables(embeddings=table(spark, [(1, [1.0] * 64), (2, None)]))).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in got] == [(1, 0, 0, 0)]
    none = C.op11_centroids(spark, tables(embeddings=table(spark, [(2, None)])))
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="after scaling"):
        C.clusters(table(spark, [(1, [1e9] * 64)]))
