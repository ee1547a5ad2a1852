"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Each vector keeps, for every centroid, a lower bound on its distance and the
round in which that distance was last computed.  The centroids of all rounds
are kept (``k * dims`` numbers a round), so a bound of round T is loosened in
round t by ``|c(t) - c(T)|``, the norm of the whole displacement since then,
which is never more than the sum of the drifts of the rounds between.  The
bound on the own centroid is loosened upwards the same way.  A centroid whose
lower bound is above the own one's upper bound can't be nearer; if any fails,
the own distance is computed and the test repeated, and what still fails is
computed exactly.  Bounds are floats with a margin, distances whole numbers,
so every assignment is exact and ties go to the smaller number.

A round maps the table of vectors and bounds to the next one, written in the
shared folder (no shuffle); then the vectors that changed their cluster are
read again and their whole-number sums go from the old cluster to the new one.
The driver sees sums of ``k * dims`` numbers, however many vectors there are.

Vectors are ``floor(scale * x)`` of each component; those that are null, have
another number of components, or hold a null or non-finite component take no
part.  A component of ``LIMIT`` or more after scaling raises an error, since
distances might not fit a long.

Edge cases: rows with a null id are clustered but never start a centroid while
others are left; repeated rows of an id count as often as they occur (as start
centroids too); fewer vectors than ``k`` give fewer centroids; an empty
cluster keeps its centroid; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stash, table

K, DIMS, ROUNDS, SCALE, SEED = 40, 64, 5, 256, 2
LIMIT = 1 << 27
#: Up to this size of a component, sums of products are exact in a double.
SMALL = 1 << 22
#: Distances computed together, about.
PAIRS = 1 << 16
DOWN, UP = 1 - 2.0**-22, 1 + 2.0**-20
STATE = "key long, v binary, was int, cluster int, distance long, low binary, at binary, computed int, moved boolean"


def prepared(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(key, v): whole-number vectors of the rows that take part, as 32-bit numbers."""
    def run(batches):
        for b in batches:
            ids, column = b.column(0), b.column(1)
            start, end = np.asarray(column.offsets)[:-1], np.asarray(column.offsets)[1:]
            rows = np.flatnonzero((end - start == dims) & np.asarray(column.is_valid()))
            x = np.asarray(pc.fill_null(column.values.cast(pa.float64()), float("nan")))[start[rows][:, None] + np.arange(dims)]
            fine = np.isfinite(x).all(1)
            rows, x = rows[fine], np.floor(x[fine] * scale)
            if (np.abs(x) >= LIMIT).any():
                raise ValueError(f"a component is {LIMIT} or more after scaling")
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), packed(x.astype(np.int32))], ["key", "v"])

    return vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("x")).mapInArrow(run, "key long, v binary")


def packed(x: np.ndarray) -> pa.Array:
    """The rows of an array as binary values."""
    raw = np.ascontiguousarray(x).tobytes()
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    """The binary values of a column, which all have ``width`` numbers, as rows."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind).reshape(len(column), width)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows."""
    out = np.empty(len(x), np.int64)
    for a in range(0, len(x), PAIRS):
        d = x[a : a + PAIRS].astype(np.int64) - c[a : a + PAIRS]
        out[a : a + PAIRS] = np.einsum("ij,ij->i", d, d)
    return out


def all_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every row of c."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= SMALL:
        y, z = x.astype(np.float64), c.astype(np.float64)
        return ((y * y).sum(1)[:, None] - 2 * (y @ z.T) + (z * z).sum(1)).astype(np.int64)
    return np.stack([distances(x, np.broadcast_to(r, x.shape)) for r in c], 1)


def assigned(points: DataFrame, history: list[np.ndarray], dims: int, first: bool) -> DataFrame:
    """The state after assigning every vector to the last centroids of ``history``."""
    t, now = len(history) - 1, history[-1]
    k = len(now)
    # displacement of each centroid since each round, a little more than it is
    gone = np.stack([np.sqrt(((now - old).astype(np.float64) ** 2).sum(1)) for old in history]) * (1 + 1e-9)

    def begin(x):
        d = all_distances(x, now)
        cluster = d.argmin(1)
        return np.full(len(x), -1), cluster, d[np.arange(len(x)), cluster], (np.sqrt(d) * DOWN).astype(np.float32), np.full((len(x), k), t, np.uint8), np.full(len(x), k)

    def go_on(x, was, low, at):
        low, at, rows = low.copy(), at.copy(), np.arange(len(x))
        bound = low - np.take_along_axis(gone, at.astype(np.int64), 0)
        up = low[rows, was] * UP + gone[at[rows, was], was]
        fails = bound <= up[:, None]
        fails[rows, was] = False
        some = np.flatnonzero(fails.any(1))
        own = distances(x[some], now[was[some]])
        root = np.sqrt(own)
        low[some, was[some]], at[some, was[some]] = root * DOWN, t
        fails[some] &= bound[some] <= (root * UP)[:, None]
        best = np.full((len(some), k), np.iinfo(np.int64).max)
        best[np.arange(len(some)), was[some]] = own
        i, j = np.nonzero(fails[some])
        d = distances_of(x, some[i], now, j)
        best[i, j] = d
        low[some[i], j], at[some[i], j] = np.sqrt(d) * DOWN, t
        cluster, computed = was.copy(), np.zeros(len(x), np.int64)
        cluster[some] = best.argmin(1)
        computed[some] = 1 + fails[some].sum(1)
        distance = np.full(len(x), -1)
        distance[some] = best[np.arange(len(some)), cluster[some]]
        return cluster, distance, low, at, computed

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = unpacked(b.column(1), np.int32, dims)
            if first:
                was, cluster, distance, low, at, computed = begin(x)
            else:
                was = np.asarray(b.column(2)).astype(np.int64)
                cluster, distance, low, at, computed = go_on(x, was, unpacked(b.column(3), np.float32, k), unpacked(b.column(4), np.uint8, k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(was, pa.int32()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), packed(low.astype(np.float32)),
                 packed(at.astype(np.uint8)), pa.array(computed, pa.int32()), pa.array(was != cluster)], [c.split()[0] for c in STATE.split(", ")])

    return (points if first else points.select("key", "v", "cluster", "low", "at")).mapInArrow(run, STATE)


def distances_of(x: np.ndarray, i: np.ndarray, c: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (x[i], c[j]), some at a time."""
    out = np.empty(len(i), np.int64)
    for a in range(0, len(i), PAIRS):
        out[a : a + PAIRS] = distances(x[i[a : a + PAIRS]], c[j[a : a + PAIRS]])
    return out


def moves(state: DataFrame, k: int, dims: int) -> list:
    """What the vectors that changed their cluster add to each cluster's sums
    and count (component ``dims``): summed in each task, then in Spark."""
    def run(batches):
        sums = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            x = unpacked(b.column(0), np.int32, dims).astype(np.int64)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], 1)
            was, now = np.asarray(b.column(1)), np.asarray(b.column(2))
            for j in range(k):
                sums[j] += x[now == j].sum(0) - x[was == j].sum(0)
        cluster, i = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(i, pa.int32()), pa.array(sums[cluster, i], pa.int64())], ["cluster", "i", "s"])

    parts = state.where("moved").select("v", "was", "cluster").mapInArrow(run, "cluster int, i int, s long")
    return parts.groupBy("cluster", "i").agg(F.sum("s").alias("s")).collect()  # k * (dims + 1) rows at most


def start(points: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    rows = points.select(rank.alias("rank"), "v").orderBy(F.col("rank").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r.v, np.int32) for r in rows], np.int64).reshape(len(rows), dims)


def clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, dims: int = DIMS,
             rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[np.ndarray]]:
    """The state after the last assignment (key, cluster, distance, computed:
    how many distances the last round needed) and the centroids of all rounds."""
    if not 0 <= rounds < 256:
        raise ValueError("rounds are numbered by one byte")
    points = stash(prepared(vectors, key, vector, dims, scale))
    history = [start(points, k, dims, seed)]
    k = len(history[0])
    if not k:
        return points.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("computed")), history
    sums, state = np.zeros((k, dims + 1), np.int64), stash(assigned(points, history, dims, True))
    release(points)
    for _ in range(rounds):
        for r in moves(state, k, dims):
            sums[r["cluster"], r["i"]] += r["s"]
        full = sums[:, dims] > 0
        c = history[-1].copy()
        c[full] = sums[full, :dims] // sums[full, dims:]
        history.append(c)
        before, state = state, stash(assigned(state, history, dims, False))
        release(before)
    return state, history


def exact(state: DataFrame, centroids: np.ndarray, dims: int) -> DataFrame:
    """(key, cluster, distance): with the distances that the bounds had spared."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, cluster = unpacked(b.column(1), np.int32, dims), np.asarray(b.column(2))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(distances_of(x, np.arange(len(x)), centroids, cluster), pa.int64())], ["key", "cluster", "distance"])

    return state.select("key", "v", "cluster").mapInArrow(run, "key long, cluster int, distance long")


def op11_centroids(spark, sf_dir):
    state, history = clusters(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    found = state if not len(history[-1]) else stash(exact(state, history[-1], DIMS))
    if len(history[-1]):
        release(state)
    of = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    rows = [(j, of.get(j, 0), sum(of.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(history[-1])]
    # one row for each centroid
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    fine = f"len(embedding) = {DIMS} AND list_count(embedding) = {DIMS} AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))"
    parts = [f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {fine})",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v AS m FROM v ORDER BY c LIMIT {K})"]
    for t in range(ROUNDS + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best FROM (
            SELECT vec_id, v, c, list_sum(list_transform(range(1, {DIMS + 1}), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d FROM v, c{t}) GROUP BY vec_id)""")
        if t < ROUNDS:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT c{t}.c, coalesce(n.m, c{t}.m) AS m FROM c{t} LEFT JOIN (
            SELECT c, list((s - ((s % n + n) % n)) // n ORDER BY i) AS m FROM (
              SELECT best.c AS c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{t}, range(1, {DIMS + 1}) g(i) GROUP BY ALL) GROUP BY c) n ON n.c = c{t}.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON c{ROUNDS}.c = best.c"""


SQL = _sql()
