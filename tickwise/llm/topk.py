"""Exact top-k search by inner product over KD-trees, one per shard.

The vectors are dealt to shards of a bounded number of rows, the queries to
blocks of a bounded number; a task holds one shard and one block.  It builds a
KD-tree over its shard (median splits, tight bounding boxes) and walks it best
first for each query: a box's bound is the sum over the dimensions of the
larger of q * low and q * high, and a box whose bound is below the k-th best
score so far is not opened.  That k-th score starts from what one pilot shard
gave the query, so all other shards prune by it from their first box on.

Components are floor(1024 * x), scores their integer inner product.  Ties go
to the smaller id: a box also knows its least id, so equal bounds are decided
exactly and large groups of equal vectors stay closed.

Edge cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part; an empty vector takes part with score 0;
vectors only meet vectors of the same length; of repeated rows of an id, one
asks (the least vector, where they differ), each other id's row is a
candidate, and rows with the query's own id are not; a query without
candidates gives no row; scores beyond a long stop at its ends; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, table

K = 10
SCALE = 1024
SHARD = 4096  # vectors of a shard, about
BLOCK = 4096  # queries of a block, about
LEAF = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1
EVERY = 100  # ids divisible by this ask


def prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim): whole-number vectors of the rows that take part."""
    x = F.col(vector)
    fine = x.isNotNull() & F.col(key).isNotNull() & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where(fine).select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"), F.size(x).alias("dim"))


class Tree:
    """A KD-tree over one shard, in arrays; node i has children 2i+1, 2i+2."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.low, self.high, self.least, self.rows = {}, {}, {}, {}
        todo = [(0, np.arange(len(ids)))]
        while todo:
            node, rows = todo.pop()
            p = self.points[rows]
            self.low[node], self.high[node] = p.min(0), p.max(0)
            self.least[node] = int(self.ids[rows[0]])
            spread = self.high[node] - self.low[node]
            if len(rows) <= LEAF or not len(spread):
                self.rows[node] = rows
                continue
            at = int(spread.argmax())
            # rows are in order of id; a stable sort keeps that among equal values
            half = np.argsort(p[:, at], kind="stable")
            m = len(rows) // 2
            todo.append((2 * node + 1, np.sort(rows[half[:m]])))
            todo.append((2 * node + 2, np.sort(rows[half[m:]])))

    def bound(self, node: int, q: np.ndarray):
        return np.maximum(q * self.low[node], q * self.high[node]).sum()

    def search(self, query: int, q: np.ndarray, k: int, floor) -> list[tuple]:
        """At most k (score, id), best first: those that can be among the k
        best overall, given that k others score ``floor`` or more."""
        best: list[tuple] = []  # heap of (score, -id): the worst is first
        queue = [(-self.bound(0, q), self.least[0], 0)]
        while queue:
            upper, least, node = heapq.heappop(queue)
            upper = -upper
            if upper < floor or len(best) == k and (upper, -least) <= best[0]:
                if upper < floor or upper < best[0][0]:
                    break
                continue
            if node not in self.rows:
                for child in (2 * node + 1, 2 * node + 2):
                    queue_item = (-self.bound(child, q), self.least[child], child)
                    if -queue_item[0] >= floor:
                        heapq.heappush(queue, queue_item)
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ q
            near = np.flatnonzero(scores >= max(floor, best[0][0] if len(best) == k else floor))
            for i in near:
                item = (scores[i], -int(self.ids[rows[i]]))
                if -item[1] == query:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def exact(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floats where every sum of products is exact in them, else as
    Python integers."""
    most = float(np.abs(points.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0)) * points.shape[1]
    kind = np.float64 if most < 2.0**52 else object
    return points.astype(kind), queries.astype(kind)


def search_cells(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """candidates: (cell, id, v); queries: (cell, id, v, floor).  The k best
    of each query in each cell."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            stack = lambda s: np.array(s.tolist(), np.int64).reshape(len(s), -1)
            points, asks = exact(stack(left["v"]), stack(right["v"]))
            tree = Tree(left["id"].to_numpy(np.int64), points)
            for query, q, floor in zip(right["id"].tolist(), asks, right["floor"].tolist()):
                out += [(query, i, min(MOST, max(LEAST, int(s)))) for s, i in tree.search(query, q, k, floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return candidates.groupBy("cell").cogroup(queries.groupBy("cell")).applyInPandas(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each
    row of ``queries``."""
    base = stash(prepared(vectors, key, vector).withColumn("place", F.monotonically_increasing_id()))
    asks = stash(prepared(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    rows, n_asks = base.count(), asks.count()
    shards, blocks = max(1, -(-rows // SHARD)), max(1, -(-n_asks // BLOCK))
    # by the written row number, so that many rows of one id or one vector are spread like any others
    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(1), F.col("id")), F.lit(blocks)).cast("int")
    cell = F.struct("dim", "shard", "block")
    dealt = base.withColumn("shard", shard).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("cell", cell)
    every = asks.withColumn("block", block).withColumn("pilot", F.pmod(F.xxhash64(F.lit(2), F.col("id")), F.lit(shards)).cast("int"))

    none = F.lit(LEAST).cast("long")
    first = every.withColumn("shard", F.col("pilot")).withColumn("cell", cell).withColumn("floor", none)
    pilots = stash(search_cells(dealt.select("cell", "id", "v"), first.select("cell", "id", "v", "floor"), k))
    kth = pilots.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    informed = every.join(kth, every["id"] == kth["query_id"], "left").withColumn("floor", F.coalesce("least", none))
    rest = (informed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != F.col("pilot"))
            .withColumn("cell", cell))
    found = pilots.union(search_cells(dealt.select("cell", "id", "v"), rest.select("cell", "id", "v", "floor"), k))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score
  FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
