"""MinHash near-duplicates by a multi-index Hamming join.

A text's set holds its distinct five-word shingles.  Texts with equal sets
form a class, with a number of its own, and go on as one.  Each class gets a signature of ``CHUNKS *
WIDTH`` minima of ``BITS`` bits.  By the pigeonhole principle two signatures
that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` minima have a chunk with
at most ``ERRORS`` differing minima; listing, for each chunk, what is left
when ``ERRORS`` of its minima are taken out gives keys of which such a pair
shares one.  Each minimum multiplies the hashes by an odd number of its own, so
that the minima are independent in small sets too.  At a similarity of 0.75 the
keys miss a pair with a probability of 6e-6, and less above.  Two sketches are
compared inside the join, so that hopeless pairs never become rows: an odd
sketch of ``ODD`` bits (each shingle flips one; as many bits differ as shingles
do, or fewer, so a pair with more than a seventh of both sizes is certainly
below 0.75), and, for pairs of ``LARGE`` shingles or more together, 256 minima
of two bits, which drops pairs more than 5.5 deviations off: 1.3e-7 at 0.75,
2e-12 at 0.8.  What is left is confirmed on the full sets.

No group is expanded into all its pairs.  Of keys with the same members one
is kept.  First every member of a key is
compared with one hub, the member that shares most keys.  The components of
these links are then compared across only: in each key, members outside its
largest component with the others.  A key held by thousands of near copies of
one text thus costs about as many comparisons as it has members.

Edge cases: texts without words (null, empty, blank) have an empty set and
link with nothing; a text with fewer than five words has its sequence as its
one shingle; rows with a null doc_id link with nothing and are kept, with a
null component; rows of one doc_id are one document, whatever their texts: its
component holds what any of them links with; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as T
from .common import stash, table

CHUNKS, WIDTH, ERRORS = 12, 5, 1  # ERRORS is 1: each chunk gives WIDTH keys
BITS = 16
MINIMA = CHUNKS * WIDTH
SKETCH = 256  # minima of two bits each, in eight longs
LONGS = [f"s{i}" for i in range(SKETCH // 32)]
ODD = 1024  # bits of the odd sketch
ODDS = [f"o{i}" for i in range(ODD // 64)]
SKETCHES = [*LONGS, *ODDS]
FARTHEST = 82  # of 256: 48 expected at 0.75, deviation 6.24
LARGE = 400  # shingles of a pair; below, the odd sketch is nearly exact
#: Links: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Ids that are sent to all executors at most: 16 bytes each.
BROADCAST_ROWS = 2_000_000

SEEDS = T.seeds(SKETCH, 5000) | T.U(1)


def minima(h: np.ndarray) -> np.ndarray:
    """The least product of a hash with each seed: each seed orders the hashes
    anew, so two sets agree as often as they are similar, seed by seed."""
    out = np.full(SKETCH, T.MASK, np.uint64)
    for a in range(0, len(h), 512):
        np.minimum(out, np.multiply.outer(h[a : a + 512], SEEDS).min(0), out=out)
    return out


def signature(m: np.ndarray) -> np.ndarray:
    """16 bits of each of the first minima."""
    return m[:MINIMA].astype(np.uint16)


def two_bits(m: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, of the product and not of the hash: in a small
    set few hashes are the minima of all seeds."""
    return (m >> T.U(30)) & T.U(3)


def signed(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64), pa.int64())


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return int(T.mix(h + T.U(11)).sum()) & T.MASK, int(T.mix(h * T.U(T.BASE)).sum()) & T.MASK


def features(docs: DataFrame) -> DataFrame:
    """doc_id, set size, fingerprint of the set, signature and sketch."""
    schema = "doc_id long, n long, f1 long, f2 long, sig binary, " + ", ".join(f"{c} long" for c in SKETCHES)

    def run(batches):
        for b in batches:
            n, f1, f2, sig, sketch, odd = [], [], [], [], [], []
            for _, h in T.shingle_sets(b.column(1)):
                n.append(len(h))
                for f, x in zip((f1, f2), fingerprint(h)):
                    f.append(x)
                m = minima(h)
                sig.append(signature(m).tobytes() if len(h) else None)
                two = two_bits(m).reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * T.U(2))
                sketch.append(np.bitwise_or.reduce(two, 1))
                flips = np.bincount((h >> T.U(20)).astype(np.int64) & (ODD - 1), minlength=ODD) & 1
                odd.append(np.packbits(flips.astype(np.uint8)).view(np.uint64))
            s = np.concatenate([np.array(sketch, np.uint64).reshape(-1, len(LONGS)), np.array(odd, np.uint64).reshape(-1, len(ODDS))], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), signed(f1), signed(f2), pa.array(sig, pa.binary()), *(signed(s[:, i].copy()) for i in range(len(SKETCHES)))],
                ["doc_id", "n", "f1", "f2", "sig", *SKETCHES])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def chunk_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): for each chunk and each of its minima, the others."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            m = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            keys = np.empty((len(m), CHUNKS, WIDTH), np.uint64)
            for out in range(WIDTH):
                left = [i for i in range(WIDTH) if i != out]
                packed = sum(m[:, :, i] << T.U(BITS * k) for k, i in enumerate(left))
                which = np.arange(CHUNKS, dtype=np.uint64) * T.U(WIDTH) + T.U(out + 1)
                keys[:, :, out] = T.mix(packed + which * T.U(T.BASE))
            node = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([signed(keys.reshape(-1)), pa.array(np.repeat(node, MINIMA), pa.int64())], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def distance(a: str, b: str):
    """Number of two-bit minima that differ between two sketches."""
    ones = F.lit(0x5555555555555555).cast("long")
    parts = []
    for c in LONGS:
        x = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        parts.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones)))
    return reduce(lambda p, q: p + q, parts)


def odd_distance(a: str, b: str):
    """Differing bits of two odd sketches: at most as many as there are
    shingles in one set only."""
    return reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ODDS])


def may_link(a: str, b: str):
    """Sizes and sketches of two classes allow the similarity.  With sets x
    and y, 100 both >= SIMILAR (x + y - both) says that the shingles in one
    set only are (100 - SIMILAR) / (100 + SIMILAR) of x + y at most."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return ((100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)) & ((100 + SIMILAR) * odd_distance(a, b) <= (100 - SIMILAR) * (n + m))
            & ((n + m < LARGE) | (distance(a, b) <= FARTHEST)))


def with_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in the one column of ``ids`` (written,
    distinct); the ids are broadcast up to a checked count, shuffled beyond."""
    ids = ids.toDF(on)
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, on, "left_semi")


def shingle_table(docs: DataFrame) -> DataFrame:
    """(least, f1, f2, grams): id, fingerprint and full set of each text."""
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 64):
                part = b.slice(a, 64)
                sets = [h for _, h in T.shingle_sets(part.column(1))]
                ends = np.concatenate([[0], np.cumsum([len(h) for h in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64())
                f1, f2 = (signed(x) for x in zip(*map(fingerprint, sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), f1, f2, pa.ListArray.from_arrays(pa.array(ends), values)], ["least", "f1", "f2", "grams"])

    return docs.select(F.col("doc_id").cast("long").alias("least"), "text").mapInArrow(run, "least long, f1 long, f2 long, grams array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, grams) of the classes (node, least, f1, f2), each once."""
    ids = stash(nodes.select("least").distinct())
    sets = stash(shingle_table(with_ids(docs.select(F.col("doc_id").cast("long").alias("least"), "text"), ids, "least").toDF("doc_id", "text"))
                 .join(nodes.select("node", "least", "f1", "f2"), ["least", "f1", "f2"]).select("node", "grams"))
    # repeated rows of a document give its set again
    return sets if sets.count() == nodes.count() else stash(sets.dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    found = pairs.join(left, "a").join(right, "b").where(100 * both >= SIMILAR * (F.size("_x") + F.size("_y") - both))
    return found.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached.  Each round
    takes the least label of the neighbours, then the label of that label;
    the labels are written once a round, and the rounds end when none changed."""
    edges = stash(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    total = lambda df: df.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    labels = stash(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")))
    now, before = total(labels), None
    while now != before:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        least = labels.join(near, "node").select("node", F.least("component", "near").alias("via"))
        above = labels.select(F.col("node").alias("via"), "component")
        labels = stash(least.join(above, "via").select("node", F.least("via", "component").alias("component")))
        now, before = total(labels), now
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    every = stash(features(docs))
    solid = every.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stash(solid.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id()))
    own = solid.withColumnRenamed("doc_id", "least").join(classes, ["f1", "f2", "n", "least"]).dropDuplicates(["node"])
    nodes = stash(own.select("node", "least", "f1", "f2", "n", "sig", *SKETCHES))

    keyed = chunk_keys(nodes)
    shared = keyed.groupBy("key").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("m1"), F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("m2")).where("size > 1")
    shared = shared.groupBy("size", "m1", "m2").agg(F.min("key").alias("key")).select("key", "size")
    live = stash(keyed.join(shared, "key"))
    seen = live.groupBy("node").agg(F.sum("size").alias("seen"))
    info = stash(nodes.drop("sig").join(seen, "node"))
    sets = full_sets(docs, info.select("node", "least", "f1", "f2"))
    info = info.drop("least", "f1", "f2")

    members = live.select("key", "node").join(info, "node")
    hubs = members.groupBy("key").agg(F.max(F.struct("seen", -F.col("node"), "node", "n", *SKETCHES)).alias("hub")).select(
        "key", *[F.col(f"hub.{c}").alias(c) for c in ("node", "n", *SKETCHES)])
    star = (members.alias("m").join(hubs.alias("h"), F.col("m.key") == F.col("h.key"))
            .where((F.col("m.node") != F.col("h.node")) & may_link("m", "h"))
            .select(F.col("m.node").alias("a"), F.col("h.node").alias("b")).distinct())
    links = stash(confirmed(star, sets))

    known = components(links)
    members = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = members.groupBy("key", "component").agg(F.count("*").alias("rows"))
    largest = parts.groupBy("key").agg(F.max(F.struct("rows", "component"))["component"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
    open_ = stash(members.drop("seen").join(largest.select("key", "main"), "key").withColumn("inner", F.col("component") == F.col("main")))
    across = (open_.where(~F.col("inner")).alias("o").join(open_.alias("m"), F.col("o.key") == F.col("m.key"))
              .where((F.col("o.component") != F.col("m.component")) & (F.col("m.inner") | (F.col("o.node") < F.col("m.node"))) & may_link("o", "m"))
              .select(F.col("o.node").alias("a"), F.col("m.node").alias("b")).distinct())
    more = stash(confirmed(across, sets))
    rows = stash(solid.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2", "n"]).select("doc_id", "n", "node", "least"))
    torn = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    same = stash(rows.select("doc_id", "node").join(torn, "doc_id").where("node != a").select("a", F.col("node").alias("b")).distinct())
    groups = stash(components(links.union(more).union(same)))
    names = groups.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = rows.join(groups.join(names, "component"), "node", "left").select("doc_id", "n", F.coalesce("component_id", "least").alias("component_id"))
    alone = every.where(~((F.col("n") > 0) & F.col("doc_id").isNotNull())).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_neardup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS meet FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * meet >= 75 * (x.n + y.n - meet)),
r(node, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.node, t.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) t ON t.a = r.reached),
m AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
