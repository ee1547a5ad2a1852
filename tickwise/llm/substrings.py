"""Substring dedup over a compacted De Bruijn graph of word k-mers.

Nodes are sequences of ``K - 1`` words, edges sequences of ``K``, from the node
of their first words to that of their last; an edge is known by its two nodes.
Only edges that start in two documents or more matter, and they are found
without shuffling every window:

1. The windows of a text are cut into pieces: consecutive windows with the same
   least hash of their ``SEED``-word sequences (their anchor), which depends on
   the window's words alone.  Equal windows have equal anchors, so only pieces
   whose anchor occurs in two documents go on, some five windows to a piece.
   Those anchors are known to the tasks by a bitmap of ``2 ** BITS`` bits, one
   size whatever the corpus; what passes it by chance is found out in step 2.
2. Where all pieces of an anchor have the same content, every document that
   enters such a piece runs through all of it: its edges are a nonbranching
   path and compact at once.  The windows of other anchors are taken one by
   one, once for each content, and grouped by edge.
3. Each piece keeps its source coordinates: the smallest document that holds
   it and the place there.  Pieces are joined with the nodes where they begin
   and end; where one piece ends and one begins, with the same source document,
   the path goes on.  Neighbours in the source are strung together along it,
   and what is left is joined by pointer doubling (a path never goes back in
   its source, so it has an end).
4. Back in the documents, the pieces of a document become spans: stretches that
   run in step with the source coordinates of one path.  A span whose source is
   a smaller document is a repeat; the words its windows cover are removed.

Hashes of 64 bits go in pairs (anchor and content, node and node) wherever two
contents are taken to be equal.

A window of a document is removed if its words also start in a document with a
smaller doc_id, judged on the input.

Edge cases: a null or empty text has no words; texts with fewer than ``K`` words
have no window; rows with a null doc_id are neither source nor changed; rows of
one doc_id are no repeats of each other (none is smaller), different texts of
an id are judged one by one, and repeated rows get the same result each; an
empty table gives an empty result; other columns are ignored.  One text is one
row of one task, some 60 bytes a word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T
from .common import WORD, release, stash, sweep, table

K = 13
SEED = 5
#: Windows of a piece at most.
MOST = 16
#: Size of the bitmap of repeated anchors: 32 MB.
BITS = 28
#: Anchors with several contents that are sent to all executors at most, 8 bytes each; beyond, the same join shuffles.
BROADCAST_ROWS = 1_000_000
#: Pieces of an Arrow batch.
ROWS = 20_000
WORDS = re.compile(WORD.encode())


def sequences(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive words, by doubling."""
    out, done, power, size = None, 0, words, 1
    while True:
        if width & size:
            n = len(words) - done - size + 1
            out = power[:n] if out is None else T.mix(out[:n] * T.U(T.BASE) + power[done : done + n])
            done += size
        size *= 2
        if size > width:
            return out
        n = len(power) - size // 2
        power = T.mix(power[:n] * T.U(T.BASE) + power[size // 2 : size // 2 + n] + T.U(size))


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive numbers."""
    size = 1
    while 2 * size <= width:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def cut(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of some texts: first window, windows, anchor; and the windows' texts."""
    n = len(words) - K + 1
    whole = owner[:n] == owner[K - 1 :]
    anchor = least_of(sequences(words, SEED), K - SEED + 1)
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1]) | (owner[1:n] != owner[: n - 1])
    at, k = np.flatnonzero(whole), np.arange(n)
    since = k - np.maximum.accumulate(np.where(begins, k, 0))
    starts = at[since[at] % MOST == 0]
    ends = np.append(starts[1:], n)
    ends = np.minimum(ends, starts + MOST)
    # the last piece of a text ends with its last window
    last = np.flatnonzero(whole & ~np.append(whole[1:], False))
    ends = np.minimum(ends, last[np.searchsorted(last, starts)] + 1)
    return starts, ends - starts, anchor[starts]


def anchors(docs: DataFrame) -> DataFrame:
    """(m, doc): anchor of every piece."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo, _, words, owner in T.hashed_words(b.column(1), T.SAME):
                if len(words) >= K:
                    starts, _, m = cut(words, owner)
                    yield pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(ids[lo + owner[starts]])], ["m", "doc"])

    return docs.select("doc", "text").mapInArrow(run, "m long, doc long")


def repeated_anchors(found: DataFrame) -> np.ndarray:
    """The bitmap of the anchors of (m, doc) that occur in two documents."""
    place = F.col("m").bitwiseAND(F.lit((1 << BITS) - 1)) + 1  # bitmaps count from 1
    twice = found.groupBy("m").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
    parts = twice.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((max(1, (1 << BITS) >> 15), 4096), np.uint8)
    for r in parts.toLocalIterator():  # as many rows as the bitmap has parts
        out[r["k"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def pieces(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(m, t, doc, row, at, nodes): anchor, content, place and nodes of the
    pieces whose anchor is in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = shared.value
        for b in batches:
            ids, rows = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for lo, hi, words, owner in T.hashed_words(b.column(2), T.SAME):
                if len(words) < K:
                    continue
                node = sequences(words, K - 1)
                first = np.searchsorted(owner, np.arange(hi - lo))
                starts, windows, anchor = cut(words, owner)
                place = (anchor & T.U((1 << BITS) - 1)).astype(np.int64)
                known = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                starts, windows, anchor = starts[known], windows[known], anchor[known]
                for k in range(0, len(starts), ROWS):
                    s, n, m = starts[k : k + ROWS], windows[k : k + ROWS], anchor[k : k + ROWS]
                    ends = np.concatenate([[0], np.cumsum(n + 1)])
                    step = np.arange(ends[-1]) - np.repeat(ends[:-1], n + 1)
                    values = node[np.repeat(s, n + 1) + step]
                    t = T.mix(np.add.reduceat(T.mix(values + step.astype(np.uint64) * T.U(T.BASE)), ends[:-1]) + n.astype(np.uint64))
                    of = lo + owner[s]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(m.view(np.int64)), pa.array(t.view(np.int64)), pa.array(ids[of]), pa.array(rows[of]), pa.array((s - first[owner[s]]).astype(np.int32)),
                         pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))], ["m", "t", "doc", "row", "at", "nodes"])

    return docs.select("doc", "row", "text").mapInArrow(run, "m long, t long, doc long, row long, at int, nodes array<long>")


def few(ids: DataFrame) -> DataFrame:
    """The ids, marked for broadcast up to a checked count."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def repeated_pieces(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths to begin with, as (a, b, head, tail, n, source): pieces whose
    anchor has one content, and single repeated edges of the others.  And
    (m, t, i, a, b): the edges of each content of those others."""
    contents = stash(live.groupBy("m", "t").agg(
        F.min(F.struct("doc", "row", "at")).alias("source"), F.max("doc").alias("last"),
        F.min(F.size("nodes") - 1).alias("n"), F.min(F.col("nodes")[0]).alias("head"), F.min(F.element_at("nodes", -1)).alias("tail")))
    varied = stash(contents.groupBy("m").count().where("count > 1").select("m"))
    of = few(varied)
    plain = contents.where("source.doc < last").join(of, "m", "left_anti").select(F.col("m").alias("a"), F.col("t").alias("b"), "head", "tail", "n", "source", F.lit(True).alias("whole"))
    # one holder of each content shows its nodes
    shown = contents.join(of, "m", "left_semi").select("m", "t", "last", F.col("source.doc").alias("doc"), F.col("source.row").alias("row"), F.col("source.at").alias("at"))
    shown = live.join(of, "m", "left_semi").join(shown, ["m", "t", "doc", "row", "at"])
    step = F.transform(F.sequence(F.lit(0), F.size("nodes") - 2), lambda i: F.struct(i.alias("i"), F.col("nodes")[i].alias("a"), F.col("nodes")[i + 1].alias("b")))
    windows = stash(shown.select("m", "t", "doc", "row", "at", "last", F.explode(step).alias("w")).select("m", "t", "doc", "row", "at", "last", "w.*"))
    edges = windows.groupBy("a", "b").agg(F.min(F.struct("doc", "row", (F.col("at") + F.col("i")).alias("at"))).alias("source"), F.max("last").alias("last"))
    edges = edges.where("source.doc < last").select("a", "b", F.col("a").alias("head"), F.col("b").alias("tail"), F.lit(1).alias("n"), "source", F.lit(False).alias("whole"))
    begun = stash(plain.unionByName(edges))
    release(contents, varied)
    return begun, windows


def compacted(begun: DataFrame) -> DataFrame:
    """(a, b, n, whole, doc, row, at, path): each piece with its source and the place
    in the source where its nonbranching path begins."""
    flat = begun.select("a", "b", "head", "tail", "n", "whole", "source.*")
    meet = flat.select(F.col("tail").alias("node"), F.lit(1).alias("into"), F.lit(0).alias("out"), F.col("doc").alias("came"), F.lit(None).cast("long").alias("went")).union(
        flat.select("head", F.lit(0), F.lit(1), F.lit(None).cast("long"), "doc"))
    smooth = meet.groupBy("node").agg(F.sum("into").alias("into"), F.sum("out").alias("out"), F.max("came").alias("came"), F.max("went").alias("went"))
    smooth = stash(smooth.where("into = 1 AND out = 1 AND came = went").select("node"))
    goes_on = flat.join(smooth.withColumn("_on", F.lit(True)), F.col("head") == F.col("node"), "left").withColumn("_on", F.coalesce("_on", F.lit(False))).drop("node")
    # along the source: a document's pieces are no more than its words
    w = Window.partitionBy("doc", "row").orderBy("at", "a", "b")
    line = goes_on.withColumn("_next", F.col("_on") & F.coalesce(F.lag("tail").over(w) == F.col("head"), F.lit(False)))
    line = line.withColumn("seg", F.max(F.when(~F.col("_next"), F.struct("at", "a", "b"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    line = stash(line)
    # what is left: a stretch that goes on from one that isn't its neighbour
    last = line.groupBy("doc", "row", "seg").agg(F.max_by("tail", F.struct("at", "a", "b")).alias("tail"))
    opened = line.where("_on AND NOT _next").select("doc", "row", "seg", "head")
    to = opened.alias("o").join(last.alias("l"), (F.col("o.doc") == F.col("l.doc")) & (F.col("o.row") == F.col("l.row")) & (F.col("o.head") == F.col("l.tail")) & (F.col("l.seg") < F.col("o.seg")))
    to = stash(to.select("o.doc", "o.row", "o.seg", F.col("l.seg").alias("to")))
    while to.limit(1).count():
        further = to.select("doc", "row", F.col("seg").alias("to"), F.col("to").alias("_then"))
        step = stash(to.select("doc", "row", "seg", "to").join(further, ["doc", "row", "to"], "left").select(
            "doc", "row", "seg", F.coalesce("_then", "to").alias("to"), F.col("_then").isNotNull().alias("moved")))
        release(to)
        to = step
        if not to.where("moved").limit(1).count():
            break
    out = line.join(to.select("doc", "row", "seg", "to"), ["doc", "row", "seg"], "left")
    out = stash(out.select("a", "b", "n", "whole", "doc", "row", "at", F.coalesce("to.at", "seg.at").alias("path")))
    release(smooth, line, to)
    return out


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, row, spans): for each document its repeated windows, as structs of
    first window, windows, source document, place there, start of the path."""
    solid = docs.where(F.col("doc").isNotNull())
    bitmap = repeated_anchors(anchors(solid))
    sweep(docs.sparkSession)
    live = stash(pieces(solid, bitmap))
    begun, windows = repeated_pieces(live)
    sweep(docs.sparkSession)
    paths = compacted(begun)
    release(begun)
    sweep(docs.sparkSession)
    part = lambda i: F.struct(i.alias("i"), "n", F.col("doc").alias("source"), F.col("at").alias("place"), "path")
    alone = paths.where("whole").select(F.col("a").alias("m"), F.col("b").alias("t"), F.array(part(F.lit(0))).alias("parts"))
    many = windows.select("m", "t", "i", "a", "b").join(paths.where("NOT whole"), ["a", "b"]).groupBy("m", "t").agg(F.collect_set(part(F.col("i"))).alias("parts"))
    held = live.select("m", "t", "doc", "row", "at").join(alone.union(many), ["m", "t"]).select("doc", "row", "at", F.explode("parts").alias("p"))
    held = held.where("p.source < doc").groupBy("doc", "row").agg(F.collect_set(F.struct(
        (F.col("at") + F.col("p.i")).alias("start"), F.col("p.n").alias("n"), F.col("p.source").alias("source"), F.col("p.place").alias("place"), F.col("p.path").alias("path"))).alias("spans"))
    out = stash(held)
    release(live, windows, paths)
    sweep(docs.sparkSession)
    return out


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source", pa.int64()), ("source_start", pa.int64())])


def spans_of(start, n, source, place, path) -> np.ndarray:
    """Windows in step with one path of a source become one span of words:
    rows of start, length, source document and place there."""
    order = np.lexsort((place, source, start))
    start, n, source, place, path = (x[order] for x in (start, n, source, place, path))
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + n[:-1]) | (source[1:] != source[:-1]) | (start[1:] - place[1:] != start[:-1] - place[:-1]) | (path[1:] != path[:-1])
    first = np.flatnonzero(new)
    return np.stack([start[first], np.add.reduceat(n, first) + K - 1, source[first], place[first]], 1)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, spans, kept) of every row: the repeated spans
    (start, length in words, smaller document and place there), and the words
    outside them, joined by one space."""
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    both = docs.join(repeats(docs), ["doc", "row"], "left")

    def run(batches):
        for b in batches:
            column, parts = b.column(1).cast(pa.large_binary()), b.column(2)
            lo, hi = np.asarray(parts.offsets)[:-1], np.asarray(parts.offsets)[1:]
            fields = [np.asarray(parts.values.field(f)).astype(np.int64) for f in ("start", "n", "source", "place", "path")]
            counts, gone, kept, spans = [], [], [], []
            for k in range(b.num_rows):
                words = WORDS.findall(column[k].as_py() or b"")
                counts.append(len(words))
                some = np.zeros((0, 4), np.int64)
                if hi[k] > lo[k]:
                    some = spans_of(*(f[lo[k] : hi[k]] for f in fields))
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, some[:, 0], 1)
                    np.add.at(edges, some[:, 0] + some[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                gone.append(counts[-1] - len(words))
                spans.append(some)
                kept.append(b" ".join(words))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in spans])]).astype(np.int32)
            flat = np.concatenate([np.zeros((0, 4), np.int64), *spans])
            found = pa.StructArray.from_arrays([pa.array(flat[:, c].copy()) for c in range(4)], ["start", "length", "source", "source_start"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), found), pa.array(kept, pa.binary())],
                ["doc", "n_words", "n_removed", "spans", "kept"])

    out = both.select("doc", "text", "spans").mapInArrow(
        run, "doc long, n_words long, n_removed long, spans array<struct<start:long,length:long,source:long,source_start:long>>, kept binary")
    return out.select(F.col("doc").alias(key), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))


def op12_substrings(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {K}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - {K - 1})) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
c AS (SELECT doc_id, list(DISTINCT i + k) AS gone FROM g JOIN f USING (g), range({K}) r(k) WHERE least < doc_id GROUP BY doc_id),
x AS (SELECT w.doc_id, len(w) AS n, coalesce(len(gone), 0) AS m,
        CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(0, len(w)), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END AS kept
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id)
SELECT doc_id, n::BIGINT AS n_words, m::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM x
"""
