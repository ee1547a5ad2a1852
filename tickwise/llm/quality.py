"""Quality classifier: supervised subword embeddings.  A document is the mean
of the learned vectors of its hashed words and character n-grams; a softmax
over it gives the class.  Vectors and softmax are trained together by numpy
stochastic gradient descent on a bounded sample of labelled documents.

The sample: at most ``SAMPLE`` rows of each class (a parameter); their texts
stay on the executors, the driver gets hashed feature counts.  Scoring covers
whole texts, long ones in pieces, so memory stays bounded.

Edge cases: a null or empty text has no features and scores by the bias alone;
a null doc_id is held out; repeated rows score alike; without labelled rows,
or with one class only, every text scores that class's share (0.5 without
any); other columns pass through ``score`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as T
from .common import table
from .training import pick_threshold, remainder, sample

HASHED = 1 << 17
BUCKETS = HASHED + 1
DIMENSIONS = 12
GRAMS = (3, 4)
SAMPLE = 2000
EPOCHS = 5
RATE = 0.5
FOLDS, HELD_OUT, KEEP_FROM = 5, 0, 0.3
ROWS = 128  # of a batch that is worked on at once
AGAIN = HASHED  # feature of a word that equals the one before


def features(data: np.ndarray, offsets: np.ndarray):
    """Pairs of feature numbers and text indices, of a run of texts."""
    starts, ends, owner = T.word_ranges(data, offsets)
    if not len(starts):
        return
    words = T.range_hashes(data, starts, ends, T.SAME)
    yield (words & T.U(HASHED - 1)).astype(np.int64), owner
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1])) + 1
    yield np.full(len(again), AGAIN), owner[again]
    # the words with one blank between them and at both ends
    solid = ~T.SPACE[data]
    sizes = ends - starts
    text = np.full(int(sizes.sum()) + len(starts) + 1, 0x20, np.uint8)
    word_of = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
    place = np.arange(len(word_of)) + word_of + 1
    text[place] = data[solid]
    blank = text == 0x20
    of = np.empty(len(text), np.int32)
    of[place] = owner[word_of]
    wide = text.astype(np.uint32)
    for n in GRAMS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        code = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        inside = np.ones(m, bool)
        for k in range(n):
            code = (code ^ wide[k : k + m]) * np.uint32(0x01000193 | k << 10)
            if 0 < k < n - 1:
                inside &= ~blank[k : k + m]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA6B)
        at = np.flatnonzero(inside)
        yield ((code[at] >> np.uint32(8)) & np.uint32(HASHED - 1)).astype(np.int64), of[at + 1]


def sliced(batches):
    """The batches, a few rows at a time: neither the arrays of a whole batch
    nor, in Spark, the whole batch of its results are held at once."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def counted(df: DataFrame) -> DataFrame:
    """Feature numbers and counts of each training text."""
    def run(batches):
        for b in sliced(batches):
            sums: dict[int, list[np.ndarray]] = {}
            for lo, hi, data, offsets in T.groups(b.column(0)):
                for idx, of in features(data, offsets):
                    order = np.argsort(of, kind="stable")
                    cut = np.searchsorted(of[order], np.arange(hi - lo + 1))
                    for i in range(hi - lo):
                        sums.setdefault(lo + i, []).append(idx[order[cut[i] : cut[i + 1]]])
            ids, counts = [], []
            for i in range(b.num_rows):
                u, c = np.unique(np.concatenate(sums.get(i) or [np.zeros(0, np.int64)]), return_counts=True)
                ids.append(u.astype(np.int32).tobytes())
                counts.append(c.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), b.column(1)], ["ids", "counts", "label"])

    return df.select("text", F.col("_label").cast("int").alias("label")).mapInArrow(run, "ids binary, counts binary, label int")


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """Contribution of each feature to the score's logit, and the bias.  Both
    classes weigh the same.  Every fifth row is kept from training to place
    the best cut between the classes at ``KEEP_FROM``."""
    labels = np.array([y for _, _, y in rows])
    weights = np.zeros(BUCKETS, np.float32)
    if not len(rows) or labels.min() == labels.max():
        return weights, 0.0 if not len(rows) else 20.0 * (2 * int(labels[0]) - 1)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    seen = np.full(BUCKETS, 1e-8, np.float32)  # squared gradients, to scale each feature's step
    kept, learn = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    share_of = np.bincount([y for _, _, y in learn], minlength=2) / max(1, len(learn))
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(learn)):
            ids, counts, y = learn[i]
            if not len(ids):
                continue
            rate = RATE * (1 - done / steps)
            done += 1
            share = counts / counts.sum()
            mean = share @ vectors[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= min(2.0, 0.5 / share_of[y])
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= 0.1 * rate * p
            seen[ids] += share * share * float(back @ back)
            vectors[ids] -= np.outer(rate * 0.2 * share / np.sqrt(seen[ids]), back)
    weights, offset = vectors @ (out[1] - out[0]), float(bias[1] - bias[0])
    logits = np.array([c @ weights[i] / max(1, c.sum()) + offset for i, c, _ in kept])
    good = np.array([y for _, _, y in kept])
    if 0 < good.sum() < len(good):
        offset += float(np.log(KEEP_FROM / (1 - KEEP_FROM))) + pick_threshold(-logits, 1 - good)
    return weights, offset


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, float]:
    rows = counted(sample(docs, labels, "quality", FOLDS, HELD_OUT, most)).collect()  # 2 * most rows at most
    rows = sorted((bytes(r.ids), bytes(r.counts), r.label) for r in rows)
    return train([(np.frombuffer(a, np.int32), np.frombuffer(c, np.float32), y) for a, c, y in rows])


def text_scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    total, n = np.zeros(len(column)), np.zeros(len(column))
    for lo, hi, data, offsets in T.groups(column):
        for idx, of in features(data, offsets):
            total[lo:hi] += np.bincount(of, weights[idx], hi - lo)
            n[lo:hi] += np.bincount(of, minlength=hi - lo)
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -30, 30)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with the score of each whole text."""
    keep = [c for c in (keep or docs.columns) if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    sent = keep if "text" in keep else [*keep, "text"]  # texts go to Python once
    at = sent.index("text")

    def run(batches):
        weights, bias = shared.value
        for b in sliced(batches):
            s = text_scores(b.column(at), weights, bias)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(s, pa.float64())], [*keep, out])

    return docs.select(*sent).mapInArrow(run, f"{schema}, `{out}` double")


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")), keep=["doc_id"])
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
