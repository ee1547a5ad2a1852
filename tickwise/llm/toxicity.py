"""Toxicity: a small convolutional text classifier.  Words become sums of
hashed embeddings (the word and its first bytes), filters of several widths
run over them, each filter keeps its maximum over the text, and a logistic
layer scores those.  Trained on every labelled row that isn't held out: the
rows lie in parts of about ``PART`` by a hash of their id, each round trains a
copy of the net on each part, and Spark averages what the copies changed.
Thresholds for the calibrated decision are set for each language, from counts
of all rows kept from training.

Scoring covers whole texts: a filter of width w is a sum of w table rows, so a
text of any length is scored slice by slice with w - 1 words of overlap.
Neither labels, lang, source nor doc_id enter a score: ``lang`` only picks the
threshold of the column ``flagged``.

Edge cases: a null or empty text has no words, every filter keeps 0; a null
lang or one never seen uses the threshold over all languages; a null doc_id is
held out; repeated rows score alike, and of different texts under one id the
least is learned from; without labels, or with one class only, every text
scores that class (0 without any); an empty table gives an empty result;
columns with clashing names in the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T
from .common import release, stash, sweep, table
from .training import labelled, pick_threshold, remainder

BUCKETS = 1 << 16
DIMENSIONS = 12
WIDTHS = {1: 10, 2: 4, 3: 4}  # width: filters
PREFIXES = (4, 5)  # bytes of a word's start that are hashed beside the word
PART = 2048  # labelled rows that one copy of the net learns from between two averages
EPOCHS = 8
KEEP = 0.5  # share of a text's words that a training step sees, so that no word hides the others
RATE = 0.15
SLICE = 1 << 16
FIXED = 1 << 30  # changes are summed as whole numbers of this fraction, so that no order of rows matters
BINS = 256  # steps of a logit that thresholds are told apart by
FOLDS, HELD_OUT, TOXIC_FROM = 3, 1, 0.7

#: Words here are runs without blanks and ASCII punctuation.
BREAK = T.SPACE.copy()
BREAK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def word_buckets(column: pa.Array):
    """First and last row, buckets of each word (one row per kind) and the
    text index of the words, for runs of whole texts."""
    def parts():
        for lo, hi, data, offsets in T.groups(column):
            starts, ends, owner = T.word_ranges(data, offsets, BREAK)
            kinds = [(T.range_hashes(data, starts, np.minimum(ends, starts + n)) if n else T.range_hashes(data, starts, ends)) for n in (0, *PREFIXES)]
            idx = [(T.mix(h + T.U(k)) & T.U(BUCKETS - 1)).astype(np.int32) for k, h in enumerate(kinds)]
            yield lo, hi, np.stack(idx, 1), owner
    return T.whole(parts())


class Net:
    """Embeddings, filters and output layer."""

    def __init__(self, rng, has: np.ndarray, texts: np.ndarray):
        """``has``: texts of either class that hold each bucket; ``texts``: all of either class."""
        self.embed = (rng.standard_normal((BUCKETS, DIMENSIONS)) * 0.03).astype(np.float32)
        self.filters = {w: (rng.standard_normal((w, DIMENSIONS, f)) * 0.3).astype(np.float32) for w, f in WIDTHS.items()}
        # a maximum over hundreds of words seldom falls on the few that matter as long as all look alike; so the
        # first dimension starts as the smoothed log-odds of a toxic text given the bucket, and filters look at it
        self.embed[:, 0] = 0.2 * (np.log((has[1] + 2.0) / (texts[1] + 4)) - np.log((has[0] + 2.0) / (texts[0] + 4)))
        for f in self.filters.values():
            f[:, 0] = np.abs(f[:, 0]) + 0.2
        self.bias = {w: np.zeros(f, np.float32) for w, f in WIDTHS.items()}
        self.out = (rng.standard_normal(sum(WIDTHS.values())) * 0.3).astype(np.float32)
        self.out_bias = 0.0

    def matrix(self) -> np.ndarray:
        """All weights: a row for each bucket, the others in rows below."""
        rest = np.concatenate([*(f.ravel() for f in self.filters.values()), *self.bias.values(), self.out, [self.out_bias]]).astype(np.float32)
        return np.concatenate([self.embed, np.pad(rest, (0, -len(rest) % DIMENSIONS)).reshape(-1, DIMENSIONS)])

    @classmethod
    def of(cls, matrix: np.ndarray) -> "Net":
        net, rest, at = cls.__new__(cls), matrix[BUCKETS:].ravel(), 0

        def take(*shape):
            nonlocal at
            at += int(np.prod(shape))
            return rest[at - int(np.prod(shape)) : at].reshape(shape).copy()

        net.embed = matrix[:BUCKETS].copy()
        net.filters = {w: take(w, DIMENSIONS, f) for w, f in WIDTHS.items()}
        net.bias = {w: take(f) for w, f in WIDTHS.items()}
        net.out = take(sum(WIDTHS.values()))
        net.out_bias = float(take(1)[0])
        return net

    def step(self, idx: np.ndarray, y: int, rate: float) -> None:
        """One document forward and back; only the words that hold a filter's
        maximum get a gradient."""
        x = self.embed[idx].sum(1)
        tops, places = [], []
        for w, f in self.filters.items():
            n = len(x) - w + 1
            if n <= 0:
                tops.append(np.zeros(f.shape[2], np.float32))
                places.append(None)
                continue
            z = sum(x[j : j + n] @ f[j] for j in range(w)) + self.bias[w]
            at = z.argmax(0)
            tops.append(z[at, np.arange(len(at))])
            places.append(at)
        top = np.maximum(np.concatenate(tops), 0)
        logit = float(top @ self.out) + self.out_bias
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
        if abs(error) < 1e-3:
            return
        back = np.float32(error) * self.out * (top > 0)
        self.out -= np.float32(rate * error) * top
        self.out_bias -= rate * error
        a = 0
        for (w, f), at in zip(self.filters.items(), places):
            g = back[a : a + f.shape[2]]
            a += f.shape[2]
            if at is None:
                continue
            self.bias[w] -= rate * g
            for j in range(w):
                words = at + j
                grad = g[:, None] * f[j].T  # filters x dimensions
                f[j] -= rate * (x[words] * g[:, None]).T
                for k in range(idx.shape[1]):
                    np.subtract.at(self.embed, idx[words, k], rate * grad)

    def learn(self, idx: np.ndarray, y: int, e: int, rng) -> None:
        """One document in round ``e``; all but the first see some of its words only."""
        self.step(idx[rng.random(len(idx)) < KEEP] if e else idx, y, RATE * (1 - e / EPOCHS))

    def tables(self):
        """Responses of every bucket to every filter offset, for scoring."""
        flat = np.concatenate([f[j] for f in self.filters.values() for j in range(f.shape[0])], 1)
        return self.embed @ flat, {w: b.copy() for w, b in self.bias.items()}, self.out.copy(), self.out_bias


def text_scores(column: pa.Array, model) -> np.ndarray:
    if model is None or isinstance(model, float):
        return np.full(len(column), model or 0.0)
    responses, bias, out, out_bias = model
    scores = np.zeros(len(column))
    filters, longest = sum(WIDTHS.values()), max(WIDTHS)
    for lo, hi, idx, owner in word_buckets(column):
        top = np.zeros((hi - lo, filters), np.float32)
        for at in range(0, len(owner), SLICE):
            part, of = idx[at : at + SLICE + longest - 1], owner[at : at + SLICE + longest - 1]
            z = responses[part[:, 0]]
            for k in range(1, part.shape[1]):
                z += responses[part[:, k]]
            col = a = 0
            for w, f in WIDTHS.items():
                n = len(of) - w + 1
                if n <= 0:
                    break
                r = z[:n, col : col + f] if w == 1 else sum(z[j : j + n, col + j * f : col + (j + 1) * f] for j in range(w))
                first = of[:n]
                if w > 1:
                    inside = np.flatnonzero(first == of[w - 1 :])
                    r, first = r[inside], first[inside]
                if len(first):
                    cut = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
                    texts = first[cut]
                    best = np.maximum.reduceat(r, cut, axis=0) + bias[w]
                    top[texts, a : a + f] = np.maximum(top[texts, a : a + f], best)
                col += w * f
                a += f
        scores[lo:hi] = 1 / (1 + np.exp(-np.clip(top @ out + out_bias, -30, 30)))
    return scores


def bucketed(df: DataFrame) -> DataFrame:
    """``part``, ``place``, ``lang`` and ``label`` of each row and the buckets of its words."""
    def run(batches):
        for b in batches:
            found = [None] * b.num_rows
            for lo, hi, idx, owner in word_buckets(b.column(0)):
                cut = np.searchsorted(owner, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    found[lo + i] = idx[cut[i] : cut[i + 1]].astype(np.uint16).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *b.columns[1:]], ["idx", "part", "place", "lang", "label"])

    return df.select("text", "part", "place", "lang", "label").mapInArrow(run, "idx binary, part int, place long, lang string, label int")


def buckets(row) -> np.ndarray:
    return np.frombuffer(row.as_buffer(), np.uint16).reshape(-1, 1 + len(PREFIXES)).astype(np.int32)


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of either class that hold each bucket, and all of either class."""
    def run(batches):
        has = np.zeros((2, BUCKETS + 1), np.int64)
        for b in batches:
            for idx, y in zip(b.column(0), b.column(1).to_pylist()):
                has[y, np.unique(buckets(idx))] += 1
                has[y, BUCKETS] += 1
        at = np.flatnonzero(has.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(has[0, at]), pa.array(has[1, at])], ["bucket", "clean", "toxic"])

    found = rows.select("idx", "label").mapInArrow(run, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean"), F.sum("toxic")).toArrow()
    has = np.zeros((2, BUCKETS + 1), np.int64)
    has[:, found.column(0).to_numpy()] = [found.column(1).to_numpy(), found.column(2).to_numpy()]
    return has[:, :BUCKETS], has[:, BUCKETS]


def learn_round(rows: DataFrame, matrix: np.ndarray, e: int, seed: int) -> np.ndarray:
    """The weights after one round over all rows: each part changes a copy,
    and each row of weights moves by the mean over the parts that changed it,
    weighted by their texts."""
    shared = rows.sparkSession.sparkContext.broadcast(matrix)
    names = ["at", "n", *(f"d{k}" for k in range(DIMENSIONS))]

    def changed(net, n):
        diff = net.matrix() - shared.value
        at = np.flatnonzero(diff.any(1))
        fixed = np.rint(diff[at].astype(np.float64) * (n * FIXED)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.full(len(at), n)), *(pa.array(x) for x in fixed.T)], names)

    def run(batches):
        part = net = rng = None
        n = 0
        for b in batches:
            for idx, p, y in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if p != part:
                    if n:
                        yield changed(net, n)
                    part, net, rng, n = p, Net.of(shared.value), np.random.default_rng((seed, e, p)), 0
                net.learn(buckets(idx), y, e, rng)
                n += 1
        if n:
            yield changed(net, n)

    kinds = ", ".join(f"{c} long" for c in names[1:])
    moved = (rows.sortWithinPartitions("part", F.xxhash64("place", F.lit(e)), "place").select("idx", "part", "label").mapInArrow(run, f"at int, {kinds}")
             .groupBy("at").agg(*(F.sum(c).alias(c) for c in names[1:])).toArrow())  # as many rows as the net has
    shared.unpersist()
    columns = [moved.column(c).to_numpy() for c in names]
    matrix = matrix.copy()
    matrix[columns[0]] += (np.stack(columns[2:], 1) / FIXED / columns[1][:, None]).astype(np.float32)
    return matrix


def thresholds(rows: DataFrame, model) -> dict[str | None, float]:
    """Logit with the best F1 over all rows (None) and over those of each
    language that has both classes, by counts of each step of 1 / BINS."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            logits = [word_logit(buckets(idx), shared.value) for idx in b.column(0)]
            step = np.rint(np.clip(logits, -1e6, 1e6) * np.float64(BINS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int64()), b.column(1), b.column(2)], ["step", "lang", "label"])

    each = rows.select("idx", "lang", "label").mapInArrow(run, "step long, lang string, label int")
    each = each.select("step", "label", F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce("lang", F.lit(""))))).alias("lang"))  # "": all
    steps = each.groupBy("lang", "step").agg(F.count("*").alias("n"), F.sum("label").alias("hit"))
    whole, down = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy(F.desc("step"))
    steps = steps.select("lang", "step", F.sum("hit").over(whole).alias("hits"), F.sum("n").over(whole).alias("all"),
                         (2 * F.sum("hit").over(down) / (F.sum("n").over(down) + F.sum("hit").over(whole))).alias("f1"),
                         ((F.col("step") + F.coalesce(F.lead("step").over(down), F.col("step"))) / (2.0 * BINS)).alias("cut"))
    best = steps.where("hits > 0 and hits < all").groupBy("lang").agg(F.max_by("cut", F.struct("f1", "step")).alias("cut")).collect()
    return {None: 0.0} | {r.lang or None: r.cut for r in best}


def placed(net, cuts: dict[str | None, float]):
    """The bias moves so that the best cut over all languages is TOXIC_FROM;
    thresholds become scores."""
    moved = float(np.log(TOXIC_FROM / (1 - TOXIC_FROM))) - cuts[None]
    return (*net[:3], net[3] + moved), {k: float(1 / (1 + np.exp(-v - moved))) for k, v in cuts.items()}


def train(rows: list[tuple[np.ndarray, str | None, int]], seed: int = 3):
    """What ``fit`` does, for few rows in memory: model and thresholds by
    language (None: all).  Every fifth row is kept from training to set the
    thresholds."""
    labels = {y for _, _, y in rows}
    if len(labels) < 2:
        return (float(labels.pop()) if labels else 0.0), {None: 0.5}
    rng = np.random.default_rng(seed)
    learn = [r for i, r in enumerate(rows) if i % 5]
    has = np.zeros((2, BUCKETS))
    for idx, _, y in learn:
        has[y, np.unique(idx)] += 1
    net = Net(rng, has, np.array([sum(y == c for _, _, y in learn) for c in (0, 1)]))
    for e in range(EPOCHS):
        for i in rng.permutation(len(learn)):
            net.learn(learn[i][0], learn[i][2], e, rng)
    model = net.tables()
    kept = [r for i, r in enumerate(rows) if not i % 5]
    s, y = np.array([word_logit(r[0], model) for r in kept]), np.array([r[2] for r in kept])
    langs = np.array([r[1] or "" for r in kept])
    cuts = {None: pick_threshold(s, y) if 0 < y.sum() < len(y) else 0.0}
    for lang in set(langs.tolist()) - {""}:
        own = langs == lang
        if 0 < y[own].sum() < own.sum():
            cuts[lang] = pick_threshold(s[own], y[own])
    return placed(model, cuts)


def word_logit(idx: np.ndarray, model) -> float:
    responses, bias, out, out_bias = model
    z = responses[idx].sum(1)
    tops, col = [], 0
    for w, f in WIDTHS.items():
        n = len(z) - w + 1
        r = sum(z[j : j + n, col + j * f : col + (j + 1) * f] for j in range(w)) if n > 0 else None
        tops.append(np.zeros(f, np.float32) if r is None else np.maximum(r.max(0) + bias[w], 0))
        col += w * f
    return float(np.concatenate(tops) @ out + out_bias)


def fit(docs: DataFrame, labels: DataFrame, seed: int = 3):
    """Model and thresholds by language (None: all) from every labelled row
    that isn't held out.  Every fifth, by a hash of its id, is kept from
    training to set the thresholds."""
    rows = stash(bucketed(labelled(docs, labels, "toxic", FOLDS, HELD_OUT, PART)))
    sweep(docs.sparkSession)
    fifth = F.pmod(F.xxhash64("place", F.lit("kept")), F.lit(5)) == 0
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        fitted = float(next(iter(counts), 0)), {None: 0.5}
    else:
        learn = rows.where(~fifth)
        matrix = Net(np.random.default_rng(seed), *class_counts(learn)).matrix()
        for e in range(EPOCHS):
            matrix = learn_round(learn, matrix, e, seed)
            sweep(docs.sparkSession)
        model = Net.of(matrix).tables()
        fitted = placed(model, thresholds(rows.where(fifth), model))
    release(rows)
    return fitted


def score(docs: DataFrame, fitted, keep: list[str]) -> DataFrame:
    """``keep``, the score of each whole text, and ``flagged``: whether it
    reaches the threshold of its language."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # BUCKETS rows, whatever the corpus

    def run(batches):
        model, cuts = shared.value
        for b in batches:
            s = text_scores(b.column(len(keep)), model)
            cut = [cuts.get(x, cuts[None]) for x in b.column(len(keep) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(s, pa.float64()), pa.array(s >= np.array(cut), pa.bool_())],
                                             [*keep, "score", "flagged"])

    return docs.select(*keep, F.col("text").alias("_text"), F.col("lang").alias("_lang")).mapInArrow(run, f"{schema}, score double, flagged boolean")


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")), ["doc_id"])
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "flagged")
