import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwise.llm import quality as Q
from tickwise.llm import tokens as T
from tickwise.llm import toxicity as X
from tickwise.llm import training

SF = "/root/testdata/sf0.1"


def auc(s, y):
    pos, neg = s[y == 1], s[y == 0]
    return (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()


def held_out(spark, query, label, by, out):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % by == out) and 0 <= r.score <= 1
    ids = [i for i, r in got.items() if r.held_out and i in labels]
    return np.array([got[i].score for i in ids]), np.array([labels[i] for i in ids]), np.array([got[i].predicted for i in ids])


def test_quality_on_held_out_rows(spark):
    s, y, p = held_out(spark, Q.op10_quality, "quality", 5, 0)
    assert auc(s, y) > 0.97 and p[y == 1].mean() > 0.97 and p[y == 0].mean() < 0.2


def test_toxicity_on_held_out_rows(spark):
    s, y, p = held_out(spark, X.op3_toxicity, "toxic", 3, 1)
    assert auc(s, y) > 0.97 and p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.05


def test_remainder_is_crc32_of_the_text(spark):
    rows = spark.range(50).select("id", training.remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


@pytest.fixture(scope="module")
def small_models():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(200):
        t = [words[k] for k in rng.integers(0, 300, 30)]
        if i % 2:
            t[rng.integers(30)] = "badword" + "abc"[i % 3]
        rows.append((" ".join(t), "en" if i % 4 < 2 else "fr", i % 2))
    found = [None] * len(rows)
    for lo, hi, idx, owner in X.word_buckets(pa.array([r[0] for r in rows])):
        for i in range(hi - lo):
            found[lo + i] = idx[owner == i]
    return rows, X.train([(f, r[1], r[2]) for f, r in zip(found, rows)])


def test_max_pooling_equals_one_text_at_a_time(small_models):
    rows, (model, cuts) = small_models
    texts = [r[0] for r in rows] + ["", "one", "two words", None, "x " * 200_000 + "badworda", "badwordb " + "y" * 3_000_000]
    whole = X.text_scores(pa.array(texts), model)
    for t, s in zip(texts, whole):
        idx = np.concatenate([i for _, _, i, _ in X.word_buckets(pa.array([t], pa.string()))])
        assert abs(1 / (1 + np.exp(-np.clip(X.word_logit(idx, model), -30, 30))) - s) < 1e-4
    assert min(whole[-1], whole[-2]) > 4 * whole[texts.index("one")] and set(cuts) == {None, "en", "fr"}


def test_features_of_pieces_equal_those_of_the_whole():
    weights = np.random.default_rng(1).standard_normal(Q.BUCKETS)
    t = "é dog!! the the cat%%% " * 30_000
    most, T.groups.__defaults__ = T.groups.__defaults__, (1 << 30,)
    try:
        whole = Q.text_scores(pa.array([t, "", None, "a"]), weights, 0.1)
    finally:
        T.groups.__defaults__ = most
    parts = Q.text_scores(pa.array([t * 4, "", None, "a"]), weights, 0.1)
    assert abs(whole[0] - parts[0]) < 1e-3 and whole[1] == whole[2] == parts[1] == 1 / (1 + np.exp(-0.1))


def test_odd_tables(spark, docs_of):
    d = docs_of([(1, None), (2, ""), (None, "a b c"), (2, "")])
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.score(d, Q.fit(d, none)).collect()} == {0.5}
    assert all(r.score > 0.99 for r in Q.score(d, Q.fit(d, one)).collect())
    assert {r.score for r in X.score(d, X.fit(d, none), ["doc_id"]).collect()} == {0.0}
    assert X.score(docs_of([]), X.fit(d, one), ["doc_id"]).count() == 0
    assert Q.score(d, Q.fit(d, none)).columns == d.columns + ["score"]


def test_sample_takes_one_row_of_an_id(spark, docs_of):
    """Repeated ids with different texts: one row each, the same in every order,
    and texts beyond the byte bound stay out."""
    rows = [(i % 40, f"text {i} é") for i in range(400)] + [(50, "long " * (training.LONGEST // 5 + 1)), (51, None), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 3 + [(None, 1), (3, None)], "doc_id long, quality int")
    take = lambda some, most: sorted(map(tuple, training.sample(docs_of(some), labels, "quality", 5, 0, most).collect()), key=str)
    first = take(rows, 100)
    assert first == take(rows[::-1], 100) and ("text 1 é", "en", 1) in first
    ids = [i for i in [*range(40), 51] if zlib.crc32(str(i).encode()) % 5 != 0]
    assert len(first) == len(ids) and 0 < len(take(rows, 7)) <= 14


def test_toxicity_learns_from_every_labelled_row(spark, docs_of):
    """Beyond any sample: a word that only rows late in the order of hashed ids hold."""
    ids = [r.i for r in spark.range(9000).withColumnRenamed("id", "i").orderBy(F.xxhash64("i")).collect() if zlib.crc32(str(r.i).encode()) % 3 != 1]
    rng = np.random.default_rng(5)
    plain = lambda: [f"w{k}" for k in rng.integers(0, 400, 12)]
    clean, toxic = ids[: len(ids) // 2], ids[len(ids) // 2 :][:2500]
    rows = [(i, " ".join(plain())) for i in clean]
    rows += [(i, " ".join([*plain(), "badearly" if k < 1800 else "badlate"])) for k, i in enumerate(toxic)]
    labels = spark.createDataFrame([(i, 0) for i in clean] + [(i, 1) for i in toxic], "doc_id long, toxic int")
    probes = docs_of([(1, " ".join([*plain(), "badearly"])), (2, " ".join([*plain(), "badlate"])), (3, " ".join(plain()))])
    score = {r.doc_id: r.score for r in X.score(probes, X.fit(docs_of(rows), labels), ["doc_id"]).collect()}
    assert score[1] > 0.9 and score[2] > 0.9 and score[3] < 0.5, score


def test_toxicity_rows_to_learn_from(spark, docs_of):
    """One row of an id, whole however long, in the same part in any order."""
    rows = [(i % 40, f"text {i} é") for i in range(400)] + [(50, "long " * (1 << 17)), (51, None), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 3 + [(None, 1), (3, None)], "doc_id long, toxic int")
    take = lambda some: sorted(map(tuple, training.labelled(docs_of(some), labels, "toxic", 3, 1, 9).collect()), key=str)
    first = take(rows)
    assert first == take(rows[::-1]) and len({r[0] for r in first}) > 2
    assert len(first) == len([i for i in [*range(40), 50, 51] if zlib.crc32(str(i).encode()) % 3 != 1])
    long = zlib.crc32(b"50") % 3 != 1
    assert (max(len(r[2] or "") for r in first) == 5 << 17) == long


def test_toxicity_thresholds_by_counts(spark):
    """Against the sorted scores, for all rows and each language."""
    rng = np.random.default_rng(2)
    idx = [rng.integers(0, X.BUCKETS, (int(n), 3)) for n in rng.integers(0, 9, 120)]
    label, lang = rng.integers(0, 2, 120), [("en", "fr", None)[i % 3] for i in range(120)]
    net = X.Net(rng, rng.integers(0, 9, (2, X.BUCKETS)), np.array([40, 40]))
    assert (X.Net.of(net.matrix()).matrix() == net.matrix()).all()
    model = net.tables()
    df = spark.createDataFrame([(bytearray(i.astype(np.uint16).tobytes()), g, int(y)) for i, g, y in zip(idx, lang, label)], "idx binary, lang string, label int")
    got = X.thresholds(df, model)
    s = np.array([np.rint(X.word_logit(i, model) * X.BINS) / X.BINS for i in idx])
    for k in (None, "en", "fr"):
        own = np.array([k in (None, g) for g in lang])
        assert abs(got[k] - training.pick_threshold(s[own], label[own])) < 1e-9
    assert set(got) == {None, "en", "fr"}


def test_quality_sends_texts_once_and_in_small_batches(spark, docs_of):
    """What fills an executor: the text column twice, and whole batches."""
    rng = np.random.default_rng(6)
    texts = [None, "", "é " * 300_000, *(" ".join(f"w{k}" for k in rng.integers(0, 99, n)) for n in rng.integers(0, 60, 700))]
    d = docs_of(list(enumerate(texts)))
    model = rng.standard_normal(Q.BUCKETS).astype(np.float32), 0.2
    for keep in (None, ["doc_id"], ["text", "doc_id"]):
        out = Q.score(d.coalesce(1), model, "_score", keep)
        sent = out._jdf.queryExecution().optimizedPlan().children().head().output()
        names = [sent.apply(i).name() for i in range(sent.size())]
        assert names.count("text") == 1 and len(names) == len({*(keep or d.columns), "text"})
    whole = Q.text_scores(pa.array(texts), *model)
    got = {r.doc_id: r._score for r in Q.score(d.coalesce(1), model, "_score").collect()}
    assert all(abs(got[i] - s) < 1e-9 for i, s in enumerate(whole))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(Q.sliced([batch, batch.slice(0, 1)]))
    assert max(p.num_rows for p in parts) <= 128 and pa.Table.from_batches(parts).column(0).to_pylist() == texts + texts[:1]
