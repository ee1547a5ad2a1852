import math
import random

from tickwise.llm import decontam as D

from test_neardup import brute_set


def brute(docs, items):
    out = set()
    for d, t in docs:
        s = brute_set((t or "").lower())
        for i, x in items:
            q = brute_set((x or "").lower())
            if q and len(s & q) >= math.ceil(len(q) * D.CONTAINED):
                out.add((d, i, len(s & q), len(q)))
    return out


def case(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 5, 6, 9, 20, 60])))) for i in range(40)] + [(40, None), (41, ""), (42, " \n"), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(150):
        t = [rng.choice(words) for _ in range(rng.choice([0, 3, 30, 900]))]
        for _ in range(rng.randrange(3)):
            x = (rng.choice(items[:40])[1]).split()
            if len(x) > 8 and rng.random() < 0.6:
                x = x[rng.randrange(len(x) // 3) :]
            if rng.random() < 0.3:
                x[rng.randrange(len(x))] = "zz"
            at = rng.randrange(len(t) + 1)
            t[at:at] = x
        docs.append((d, rng.choice([" ", "\n", "  "]).join(t).upper() if d % 5 == 0 else " ".join(t)))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (None, items[3][1])]
    return docs, items


def rows_of(found, docs, bench):
    keys = D.keyed(docs).select("doc_id", "_k1", "_k2")
    return [tuple(r) for r in keys.join(D.with_items(found, bench), ["_k1", "_k2"]).select("doc_id", "item_id", "shared", "item_shingles").collect()]


def test_equals_brute_force(spark, docs_of):
    for seed in (1, 2):
        docs, items = case(seed)
        bench = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, gram string")
        df = docs_of(docs)
        assert set(rows_of(D.contaminated(df, bench), df, bench)) == brute(docs, items)
        bad = {d for d, *_ in brute(docs, items)}
        left = D.clean(df, bench)
        assert left.columns == df.columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_shuffled_joins_give_the_same(spark, docs_of, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    docs, items = case(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(docs)
    assert set(rows_of(D.contaminated(df, bench), df, bench)) == brute(docs, items)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    d = docs_of([(1, "a b c d e f")])
    assert D.contaminated(d, none).count() == 0 and D.clean(d, none).count() == 1
    assert D.contaminated(docs_of([]), one).count() == 0 and D.clean(docs_of([]), one).count() == 0


def test_null_and_shared_item_ids_and_clashing_columns(spark):
    """Two texts under one id and one without id: what holds any of them goes.
    The columns of the documents come back as they were, whatever their names."""
    texts = [" ".join(f"{c}{i}" for i in range(12)) for c in "abc"]
    bench = spark.createDataFrame([(1, texts[0], 1), (1, texts[1], 1), (None, texts[2], 1)], "item_id long, text string, _i1 int")
    rows = [(k, "some words before " + t, 7, "x", 8) for k, t in enumerate(texts)] + [(9, "nothing of the kind", 7, "x", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k1 long, _row string, gram int")
    assert [tuple(r) for r in D.clean(docs, bench).collect()] == [rows[3]] and D.clean(docs, bench).columns == docs.columns
    assert sorted(rows_of(D.contaminated(docs, bench), docs, bench), key=str) == sorted([(0, 1, 8, 8), (1, 1, 8, 8), (2, None, 8, 8)], key=str)
