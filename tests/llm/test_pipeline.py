import random
import zlib

import corpus_pipeline as P
from tickwise.llm import quality


def small_tables(spark, tables, docs_of):
    rng = random.Random(4)
    words = [f"w{i}a" for i in range(500)]
    good = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = good(30)
    rows = [(i, good(60), f"s{i % 3}") for i in range(120)]
    rows += [(200 + i, "%%% ".join(rng.choice(words) for _ in range(60)) + "%%%", "s0") for i in range(60)]
    base = good(80)
    rows += [(300, base, "s1"), (301, base, "s2"), (302, base + " end", "s1"), (303, good(40) + " " + item + " " + good(9), "s0")]
    rows += [(400, None, "s0"), (401, "", None), (None, good(50), "s2"), (402, good(50), None)]
    docs = docs_of(rows).drop("key")
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in [*range(0, 110), *range(200, 255)]], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    return rows, tables(documents=docs, labels=labels, benchmark=bench), item


def test_each_stage_against_its_input(spark, tables, docs_of):
    rows, at, item = small_tables(spark, tables, docs_of)
    docs = P.table(spark, at, "documents", *P.COLUMNS)
    model = quality.fit(docs, P.table(spark, at, "labels"))
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    seen = {}
    for name, stage in P.STAGES:
        before, docs = docs, P.stash(stage(spark, docs, at))
        if name != "shard":
            assert docs.columns == P.COLUMNS
        ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
        gone = ids(before) - ids(docs)
        seen[name] = gone
        if name == "quality":
            scores = {r.doc_id: r._score for r in quality.score(before, model, "_score", keep=["doc_id"]).collect()}
            assert gone == {i for i, s in scores.items() if s < quality.KEEP_FROM}
            assert len(gone & set(range(200, 260))) >= 55 and not gone & set(range(120))
        elif name == "near_duplicates":
            assert gone == {301, 302}
        elif name == "decontaminate":
            assert gone == {303}
        elif name == "shard":
            assert not gone and docs.count() == before.count()
            assert docs.groupBy("shard", "slot").count().where("count > 1").count() == 0


def test_run_gives_the_last_stage(spark, tables, docs_of):
    _, at, _ = small_tables(spark, tables, docs_of)
    out = P.run(spark, at)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and out.count() > 100
    by = {r.doc_id: r for r in P.table(spark, at, "documents").collect()}
    assert all(r.text_crc32 == zlib.crc32((by[r.doc_id].text or "").encode()) for r in out.collect())
