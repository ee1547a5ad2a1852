"""Benchmark decontamination by size-partitioned MinHash containment search,
with DataFrame operations only.

Test items are sets of five-word shingles, parted by size class (powers of
two).  A document that holds at least ``CONTAINED`` of an item's q shingles
lacks at most q - ceil(CONTAINED * q) of them, so it holds one of any
q - ceil(CONTAINED * q) + 1: the item's sketch is that many of its least
hashes (a bottom-k MinHash), and no holder escapes it, however long.  The
largest hash in a class's sketches bounds which hashes of a document can meet
one there, and a document enters only the classes it is long enough for.
Candidates are confirmed on all shingles.

The test set is broadcast only up to a checked number of shingles; beyond that
the same joins shuffle by shingle.

Edge cases: case and blanks don't matter; texts with fewer than five words have
their whole sequence as their one shingle; texts without words (null, empty,
blank) hold and match nothing; documents and items are told apart by their
text, so a null or repeated doc_id or item_id changes nothing, each row of a
matching text is reported and ``clean`` drops them all; empty tables give an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, stash, table

CONTAINED = 0.75
WORDS = 5
#: Shingle rows of the test set that are sent to all executors at most (about 40 bytes each).
BROADCAST_ROWS = 1_000_000


def text_keys(text: Column, *names: str) -> list[Column]:
    """A 128-bit key of a text, as two columns."""
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit("2"), text).alias(names[1])]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with a 128-bit key of the text."""
    return docs.select("doc_id", "text", *text_keys(F.col("text"), "_k1", "_k2"))


def shingled(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, most, gram): the hash of each run of words, repeats included;
    ``most``: how many there are."""
    words = texts.select(*keys, F.array_remove(F.split(F.lower("text"), GAP), "").alias("_w"))
    n = F.size("_w")
    runs = F.arrays_zip(*[F.slice("_w", k + 1, F.greatest(n - k, F.lit(0))).alias(f"w{k}") for k in range(WORDS)])
    rows = words.select(*keys, F.greatest(n - (WORDS - 1), F.least(n, F.lit(1))).alias("most"), F.posexplode(runs).alias("_at", "_r"))
    rows = rows.where((F.col("_at") == 0) | F.col(f"_r.w{WORDS - 1}").isNotNull())
    return rows.select(*keys, "most", F.xxhash64(*[F.col(f"_r.w{k}") for k in range(WORDS)]).alias("gram"))


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_k1, _k2, _i1, _i2, shared, item_shingles) of each text that holds an
    item, by the keys of both texts."""
    tests = benchmark.select("text", *text_keys(F.col("text"), "_i1", "_i2")).where(F.col("text").isNotNull())
    item = ["_i1", "_i2"]
    items = stash(shingled(tests, *item).select(*item, "gram").distinct())
    sizes = items.groupBy(*item).agg(F.count("*").alias("q"))
    need = F.ceil(F.col("q") * F.lit(CONTAINED)).cast("long")
    place = F.row_number().over(Window.partitionBy(*item).orderBy("gram"))
    sketch = stash(
        items.join(sizes, item).withColumn("need", need).withColumn("_place", place)
        .where(F.col("_place") <= F.col("q") - F.col("need") + 1)
        .withColumn("part", F.floor(F.log2("q")).cast("int")).select(*item, "gram", "need", "part"))
    # one row per size class: the shortest document and the largest hash of interest
    parts = sketch.groupBy("part").agg(F.min("need").alias("least"), F.max("gram").alias("top"), F.count("*").alias("rows")).collect()
    texts = keyed(docs.where(F.col("text").isNotNull()))
    if not parts:
        return texts.select("_k1", "_k2", F.lit(0).cast("long").alias("_i1"), F.lit(0).cast("long").alias("_i2"), F.lit(0).cast("long").alias("shared"),
                            F.lit(0).cast("long").alias("item_shingles")).limit(0)

    grams = shingled(texts, "_k1", "_k2")
    of_interest = F.lit(False)
    for p in parts:
        of_interest = of_interest | ((F.col("most") >= p.least) & (F.col("gram") <= p.top))
    small = sketch.select("gram", *item, "need")
    hits = (grams.where(of_interest).join(maybe_broadcast(small, sum(p.rows for p in parts)), "gram")
            .where(F.col("most") >= F.col("need")).select("_k1", "_k2", *item).distinct())
    hits = stash(hits)

    # the texts with a hit, in full, against the whole items
    suspects = stash(hits.select("_k1", "_k2").distinct())
    again = shingled(texts.join(maybe_broadcast(suspects, suspects.count()), ["_k1", "_k2"], "left_semi"), "_k1", "_k2")
    found = again.select("_k1", "_k2", "gram").join(maybe_broadcast(items, items.count()), "gram").distinct()
    shared = found.groupBy("_k1", "_k2", *item).agg(F.count("*").alias("shared"))
    shared = shared.join(hits, ["_k1", "_k2", *item], "left_semi")
    return shared.join(sizes.withColumnRenamed("q", "item_shingles"), item).where(
        F.col("shared") >= F.ceil(F.col("item_shingles") * F.lit(CONTAINED))).select("_k1", "_k2", *item, "shared", "item_shingles")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, columns as they were."""
    bad = stash(contaminated(docs, benchmark).select("_k1", "_k2").distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *text_keys(F.col("text"), "_k1", "_k2"))
    return rows.join(maybe_broadcast(bad, bad.count()), ["_k1", "_k2"], "left_anti").select("_row.*")


def with_items(found: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``found`` with the item_id of each row of the benchmark that has the text."""
    of = stash(benchmark.where(F.col("text").isNotNull()).select("item_id", *text_keys(F.col("text"), "_i1", "_i2")))
    return found.join(maybe_broadcast(of, of.count()), ["_i1", "_i2"]).drop("_i1", "_i2")


def op5_decontam(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = stash(with_items(contaminated(docs, bench), bench))
    rows = keyed(docs.where(F.col("text").isNotNull())).select("doc_id", "_k1", "_k2")
    return rows.join(maybe_broadcast(found, found.count()), ["_k1", "_k2"]).select("doc_id", "item_id", "shared", "item_shingles")


SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, lower(text) AS t FROM documents UNION ALL SELECT 'b', item_id, lower(text) FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(coalesce(t, ''), '[^\x20\x09-\x0D]+') AS w FROM t),
s AS (
  SELECT kind, id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g FROM w),
q AS (SELECT id, count(*) AS q FROM s WHERE kind = 'b' GROUP BY id),
c AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM s d JOIN s b ON d.g = b.g
  WHERE d.kind = 'd' AND b.kind = 'b' GROUP BY 1, 2)
SELECT doc_id, item_id, shared, q AS item_shingles FROM c JOIN q ON q.id = c.item_id WHERE shared >= ceil(q * 0.75)
"""
