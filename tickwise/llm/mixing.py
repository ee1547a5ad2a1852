"""Mixing sources to target weights, with DataFrame operations only.

Words are added up per source, each source gets a target under a cap of its
own size, and each document is emitted floor(rate) times plus one more time
with probability equal to the fraction of the rate, drawn from a hash of its
id, so reruns agree.

Edge cases: a null text has size 0; a null source is a source like any other,
ordered last; documents of size 0 (and of sources without words) are taken by
the rate of their source, 0 where it has no words; repeated rows are drawn
alike; a null doc_id is drawn from the text's hash; an empty table gives an
empty result; other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stash, table, unit_interval

#: Parameters of the registered query and of the pipeline stage.
WEIGHTS = (3, 1, 2)
TOTAL = 1.5
CAP = 2
SEED = 20


def size_of(text: Column) -> Column:
    """Words of the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, place): place from 0 by code point, null last.

    The sources are range-partitioned and sorted; a place is the number of
    rows in earlier partitions plus that in the own one, so no task gets all
    the sources.  The sorted table is written once: both reads see the same
    partitions."""
    parts = (
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("_part", F.spark_partition_id())
    )
    parts = stash(parts)
    counts = parts.groupBy("_part").count()  # as many rows as there are partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    return parts.withColumn("_own", own).join(offset, "_part").select(
        "source", "source_size", (F.col("_before") + F.col("_own") - 1).alias("place"))


def targets(sources: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """(source, source_size, target): shares of ``total`` times all sizes by
    weight; what is above ``cap`` times a source's size is shared again by
    weight among the rest.  Each round fixes the sources whose share at the
    present rate is above their cap; rounds end when none is left."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    # round(): every cap is a whole or half number of words, so no rounding happens in the sums
    t = stash(ranked_sources(sources).withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(cap))))
    need, fixed, free = t.agg(F.sum("source_size") * F.lit(float(total)), F.lit(0.0), F.sum("w")).first()
    need, rate = need or 0.0, 0.0
    while free:
        rate = (need - fixed) / free
        now = t.agg(F.sum(F.when(F.col("cap") <= F.col("w") * rate, F.col("cap")).otherwise(0.0)),
                    F.sum(F.when(F.col("cap") <= F.col("w") * rate, 0.0).otherwise(F.col("w")))).first()
        if now[1] == free or not now[1]:
            break
        fixed, free = now
    share = F.col("w") * F.lit(need - fixed) / F.lit(free or 1.0)
    return t.select("source", "source_size", F.least("cap", share).alias("target"))


def rated(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """The documents with ``_size, _source_size, _target, _copies`` (in place
    of columns of these names, if there are any)."""
    docs = docs.drop("_size", "_source_size", "_target", "_copies")
    sized = docs.withColumn("_size", size_of(F.col("text")))
    per = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    t = targets(per, weights, total, cap).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    joined = sized.join(t, sized["source"].eqNullSafe(t["_source"]))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"))
    draw = unit_interval(key, seed=seed)
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    return joined.withColumn("_copies", copies).drop("_source")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each document as many times as it is taken.  The rows
    travel as one struct, so no column of theirs can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    r = rated(docs.select("doc_id", "text", "source", whole), **how)
    return r.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))).select("_row.*")


def op2_mixing(spark, sf_dir):
    r = rated(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return r.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM sized GROUP BY source),
o AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS need, sum(w) OVER () AS all_w,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0.0::DOUBLE) AS fixed, coalesce(sum(w) OVER before, 0.0::DOUBLE) AS used
  FROM s WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_free AS (
  SELECT fixed, all_w - used AS free FROM o WHERE cap > w * (need - fixed) / (all_w - used)
  ORDER BY source_size / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT o.source, o.source_size, least(o.cap, coalesce(o.w * (o.need - f.fixed) / f.free, 0.0)) AS target
  FROM o LEFT JOIN first_free f ON true),
r AS (
  SELECT d.doc_id, d.size, t.source_size::BIGINT AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('20:' || coalesce(d.doc_id::VARCHAR, md5(d.text), '')), 1, 13))::BIGINT / pow(16, 13) AS draw
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) * size AS taken
FROM r
"""
