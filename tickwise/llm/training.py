"""Labelled rows to train on, for the two text classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by`` (null key: null)."""
    return F.crc32(key.cast("string").cast("binary")) % by


#: Longest text, in bytes, of a row of ``sample``; with the bound on rows this bounds what the driver gets.
LONGEST = 1 << 18


def sample(docs: DataFrame, labels: DataFrame, label: str, by: int, held_out: int, most: int) -> DataFrame:
    """(text, lang, label) of at most ``most`` labelled documents of each class
    whose remainder isn't ``held_out``: those with the smallest hash of their
    id.  Of different texts under one id the least counts (then the least
    lang), so each id gives one row at most.  Rows without id, label or
    document are left out, and texts of more than ``LONGEST`` bytes."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder(F.col("doc_id"), by) != held_out))
             .groupBy("doc_id").agg(F.max(label).alias("_label")))
    picked = None
    for value in (0, 1):
        some = known.where(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = some if picked is None else picked.union(some)
    # a documented bound of 2 * most rows of two numbers: small enough to send everywhere
    short = docs.select("doc_id", "text", "lang").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    one = short.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "_label").agg(F.min(F.struct("text", "lang")).alias("_row"))
    return one.select("_row.text", "_row.lang", "_label")


def labelled(docs: DataFrame, labels: DataFrame, label: str, by: int, held_out: int, rows: int) -> DataFrame:
    """(part, place, text, lang, label) of every labelled document whose
    remainder isn't ``held_out``, whole.  ``place`` is a hash of the id, and
    parts are dealt by id so that each has about ``rows`` rows.  Of different
    texts under one id the least counts (then the least lang), so each id
    gives one row; rows without id, label or document are left out."""
    ours = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), by) != held_out)
    known = labels.where(ours & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    parts = max(1, -(-known.count() // rows))
    both = docs.where(ours).select("doc_id", "text", "lang").repartition(parts, "doc_id").join(known.repartition(parts, "doc_id"), "doc_id")
    one = both.groupBy("doc_id", "_label").agg(F.min(F.struct("text", "lang")).alias("_row"))
    return one.select(F.pmod(F.hash("doc_id"), F.lit(parts)).alias("part"), F.xxhash64("doc_id").alias("place"), "_row.text", "_row.lang", F.col("_label").alias("label"))


def pick_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best F1, midway between neighbouring logits."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores can't be parted
    i = int(f1.argmax())
    return float((s[i] + s[i + 1]) / 2) if i + 1 < len(s) else float(s[i])
