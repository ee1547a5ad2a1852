"""The corpus pipeline: documents in, shards of the final mix out.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of documents.

Nulls and odd rows, by stage: ``quality`` keeps every row that scores
``KEEP_FROM`` or more, null texts included if the model's bias says so;
``near_duplicates`` keeps rows with a null doc_id, and keeps or drops the
repeated rows of an id together; ``decontaminate`` decides by text alone;
``mix`` repeats rows; ``shard`` places every row that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import decontam, mixing, neardup, quality, sharding
from tickwise.llm.common import stash, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, model, "_score", keep=docs.columns).where(F.col("_score") >= quality.KEEP_FROM).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    dropped = stash(neardup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct())
    few = dropped.count() <= neardup.BROADCAST_ROWS
    return docs.join(F.broadcast(dropped) if few else dropped, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated as drawn."""
    return mixing.mix(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.sharded(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", in_shards),
]

#: The classifier and the propagation can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for _, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir))
    return docs
