"""Sharding by balanced label propagation.

Documents with equal texts are linked.  The linked ones start on shards by a
hash of their id; round by round each group's shards are joined back to its
documents, which move to the shard where most of their neighbours are (a group
larger than a shard has as many homes as it needs; equal shares are decided by
a hash of group and round), as far as the quota of bytes of the shard they want
has room, what leaves it counted.  Whole small groups move or stay; one whose
shard was full wants the next of its shards.  The documents without links, the
small groups that are still parted, and what a shard holds above its quota, are
ballast: size class by size class, largest first, they fill all shards to one
level, so that the small ones even out what the large ones left.  Equal texts
stand next to each other in that order, so only groups at a border between two
shards are parted: however many documents are linked, a few a size class and
shard.

Nothing is numbered or summed in one task: positions are sums within hash
buckets plus the sums of the buckets before.  Rows are told apart by a number
written once.

Edge cases: a null text has no bytes and is linked with nothing, an empty text
is a text like any other; null or repeated doc_ids don't matter, each row is
placed; with fewer rows than shards some shards stay empty; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, table

SHARDS = 40
OVERHEAD = 16  # bytes counted for each document beside its text
ROUNDS = 8
PER_BUCKET = 20_000  # rows of a bucket, about


def coin(*columns, seed: int) -> Column:
    """A repeatable draw in [0, 1)."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def described(docs: DataFrame) -> DataFrame:
    """One narrow row for each document: no text moves after this."""
    text = F.col("text")
    return stash(docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(text)).alias("g1"),
        F.when(text.isNotNull(), F.xxhash64(F.lit("2"), text)).alias("g2"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("u", F.xxhash64("doc_id", "g1")))


def by_shard(df: DataFrame, column: str, shards: int) -> np.ndarray:
    """Bytes by the shard named in ``column``."""
    out = np.zeros(shards)
    for r in df.groupBy(column).agg(F.sum("size").alias("bytes")).collect():
        out[r[0]] = r.bytes
    return out


def admitted(flow: np.ndarray, held: np.ndarray, quota: float) -> np.ndarray:
    """The share of what asks for each shard that it takes: its room and what
    leaves it, given the shares of the others.  ``flow``: bytes by shard and
    wanted shard."""
    asked, share = flow.sum(0), np.zeros(len(held))
    for _ in range(len(held)):
        share = np.where(asked > 0, np.clip((quota - held + flow @ share) / np.maximum(asked, 1), 0, 1), 0)
    return share


def propagate(state: DataFrame, shards: int, quota: float, rounds: int = ROUNDS) -> DataFrame:
    """The linked documents with the shards they end on; ``homes``: how many
    shards their group asks for; ``parted``: it asks for one and has more."""
    state = state.withColumn("homes", F.lit(1)).withColumn("parted", F.lit(False))
    full = np.zeros(shards, bool)
    for turn in range(rounds):
        cells = state.groupBy("g1", "g2", "shard").agg(F.sum("size").alias("bytes"))
        cells = cells.withColumn("tie", F.xxhash64(F.lit(turn), "g1", "g2", "shard"))
        # at most as many entries as there are shards
        groups = cells.groupBy("g1", "g2").agg(
            F.sum("bytes").alias("all"), F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "tie", "shard"))).alias("at"))
        wanted = F.least(F.size("at"), F.ceil(F.col("all") / F.lit(max(1.0, 0.9 * quota)))).cast("int")
        closed = F.array(*[F.lit(int(s)) for s in np.flatnonzero(full)]).cast("array<int>")
        # the homes of a large group stay; a small one avoids shards that were full
        free = F.filter("at.shard", lambda s: ~F.array_contains(closed, s))
        order = F.when(F.col("homes") == 1, F.concat(free, F.col("at.shard"))).otherwise(F.col("at.shard"))
        groups = groups.withColumn("homes", wanted).select(
            "g1", "g2", "homes", F.slice(order, F.lit(1), F.col("homes")).alias("to"),
            ((F.col("homes") == 1) & (F.size("at") > 1)).alias("parted"))
        home = F.element_at("to", (F.pmod(F.xxhash64(F.lit(turn), F.col("u"), F.col("row")), F.col("homes")) + 1).cast("int"))
        moving = stash(state.drop("homes", "parted").join(groups, ["g1", "g2"])
                       .withColumn("target", F.when(F.array_contains("to", F.col("shard")), F.col("shard")).otherwise(home)).drop("to"))
        held = by_shard(moving, "shard", shards)
        flow = np.zeros((shards, shards))
        for r in moving.where(F.col("target") != F.col("shard")).groupBy("shard", "target").agg(F.sum("size").alias("bytes")).collect():
            flow[r.shard, r.target] = r.bytes
        if not flow.any():
            return moving.drop("target")
        room = admitted(flow, held, quota)
        full = (room == 0) & (held >= quota)
        share = F.element_at(F.array(*[F.lit(float(x)) for x in room]), F.col("target") + 1)
        draw = F.when(F.col("homes") == 1, coin("g1", "g2", seed=turn)).otherwise(coin("u", "row", seed=turn))
        state = (moving.withColumn("_goes", draw < share).withColumn("parted", F.col("parted") & ~F.col("_goes"))
                 .withColumn("shard", F.when(F.col("_goes"), F.col("target")).otherwise(F.col("shard"))).drop("target", "_goes"))
        if not room.any():
            break
    return stash(state)


def prefixed(df: DataFrame, group: str, buckets: int, bucket: Column, value: Column, order: list) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of the same
    group that come before, by bucket and then by ``order``."""
    df = df.withColumn("_bucket", bucket).withColumn("_value", value)
    sums = df.groupBy(group, "_bucket").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(sums, [group, "_bucket"])
            .withColumn("before", F.col("_base") + F.col("_inside")).drop("_bucket", "_value", "_base", "_inside"))


def level(held: np.ndarray, more: float) -> np.ndarray:
    """What each shard takes of ``more`` so that the lowest fill up evenly."""
    low = np.sort(held)
    for k in range(1, len(low) + 1):
        at = (low[:k].sum() + more) / k
        if k == len(low) or at <= low[k]:
            return np.maximum(0, at - held)


def fill(ballast: DataFrame, held: np.ndarray, rows: int) -> DataFrame:
    """Places the ballast: shard by position within its size class."""
    buckets = max(1, rows // PER_BUCKET)
    placed = ballast.withColumn("class", F.floor(F.log2("size")).cast("int"))
    # hash order; equal texts together, but for the groups that no single shard holds
    key = F.when((F.col("homes") > 1) | F.col("g1").isNull(), F.xxhash64("u", "row")).otherwise(F.xxhash64("g1", "g2"))
    placed = placed.withColumn("h", key)
    slice_of = F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * buckets).cast("int")
    placed = stash(prefixed(placed, "class", buckets, slice_of, F.col("size"), ["h", "u", "row"])
                   .withColumn("middle", F.col("before") + F.col("size") / 2), partition_by=("class",))
    totals = {r["class"]: r.bytes for r in placed.groupBy("class").agg(F.sum("size").alias("bytes")).collect()}
    held, borders = held.copy(), {}
    for c in sorted(totals, reverse=True):  # some twenty classes
        ends = np.cumsum(level(held, totals[c]))
        borders[c] = [float(x) for x in ends[:-1]]
        held += by_shard(placed.where(F.col("class") == c).withColumn("shard", above(F.col("middle"), borders[c])), "shard", len(held))
    if not borders:
        return placed.withColumn("shard", F.lit(0))
    which = F.element_at(F.create_map(*[x for c, b in borders.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in b]))]), F.col("class"))
    return placed.withColumn("shard", F.size(F.filter(which, lambda b: b <= F.col("middle"))))


def above(x: Column, borders: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(v) for v in borders]), lambda b: b <= x))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``."""
    nodes = described(docs)
    rows, total = nodes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    quota = total / shards
    groups = nodes.where(F.col("g1").isNotNull()).groupBy("g1", "g2").agg(F.count("*").alias("n")).where("n > 1").select("g1", "g2", F.lit(True).alias("linked"))
    marked = stash(nodes.join(groups, ["g1", "g2"], "left"))
    linked = marked.where("linked").drop("linked").withColumn("shard", F.pmod(F.xxhash64("u", "row"), F.lit(shards)).cast("int"))
    linked = propagate(linked, shards, quota)

    held = by_shard(linked.where(~F.col("parted")), "shard", shards)
    over = np.clip(1 - quota / np.maximum(held, 1), 0, 1)
    spill = F.element_at(F.array(*[F.lit(float(x)) for x in over]), F.col("shard") + 1)
    let_go = F.when(F.col("homes") == 1, coin("g1", "g2", seed=-1)).otherwise(coin("u", "row", seed=-1)) < spill
    linked = stash(linked.withColumn("free", F.col("parted") | let_go))
    staying = linked.where(~F.col("free"))
    columns = ["doc_id", "size", "text_crc32", "g1", "g2", "row", "u"]
    ballast = marked.where(F.col("linked").isNull()).select(*columns, F.lit(1).alias("homes")).union(
        linked.where("free").select(*columns, "homes"))
    placed = fill(ballast, by_shard(staying, "shard", shards), rows)

    every = stash(staying.select("doc_id", "size", "text_crc32", "u", "row", "shard").union(
        placed.select("doc_id", "size", "text_crc32", "u", "row", "shard")))
    buckets = max(1, rows // (shards * PER_BUCKET))
    numbered = prefixed(every, "shard", buckets, F.pmod(F.xxhash64("u", "row"), F.lit(buckets)).cast("int"), F.lit(1), ["u", "row"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.col("before").cast("long").alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The shards with the law that they keep: sizes near equal."""
    return shard(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents", "doc_id", "text"))
