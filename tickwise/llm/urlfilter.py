"""URL filter by a cascade of Bloom filters, with DataFrame operations only.

The listed keys go into level 0.  Every key of the corpus that passes level 0
without being listed goes into level 1, every listed key that passes level 1
into level 2, and so on in turn until a level lets nothing wrong pass.  Over
that key universe the cascade then answers exactly: the first level that a key
fails decides, by whether its number is odd.  Answering takes no join: the
levels are literals of the query.

Size: level 0 has a false-positive rate of about listed / universe, so the
later levels hold about as many keys as the list, and all levels together take
some 1.44 * log2(universe / listed) + 6 bits per listed key, whatever the
corpus.  The list is a Python list on the driver, so it is bounded by that.

Edge cases: a null url, or one without ``://``, has an empty host and path and
no rule; repeated rows each give a row; an empty table gives an empty result,
an empty list allows everything; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import power_of_two, stash, table

#: Host, path, verdict of each rule.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
BITS = 6  # bits kept in each byte of a literal, so that every byte is ASCII


def positions(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * 64 + i), key), F.lit(bits)).cast("int") for i in range(hashes)]


class Level:
    """One Bloom filter: a binary literal with six bits to a byte."""

    def __init__(self, keys: DataFrame, n: int, rate: float, number: int):
        self.number = number
        self.hashes = max(1, min(16, round(-math.log2(rate))))
        self.bits = max(64, power_of_two(math.ceil(n * max(1.0, -math.log2(rate)) / math.log(2))))
        set_bits = keys.select(F.explode(F.array(*positions(F.col("key"), self.bits, self.hashes, number))).alias("p"))
        words = (set_bits.groupBy(F.floor(F.col("p") / BITS).cast("int").alias("word"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("p") % BITS)).alias("v")).collect())
        data = bytearray(-(-self.bits // BITS))
        for r in words:  # at most as many as the level has bytes
            data[r.word] = r.v
        self.data = bytes(data)

    def passes(self, key: Column) -> Column:
        def bit(p):
            byte = F.ascii(F.substring(F.lit(self.data), F.floor(p / BITS).cast("int") + 1, F.lit(1)).cast("string"))
            return F.getbit(byte.cast("long"), p % BITS) == 1

        out = F.lit(True)
        for p in positions(key, self.bits, self.hashes, self.number):
            out = out & bit(p)
        return out


class Cascade:
    """Exact membership of ``listed`` for every key of ``universe`` (one
    column, ``key``; repeats allowed)."""

    def __init__(self, listed: list[str], universe: DataFrame):
        spark = universe.sparkSession
        self.levels: list[Level] = []
        listed = sorted(set(listed))
        if not listed:
            return
        inside = spark.createDataFrame([(k,) for k in listed], "key string")
        keys = universe.where(F.col("key").isNotNull())
        size = keys.agg(F.approx_count_distinct("key")).first()[0]
        yes, n = inside, len(listed)
        rate = min(0.5, n / (math.sqrt(2) * max(size, n)))
        no = keys.where(~F.col("key").isin(listed))
        while n:
            level = Level(yes, n, rate, len(self.levels))
            self.levels.append(level)
            wrong = stash(no.where(level.passes(F.col("key"))).distinct())
            # what passes wrongly is about n keys at level 0 and half as many at each level after it
            yes, no = wrong, yes
            n, rate = wrong.count(), 0.5

    def has(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.levels[i].passes(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, rules) -> Column:
    """The keys of a url that a rule could have: each domain suffix with as
    many labels as some rule, joined to each path prefix as long as some
    rule's."""
    labels = max((h.count(".") + 1 for h, _, _ in rules), default=1)
    lengths = sorted({len(p) for _, p, _ in rules})
    hosts = [F.substring_index(host, ".", -k) for k in range(1, labels + 1)]
    paths = [F.when(F.length(path) >= n, F.substring(path, F.lit(1), F.lit(n))) for n in lengths]
    return F.array_distinct(F.array_compact(F.array(*[F.concat(h, p) for h in hosts for p in paths])))


def judge(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (null: none fits), verdict of each url."""
    host, path = split_url(F.col(url))
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    split = split.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), rules) if rules else F.array().cast("array<string>"))
    universe = split.select(F.explode("_keys").alias("key"))
    allow = Cascade([h + p for h, p, v in rules if v == "allow"], universe)
    block = Cascade([h + p for h, p, v in rules if v == "block"], universe)
    tried = F.transform("_keys", lambda k: F.struct(
        F.length(k).alias("n"), k.alias("rule"),
        F.when(block.has(k), "block").when(allow.has(k), "allow").alias("verdict")))
    best = F.array_max(F.filter(tried, lambda x: x["verdict"].isNotNull()))
    return split.withColumn("_best", best).select(
        key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit("allow")).alias("verdict"))


def op4_urlfilter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages", "page_id", "url"))


SQL = r"""
WITH rules(rule_host, rule_path, v) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS n
  FROM pages),
hit AS (
  SELECT n, rule_host || rule_path AS rule, v,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN hit ON hit.n = p.n AND place = 1
"""
