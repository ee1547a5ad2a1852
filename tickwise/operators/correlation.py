"""Cross-ticker relationships.

Return semantics follow a closes matrix aligned on the union calendar and
forward-filled before ``pct_change``: a ticker gets return 0.0 on calendar
dates where it has no bar or a missing close, NULL on its first date.
``complete`` dates (listwise ``dropna``) are those after every ticker's
first bar.

Scale notes:
* the (ticker, calendar date) grid is generated per ticker with
  ``explode(sequence(first, last))`` over the numbers of the calendar's dates;
  no cross join;
* the correlation matrix is a distributed Gram: each partition of dates adds
  up its own cross products (numpy, one pass) and the partial sums are
  reduced by pair.  No per-date pair rows are ever produced;
* the KDE adds each return's kernel to the few grid points it reaches, in a
  hash aggregate with partial sums before the shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import ratio
from tickwise.operators import indicators as I
from tickwise.plans import series as S
from tickwise.plans.materialize import materialize


def calendar_grid(bars: DataFrame) -> DataFrame:
    """C6 skeleton: every (ticker, calendar date) from the ticker's first bar
    to the last date of the table, calendar = dates with any bar.  The date's
    number in the calendar is ``_i``: consecutive in each ticker, so no series
    has to be indexed.  The calendar, one row a date, is numbered in one task
    and written once."""
    dates = bars.select("d").distinct()
    calendar = materialize(dates.withColumn(S.IDX, (F.row_number().over(Window.orderBy("d")) - 1).cast("long")), "calendar")
    spans = bars.groupBy("ticker").agg(F.min("d").alias("d")).join(F.broadcast(calendar), "d")
    last = calendar.select(F.max(S.IDX)).scalar()
    days = spans.select("ticker", F.explode(F.sequence(F.col(S.IDX), last)).alias(S.IDX))
    return days.join(F.broadcast(calendar), S.IDX).select("ticker", "d", S.IDX)


def padded_closes(bars: DataFrame, x: str = "close", block_rows: int | None = None, keep_index: bool = False) -> DataFrame:
    """(ticker, d, close) on every calendar date from the ticker's first
    bar on; a missing or NULL close is the last one before it."""
    out = I.finish(_padded(bars, x, block_rows, halo=0), keep_index=True)
    return out.select("ticker", "d", x, *([S.IDX] if keep_index else []))


def _padded(bars, x, block_rows, halo=1):
    grid = calendar_grid(bars).join(bars.select("ticker", "d", x), ["ticker", "d"], "left")
    return I.fill_missing(I.prepare(grid, halo, block_rows=block_rows), x)


def daily_returns(bars: DataFrame, x: str = "close", block_rows: int | None = None) -> DataFrame:
    """C6 -> E8: returns of the padded closes (ticker, d, ret); NULL on a
    ticker's first date, 0.0 where it has no bar."""
    return I.finish(I.add_pct_change(_padded(bars, x, block_rows), x, "ret")).select("ticker", "d", "ret")


def complete_returns(returns: DataFrame) -> DataFrame:
    """Keep dates where every ticker has a return (listwise complete).
    With padded returns these are exactly the dates after the latest first
    return date; checked per date with a grouped count, not a wide pivot."""
    n_tickers = returns.select(F.countDistinct("ticker")).scalar()
    full = (returns.filter(F.col("ret").isNotNull()).groupBy("d").count()
            .filter(F.col("count") == n_tickers).select("d"))
    return returns.join(full, "d", "left_semi")


def aligned_matrix(bars: DataFrame, tickers: Sequence[str], field: str = "close") -> DataFrame:
    """Wide date x ticker matrix, one column for each of ``tickers``.
    The caller names them, so no job runs to find the columns."""
    return bars.groupBy("d").pivot("ticker", list(tickers)).agg(F.max(field))


# ------------------------------------------------------------------ D5

# Ship the task-side function with the task, so executors need numpy/pandas
# but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _GramAcc:
    """Running sums over dates of x_a * x_b for the pairs of one tile."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.gram = np.zeros((0, 0))

    def add(self, chunk: pd.DataFrame) -> None:
        for t in chunk["ticker"].unique():
            self.index.setdefault(t, len(self.index))
        k = len(self.index)
        if k > self.gram.shape[0]:
            g = np.zeros((k, k))
            g[:self.gram.shape[0], :self.gram.shape[1]] = self.gram
            self.gram = g
        _, rows = np.unique(chunk["d"].to_numpy(), return_inverse=True)
        mat = np.zeros((rows.max() + 1, k))
        mat[rows, chunk["ticker"].map(self.index).to_numpy()] = chunk["x"].to_numpy()
        self.gram += mat.T @ mat

    def frame(self, blocks: dict | None = None) -> pd.DataFrame:
        """Pairs keyed ticker_a <= ticker_b; with ``blocks`` (ticker -> block)
        only cross-block pairs."""
        names = np.array(list(self.index), dtype=object)
        ia, ib = np.triu_indices(len(names))
        if blocks is not None:
            bl = np.array([blocks[t] for t in names])
            keep = bl[ia] != bl[ib]
            ia, ib = ia[keep], ib[keep]
        a, b = names[ia], names[ib]
        swap = a > b
        return pd.DataFrame({"ticker_a": np.where(swap, b, a), "ticker_b": np.where(swap, a, b), "sxy": self.gram[ia, ib]})


def _complete_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut Arrow batches (rows sorted by ``keys``) so that no key group is
    split: each yielded frame holds whole groups."""
    pending = None
    for pdf in batches:
        if pending is not None:
            pdf = pd.concat([pending, pdf], ignore_index=True)
        if pdf.empty:
            continue
        last = pdf[keys].iloc[-1]
        is_last = np.logical_and.reduce([pdf[k].to_numpy() == last[k] for k in keys])
        done, pending = pdf[~is_last], pdf[is_last]
        if not done.empty:
            yield done
    if pending is not None and not pending.empty:
        yield pending


def _partial_gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition (rows sorted by tile and date): for every tile, the sums
    over dates of x_a * x_b for the pairs it owns.  A diagonal tile owns all
    pairs of its ticker block, an off-diagonal tile the pairs across its two
    blocks.  A tile is handed on when the next begins, so one is held."""
    tile, acc, blocks = None, _GramAcc(), {}

    def done():
        if acc.index:
            yield acc.frame(None if tile[0] == tile[1] else blocks)

    for chunk in _complete_groups(batches, ["_ta", "_tb", "d"]):
        for now, sub in chunk.groupby(["_ta", "_tb"], sort=False):
            if now != tile:
                yield from done()
                tile, acc, blocks = now, _GramAcc(), {}
            acc.add(sub)
            blocks.update(zip(sub["ticker"], sub["_blk"]))
    yield from done()


def corr_matrix(complete: DataFrame, partitions: int | None = None,
                tile_tickers: int = 1024, days: int = 256) -> DataFrame:
    """Pearson correlation of every ticker pair over listwise-complete
    returns, mirrored, diagonal included; NULL for a constant series or
    fewer than 2 dates.

    Each ticker's mean is taken off first (a small table of tickers), so that
    no digits cancel; then one pass adds cross products: each partition of
    (tile, date range) groups sums its own (numpy), the partials are summed per
    pair.  Tickers are dealt by hash to blocks of about ``tile_tickers``, and a
    task holds one tile of two blocks at a time."""
    x = complete.select("d", "ticker", "ret").where(F.col("ret").isNotNull())
    same = F.min("ret") == F.max("ret")
    stats = x.groupBy("ticker").agg(
        F.when(same, F.min("ret")).otherwise(F.avg("ret")).alias("mean"),
        F.when(~same & (F.count("ret") > 1), F.var_pop("ret") * F.count("ret")).alias("q"))
    nb = x.select(F.ceil(F.approx_count_distinct("ticker") / tile_tickers).cast("int")).scalar()
    j = F.explode(F.sequence(F.lit(0), nb - 1))
    tiled = (x.join(stats.select("ticker", "mean"), "ticker")
             .withColumn("_blk", F.pmod(F.xxhash64("ticker"), nb).cast("int"))
             .select("d", "ticker", "_blk", (F.col("ret") - F.col("mean")).alias("x"), j.alias("_j"))
             .withColumn("_ta", F.least("_blk", "_j")).withColumn("_tb", F.greatest("_blk", "_j"))
             .withColumn("_span", F.floor(F.unix_date("d") / F.lit(days))).drop("_j"))
    keys = ["_ta", "_tb", "_span"]
    by_tile = tiled.repartition(partitions, *keys) if partitions else tiled.repartition(*keys)
    parts = by_tile.sortWithinPartitions("_ta", "_tb", "d").mapInPandas(
        _partial_gram, "ticker_a string, ticker_b string, sxy double")
    sums = parts.groupBy("ticker_a", "ticker_b").agg(F.sum("sxy").alias("sxy"))
    qa = stats.select(F.col("ticker").alias("ticker_a"), F.col("q").alias("qa"))
    qb = stats.select(F.col("ticker").alias("ticker_b"), F.col("q").alias("qb"))
    corr = F.when((F.col("qa") > 0) & (F.col("qb") > 0), ratio(F.col("sxy"), F.sqrt("qa") * F.sqrt("qb")))
    pair = F.struct(F.col("ticker_a").alias("a"), F.col("ticker_b").alias("b"))
    mirror = F.struct(F.col("ticker_b").alias("a"), F.col("ticker_a").alias("b"))
    both = F.when(F.col("ticker_a") == F.col("ticker_b"), F.array(pair)).otherwise(F.array(pair, mirror))
    out = sums.join(qa, "ticker_a").join(qb, "ticker_b").select(F.explode(both).alias("p"), corr.alias("corr"))
    return out.select(F.col("p.a").alias("ticker_a"), F.col("p.b").alias("ticker_b"), "corr")


# ------------------------------------------------------------------ C2, E11

def ticker_pairs(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    """Unordered pairs (a < b) of the tickers the caller asks for."""
    names = sorted(set(tickers))
    return spark.createDataFrame([(a, b) for i, a in enumerate(names) for b in names[i + 1:]],
                                 "ticker_a string, ticker_b string")


def pairwise_returns(returns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(ticker_a, ticker_b, d, ret_a, ret_b) for the requested pairs,
    equi-joined on ticker and date."""
    a = returns.select(F.col("ticker").alias("ticker_a"), "d", F.col("ret").alias("ret_a"))
    b = returns.select(F.col("ticker").alias("ticker_b"), "d", F.col("ret").alias("ret_b"))
    return pairs.join(a, "ticker_a").join(b, ["ticker_b", "d"]).select(
        "ticker_a", "ticker_b", "d", "ret_a", "ret_b")


def rolling_corr(pair_returns: DataFrame, n: int = 30, block_rows: int | None = None) -> DataFrame:
    """Correlation over the trailing n rows of each pair, NULL until the
    frame is full or when a side is constant in it.  Sums over the frame are
    differences of running sums, as in ``series.add_rolling``."""
    keys = ["ticker_a", "ticker_b"]
    f = I.prepare(pair_returns, n, keys=keys, block_rows=block_rows)
    f = S.centred(f, keys, {"_a": "ret_a", "_b": "ret_b"})
    a, b = "(ret_a - _a_a)", "(ret_b - _b_a)"
    sums = S.Prefix(f, keys, {"_sa": a, "_sb": b, "_qa": f"{a} * {a}", "_qb": f"{b} * {b}", "_ab": f"{a} * {b}"},
                    {f"_{k}{s}": c for s in "ab" for k, c in (("n", S.seen(f"ret_{s}")), ("k", S.changed(f"ret_{s}", f"_{s}_p")))})
    f = S.with_sql(sums.df, {t: sums.over(t, n) for t in ("_sa", "_sb", "_qa", "_qb", "_ab")}
                   | {f"_{k}{s}": sums.count(f"_{k}{s}", n if k == "n" else n - 1) for s in "ab" for k in "nk"})
    full = f"_na = {n} AND _nb = {n} AND _ka > 0 AND _kb > 0"
    va, vb = (f"(_q{s} - _s{s} * _s{s} / {n})" for s in "ab")
    f = S.with_sql(f, {"corr": f"CASE WHEN {full} AND {va} > 0 AND {vb} > 0 THEN (_ab - _sa * _sb / {n}) / (SQRT({va}) * SQRT({vb})) END"})
    return I.finish(f).select(*keys, "d", "corr")


# ------------------------------------------------------------------ D8

#: A kernel this many bandwidths away from a grid point is below 1e-17 of its peak.
REACH = 9.0


def return_density(complete: DataFrame, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE of each ticker's returns on a ``gridsize`` grid from
    min - cut*h to max + cut*h, Scott bandwidth h = std * n^(-1/5).

    A return adds its kernel to the grid points within ``REACH`` bandwidths
    only, a number of points that shrinks as the sample grows; the kernels are
    summed by (ticker, k) in a hash aggregate, before and after the shuffle.
    NULL density where the bandwidth is not positive (a constant series or one
    sample)."""
    r = complete.filter(F.col("ret").isNotNull()).select("ticker", "ret")
    st = r.groupBy("ticker").agg(F.count("ret").alias("n"), F.stddev_samp("ret").alias("sd"),
                                 F.min("ret").alias("lo"), F.max("ret").alias("hi"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = st.select("ticker", "n", h.alias("h"), "lo", "hi").select(
        "ticker", "n", "h",
        (F.col("lo") - F.col("h") * cut).alias("g0"),
        ((F.col("hi") - F.col("lo") + F.col("h") * (2 * cut)) / (gridsize - 1)).alias("step"))
    near = r.join(st.select("ticker", "h", "g0", "step").filter(F.col("h") > 0), "ticker")
    at, reach = (F.col("ret") - F.col("g0")) / F.col("step"), F.col("h") * REACH / F.col("step")
    first, last = F.greatest(F.lit(0), F.ceil(at - reach)).cast("int"), F.least(F.lit(gridsize - 1), F.floor(at + reach)).cast("int")
    near = near.select("ticker", "ret", "h", "g0", "step", F.explode(F.sequence(first, last)).alias("k"))
    z = (F.col("g0") + F.col("k") * F.col("step") - F.col("ret")) / F.col("h")
    sums = near.groupBy("ticker", "k").agg(F.sum(F.exp(-(z * z) / 2)).alias("_s"))
    grid = st.select("ticker", "n", "h", "g0", "step",
                     F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("k"))
    out = grid.join(sums, ["ticker", "k"], "left")
    x = F.col("g0") + F.col("k") * F.col("step")
    dens = F.when(F.col("h") > 0, F.coalesce(F.col("_s"), F.lit(0.0))
                  / (F.col("n") * F.col("h") * np.sqrt(2 * np.pi)))
    return out.select("ticker", "k", x.alias("x"), dens.alias("density"))
