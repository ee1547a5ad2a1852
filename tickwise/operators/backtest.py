"""Backtest (F14, F15), all strategies (F16), ranking.

strategy return = bar return x position; equity = cumprod(1 + r) x capital
(NULL rows skipped and left NULL); final equity = equity of the last bar;
Sharpe = mean / sample std x sqrt(252) when std > 0, else 0.0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators import indicators as I
from tickwise.operators import strategies as ST
from tickwise.plans import series as S

TRADING_DAYS = 252
DEFAULT_CAPITAL = 10_000.0
STRAT_KEYS = ("ticker", "strategy")


def strategy_frame(bars: DataFrame, block_rows: int | None = None, **params) -> DataFrame:
    """Prepared long frame: one row per (ticker, strategy, bar) with ``ret``,
    ``signal``, ``position`` and ``strategy_return``; halo rows still in."""
    f = I.prepare(bars, ST.strategy_halo(**params), block_rows=block_rows)
    f = ST.stack_strategies(ST.add_all_signals(f, **params))
    return f.withColumn("strategy_return", F.col("ret") * F.col("position"))


def signal_frame(signals: DataFrame, strategy: str, block_rows: int | None = None) -> DataFrame:
    """The same frame for one strategy's output (``ticker, d, close, signal,
    position``, as the ``strategy_*`` functions return it), whatever its
    parameters were."""
    f = I.prepare(signals.select("ticker", "d", "close", "signal", "position"), 1, block_rows=block_rows)
    f = I.add_pct_change(f, "close", "ret")
    return (f.withColumn("strategy", F.lit(strategy)).withColumn("strategy_ord", F.lit(0))
            .withColumn("strategy_return", F.col("ret") * F.col("position")))


def backtest_signals(signals: DataFrame, strategy: str = "custom", capital: float = DEFAULT_CAPITAL,
                     block_rows: int | None = None) -> DataFrame:
    """F14 for one chosen strategy: its equity curve and the market's."""
    return curves_from(signal_frame(signals, strategy, block_rows), capital)


def signal_metrics(signals: DataFrame, strategy: str = "custom", capital: float = DEFAULT_CAPITAL,
                   block_rows: int | None = None) -> DataFrame:
    """F15 for one chosen strategy."""
    return metrics_from(signal_frame(signals, strategy, block_rows), capital)


def backtest_curves(bars: DataFrame, capital: float = DEFAULT_CAPITAL,
                    block_rows: int | None = None, **params) -> DataFrame:
    """F14 for all strategies, with their parameters: equity curve per
    (ticker, strategy, d) and the market curve, all five growths in one scan
    before the rows are stacked."""
    f = ST.add_all_signals(I.prepare(bars, ST.strategy_halo(**params), block_rows=block_rows), **params)
    f = f.withColumns({**{f"_g{k}": F.lit(1.0) + F.col("ret") * F.col(f"pos{k}") for k in range(4)}, "_m": F.lit(1.0) + F.col("ret")})
    f = S.carry_scans(f, list(I.KEYS), [*((f"_g{k}", f"_eq{k}", "product") for k in range(4)), ("_m", "_mk", "product")], halo=0)
    return _curves(ST.stack_strategies(f).withColumn("strategy_return", F.col("ret") * F.col("position")), capital)


def curves_from(f: DataFrame, capital: float = DEFAULT_CAPITAL) -> DataFrame:
    """Equity and market curves of a strategy frame."""
    f = f.withColumn("_g", F.lit(1.0) + F.col("strategy_return")) \
         .withColumn("_m", F.lit(1.0) + F.col("ret"))
    f = S.carry_scans(f, list(STRAT_KEYS), [("_g", "_eq", "product"), ("_m", "_mk", "product")], halo=0)
    return _curves(f, capital)


def _curves(f: DataFrame, capital: float) -> DataFrame:
    f = f.withColumn("equity", F.col("_eq") * capital).withColumn("market", F.col("_mk") * capital)
    return I.finish(f).select("ticker", "strategy", "strategy_ord", "d", "ret", "signal",
                              "position", "strategy_return", "equity", "market")


def metrics_from(frame: DataFrame, capital: float = DEFAULT_CAPITAL) -> DataFrame:
    """F15 over a strategy frame: one partial + final aggregate per
    (ticker, strategy); no per-row curve is needed for the summary."""
    own = frame.filter(~F.col(S.HALO))
    agg = own.groupBy("ticker", "strategy", "strategy_ord").agg(
        F.product(F.lit(1.0) + F.col("strategy_return")).alias("_growth"),
        F.avg("strategy_return").alias("_mean"),
        F.stddev_samp("strategy_return").alias("_std"),
    )
    final = F.col("_growth") * capital
    sharpe = F.when(F.col("_std") > 0, F.col("_mean") / F.col("_std") * math.sqrt(TRADING_DAYS)) \
        .otherwise(F.lit(0.0))
    return agg.select("ticker", "strategy", "strategy_ord",
                      final.alias("final_equity"),
                      (F.col("_growth") - 1).alias("total_return"),
                      sharpe.alias("sharpe_ratio"))


def run_all(bars: DataFrame, capital: float = DEFAULT_CAPITAL, block_rows: int | None = None,
            **params) -> DataFrame:
    """F16: every strategy on every ticker in one plan -> summary rows."""
    return metrics_from(strategy_frame(bars, block_rows, **params), capital)


def sharpe_band(summary: DataFrame, col: str = "sharpe_ratio") -> DataFrame:
    """B14: 'good' at >= 1, 'fair' above 0, else 'poor'."""
    s = F.col(col)
    return summary.withColumn("sharpe_band", F.when(s >= 1, "good").when(s > 0, "fair").otherwise("poor"))


def best_strategy(summary: DataFrame) -> DataFrame:
    """the strategy with the highest final equity per ticker; ties keep
    the fixed strategy order."""
    w = Window.partitionBy("ticker").orderBy(F.col("final_equity").desc_nulls_last(), "strategy_ord")
    return summary.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def leaderboard(summary: DataFrame) -> DataFrame:
    """All (ticker, strategy) rows by return % descending."""
    return summary.select(
        "ticker", "strategy",
        F.col("final_equity"),
        (F.col("total_return") * 100).alias("return_pct"),
        F.col("sharpe_ratio").alias("sharpe"),
        "strategy_ord",
    ).orderBy(F.col("return_pct").desc_nulls_last(), "ticker", "strategy_ord")


def winner(summary: DataFrame) -> DataFrame:
    """the overall best row (top-1 is the feature)."""
    return leaderboard(summary).limit(1)
