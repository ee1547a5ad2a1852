"""Independent DuckDB SQL for each registered query (the correctness gate).

Written straight from the definitions (pandas semantics), with plain
``PARTITION BY ticker`` windows and recursive CTEs for the exponential
averages, so it shares no plan with the Spark side.  Doubles are rounded the
same way on both sides (see ``tickwise.catalog.ROUND``).
"""

from __future__ import annotations

import math

# The fixture bars (integer-cent price walk over lineitem ticks).
BARS = """
price_ticks AS (
  SELECT l_returnflag || l_linestatus AS ticker, CAST(l_shipdate AS DATE) AS d, l_quantity AS qty,
         (500000 + SUM(CAST(ROUND(l_discount * 100) AS INT) * 50 - 250) OVER (
           PARTITION BY l_returnflag || l_linestatus
           ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 100.0 AS price,
         ROW_NUMBER() OVER (
           PARTITION BY l_returnflag || l_linestatus
           ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS seq
  FROM lineitem
),
bars AS (
  SELECT ticker, d,
         CAST(MIN_BY(price, seq) AS DOUBLE) AS open,  CAST(MAX(price) AS DOUBLE) AS high,
         CAST(MIN(price) AS DOUBLE) AS low,           CAST(MAX_BY(price, seq) AS DOUBLE) AS close,
         CAST(SUM(qty) AS BIGINT) AS volume
  FROM price_ticks GROUP BY ticker, d
),
b AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY d) - 1 AS i FROM bars
)"""

P = "PARTITION BY ticker ORDER BY d"


def over(n: int | None = None, part: str = P) -> str:
    if n is None:
        return f"OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"OVER ({part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(fn: str, x: str, n: int, part: str = P) -> str:
    """pandas rolling(n): NULL until the frame holds n values."""
    return f"CASE WHEN COUNT({x}) {over(n, part)} = {n} THEN {fn}({x}) {over(n, part)} END"


def lag(x: str, k: int = 1, part: str = P) -> str:
    return f"LAG({x}, {k}) OVER ({part})"


def r(x: str, dp: int) -> str:
    return f"ROUND({x}, {dp})"


def rsi_expr(ag: str, al: str) -> str:
    return (f"CASE WHEN {al} = 0 THEN (CASE WHEN {ag} > 0 THEN 100.0 END) "
            f"ELSE 100.0 - 100.0 / (1.0 + {ag} / {al}) END")


def gain_loss_cte(src: str = "b") -> str:
    return f"""gl AS (
  SELECT *, CASE WHEN close - {lag('close')} > 0 THEN close - {lag('close')} ELSE 0.0 END AS gain,
            CASE WHEN close - {lag('close')} < 0 THEN {lag('close')} - close ELSE 0.0 END AS loss
  FROM {src}
)"""


def ema_rec(name: str, src: str, cols: list[tuple[str, str, float]], keep: list[str]) -> str:
    """Recursive CTE ``name`` over ``src`` (needs ticker, i): for each
    (out, x, alpha) y0 = x0, yi = (1 - alpha) y(i-1) + alpha xi."""
    init = ", ".join(f"CAST({x} AS DOUBLE) AS {o}" for o, x, _ in cols)
    step = ", ".join(f"{1 - a!r} * e.{o} + {a!r} * s.{x}" for o, x, a in cols)
    k0 = "".join(f", {c}" for c in keep)
    k1 = "".join(f", s.{c}" for c in keep)
    return f"""{name} AS (
  SELECT ticker, i{k0}, {init} FROM {src} WHERE i = 0
  UNION ALL
  SELECT s.ticker, s.i{k1}, {step}
  FROM {name} e JOIN {src} s ON s.ticker = e.ticker AND s.i = e.i + 1
)"""


def macd_ctes(fast=12, slow=26, signal=9, strict=False) -> str:
    """CTE ``m`` (ticker, d, i, close, macd, sig).  Non-strict: every EMA
    from row 0.  Strict: EMAs masked until span values; the signal EMA starts
    at the first MACD value (row slow-1) and is masked for signal-1 more."""
    af, asl, ag = 2 / (fast + 1), 2 / (slow + 1), 2 / (signal + 1)
    base = ema_rec("e1", "b", [("ef", "close", af), ("es", "close", asl)], ["d", "close"])
    if not strict:
        return base + f""",
mb AS (SELECT ticker, i, d, close, ef - es AS macd FROM e1),
{ema_rec("e2", "mb", [("sig", "macd", ag)], ["d", "close", "macd"])},
m AS (SELECT ticker, d, i, close, macd, sig FROM e2)"""
    start = slow - 1
    return base + f""",
mb AS (SELECT ticker, i - {start} AS i, i AS i0, d, close, ef - es AS macd FROM e1 WHERE i >= {start}),
{ema_rec("e2", "mb", [("sig", "macd", ag)], ["i0", "d", "close", "macd"])},
m AS (
  SELECT e1.ticker, e1.d, e1.i, e1.close,
         CASE WHEN e1.i >= {start} THEN e1.ef - e1.es END AS macd,
         CASE WHEN e1.i >= {start + signal - 1} THEN e2.sig END AS sig
  FROM e1 LEFT JOIN e2 ON e2.ticker = e1.ticker AND e2.i0 = e1.i
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip().rstrip(",") for c in ctes)


STRATEGY_NAMES = ["SMA Crossover", "MACD Momentum", "RSI Filter", "Bollinger Bands"]


def signals_ctes(short=50, long=200, fast=12, slow=26, signal=9, rsi_n=14, rsi_threshold=70, bb_n=20) -> str:
    """CTE ``lg``: one row per (ticker, strategy, d) with ret, signal,
    position, strategy_return."""
    return ",\n".join([
        macd_ctes(fast, slow, signal),
        gain_loss_cte("b"),
        f"""ind AS (
  SELECT gl.ticker, gl.d, gl.i, gl.close,
         gl.close / NULLIF({lag('gl.close', part='PARTITION BY gl.ticker ORDER BY gl.d')}, 0) - 1 AS ret,
         {roll('AVG', 'gl.close', short, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS s50,
         {roll('AVG', 'gl.close', long, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS s200,
         {roll('AVG', 'gl.close', bb_n, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS s20,
         {roll('AVG', 'gain', rsi_n, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS ag,
         {roll('AVG', 'loss', rsi_n, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS al,
         m.macd, m.sig
  FROM gl JOIN m ON m.ticker = gl.ticker AND m.i = gl.i
)""",
        f"""sg AS (
  SELECT ticker, d, i, ret,
         CASE WHEN s50 > s200 THEN 1.0 ELSE 0.0 END AS sig0,
         CASE WHEN macd > sig THEN 1.0 ELSE 0.0 END AS sig1,
         CASE WHEN ({rsi_expr('ag', 'al')}) < {rsi_threshold} THEN 1.0 ELSE 0.0 END AS sig2,
         CASE WHEN close < s20 THEN 1.0 ELSE 0.0 END AS sig3
  FROM ind
)""",
        "lg0 AS (\n" + "\n  UNION ALL\n".join(
            f"  SELECT ticker, '{n}' AS strategy, {k} AS strategy_ord, d, i, ret, sig{k} AS signal FROM sg"
            for k, n in enumerate(STRATEGY_NAMES)) + "\n)",
        f"""lg AS (
  SELECT *, ret * position AS strategy_return FROM (
    SELECT *, {lag('signal', part='PARTITION BY ticker, strategy ORDER BY d')} AS position FROM lg0)
)""",
        f"""summary AS (
  SELECT ticker, strategy, strategy_ord,
         PRODUCT(1 + strategy_return) * 10000.0 AS final_equity,
         PRODUCT(1 + strategy_return) - 1 AS total_return,
         CASE WHEN STDDEV_SAMP(strategy_return) > 0
              THEN AVG(strategy_return) / STDDEV_SAMP(strategy_return) * {math.sqrt(252)!r}
              ELSE 0.0 END AS sharpe_ratio
  FROM lg GROUP BY ticker, strategy, strategy_ord
)""",
    ])
