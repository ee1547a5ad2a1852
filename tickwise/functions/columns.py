"""Scalar column helpers (I1-I7) and pandas-compatible NULL rules.

pandas marks missing as NaN and ``NaN > x`` is False; Spark's ``NaN > x`` is
true.  tickwise never produces NaN: every ratio goes through ``try_divide``
(NULL on division by zero under ANSI) and every 0/1 signal is
``when(cond, 1.0).otherwise(0.0)``, which maps NULL conditions to 0.0 like
``np.where``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI error, no inf)."""
    return F.try_divide(c(num), c(den))


def flag(cond: Column) -> Column:
    """0/1 double signal; NULL condition counts as false (np.where)."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))




def pct_text(x, dp: int = 2) -> Column:
    """``12.34%``."""
    return F.format_string(f"%.{dp}f%%", c(x))


def int_text(x) -> Column:
    """``1,234,567``."""
    return F.format_number(c(x).cast("long"), 0)


def parse_ticker_list(text) -> Column:
    """'nvda, intc,,amd ' -> ['NVDA','INTC','AMD'] (I5): split on comma,
    trim, upper-case, drop empty entries."""
    parts = F.transform(F.split(c(text), ","), lambda s: F.upper(F.trim(s)))
    return F.filter(parts, lambda s: s != F.lit(""))


def wrap_label(text) -> Column:
    """Space to newline, for chart labels."""
    return F.replace(c(text), F.lit(" "), F.lit("\n"))





def now_epoch(at: int | None = None) -> Column:
    """Current epoch seconds as BIGINT (I3).  ``at`` pins the instant, which
    keeps a job deterministic on re-runs and retries; without it the value is
    the query's start time (one value for the whole query)."""
    return F.lit(int(at)).cast("long") if at is not None else F.unix_timestamp().cast("long")
