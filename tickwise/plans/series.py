"""Series frames: position index, row blocks with a halo, cross-block scans.

Per-ticker time-series work (rolling means, lags, recursive averages,
cumulative products) is naturally a window ``PARTITION BY ticker ORDER BY d``.
That puts a whole ticker into one task; with one ticker holding a third of the
rows that task is the job.  Here a series is cut into blocks of ``B`` rows:

1. ``index_series`` gives each row its 0-based position ``_i`` in its series
   without sorting a series in one task: rows are ranked inside coarse,
   order-monotone buckets (e.g. 32-day spans), and a small table of bucket
   sizes gives every bucket its starting offset (running sum over buckets).
   A table that already has ``_i`` keeps it.
2. ``with_blocks`` sets ``_blk = _i div B`` and copies the last ``halo`` rows
   of every block into the next one (``_halo = true``), so that any frame of
   at most ``halo`` preceding rows is complete inside ``PARTITION BY key,
   _blk``.  Halo copies are dropped at the end (``drop_halo``).
3. ``add_rolling`` takes sums over the last ``n`` rows as differences of
   running sums inside a block, so that a row costs the same for any ``n``.
4. ``scan`` does what reaches back to the start of a series (cumulative
   product / max / sum, forward fill, recursive averages) in two levels: a
   running state inside each block, written once, and a carry over the small
   table of the blocks' last rows.

All steps are built-in window and aggregate expressions (JVM, codegen); no
Python runs per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.plans.materialize import materialize

IDX = "_i"
BLK = "_blk"
HALO = "_halo"

DEFAULT_BLOCK_ROWS = 1 << 11
UNB = Window.unboundedPreceding


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def date_bucket(c: str | Column, days: int = 32) -> Column:
    """Coarse bucket of a DATE column, monotone in the date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(F.unix_date(c) / F.lit(days))


def seconds_bucket(c: str | Column, seconds: int | Column = 3600) -> Column:
    """Coarse bucket of an epoch-seconds column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(seconds))


def adaptive_width(df: DataFrame, order_col: str, keys: Sequence[str], target_rows: int = 1 << 16) -> Column:
    """Bucket width (in units of ``order_col``) so that a (series, bucket)
    group holds about ``target_rows`` rows: target * span * series / rows.
    A scalar-subquery Column, evaluated inside the job that uses it; the
    buckets then stay bounded however dense the hottest series gets."""
    x = F.col(order_col)
    n_series = F.approx_count_distinct(F.struct(*keys)) if len(keys) > 1 else F.approx_count_distinct(keys[0])
    span = F.max(x) - F.min(x) + 1
    width = F.greatest(F.lit(1), F.ceil(F.lit(float(target_rows)) * span * n_series / F.count(F.lit(1))))
    return df.select(width.cast("long")).scalar()


def index_series(df: DataFrame, keys: Sequence[str], order: Sequence, bucket: Column) -> DataFrame:
    """Add ``_i``: 0-based position of the row inside its series ``keys``.

    ``order`` must be a total order within a series and ``bucket`` must be
    non-decreasing along it.  No task sorts more than one (series, bucket)
    group, and the offset table has one row per (series, bucket).  A table
    with positions is returned as it is.
    """
    if IDX in df.columns:
        return df
    keys = list(keys)
    tb, rn, off = "_tb", "_rn", "_off"
    staged = df.withColumn(tb, bucket)
    ranked = staged.withColumn(rn, F.row_number().over(
        Window.partitionBy(*keys, tb).orderBy(*_cols(order))))
    sizes = staged.groupBy(*keys, tb).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(*keys, tb, F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys).orderBy(tb).rowsBetween(UNB, -1)),
        F.lit(0)).alias(off))
    return (ranked.join(offsets, [*keys, tb])
            .withColumn(IDX, (F.col(off) + F.col(rn) - 1).cast("long"))
            .drop(tb, rn, off))


def block_rows_for(halo: int, block_rows: int | None = None) -> int:
    """Smallest power-of-two block size >= the request that keeps the halo
    under a quarter of a block (so copies add at most 25% rows)."""
    def pow2(v):
        return 1 << max(0, math.ceil(math.log2(max(v, 1))))
    if block_rows:  # explicit size (tests): only the hard bound halo <= B
        return max(pow2(block_rows), pow2(halo))
    b = pow2(DEFAULT_BLOCK_ROWS)
    while b < 4 * halo:
        b *= 2
    return b


def with_blocks(df: DataFrame, halo: int, block_rows: int) -> DataFrame:
    """Assign ``_blk`` and add halo copies of each block's last ``halo`` rows
    to the next block.  Requires ``halo <= block_rows``.  Both numbers stay
    with the column, as its metadata."""
    if halo > block_rows:
        raise ValueError(f"halo {halo} exceeds block size {block_rows}")
    i = F.col(IDX)
    base = F.floor(i / F.lit(block_rows))
    about = {"rows": block_rows, "halo": halo}
    rest = [c for c in df.columns if c not in (BLK, HALO)]
    if halo <= 0:
        return df.select(*rest, base.alias(BLK, metadata=about), F.lit(False).alias(HALO))
    copies = F.when(F.pmod(i, F.lit(block_rows)) >= block_rows - halo,
                    F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.select(*rest, F.explode(copies).alias("_dup"))
            .select(*rest, (base + F.col("_dup")).alias(BLK, metadata=about), (F.col("_dup") == 1).alias(HALO)))


def block_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(IDX)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, BLK)


# ---------------------------------------------------------------- rolling sums

@dataclass(frozen=True)
class Rolling:
    """Mean and sample std of ``x`` over the last ``n`` rows, NULL until the
    frame holds ``n`` values (pandas ``rolling(n)``); either may be left out."""
    x: str
    n: int
    mean: str | None = None
    std: str | None = None


# The steps below are SQL text: a scan has hundreds of expressions, and each
# Column object costs a few round trips to the JVM, a text only one.

def _q(name: str) -> str:
    return f"`{name}`"


class _Over:
    """The OVER clauses of a blocked frame's windows."""

    def __init__(self, keys: Sequence[str], *more: str, order: str = IDX):
        self.spec = f"PARTITION BY {', '.join(map(_q, [*keys, *more]))} ORDER BY {_q(order)}"
        self.row = f"OVER ({self.spec})"
        self.run = f"OVER ({self.spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        self.before = f"OVER ({self.spec} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with further columns from SQL text."""
    return df.selectExpr("*", *[f"{x} AS {_q(name)}" for name, x in columns.items()]) if columns else df


class Prefix:
    """Running sums of some terms (SQL text) over a blocked frame, halo rows
    included, each as a sum and the running sum of its rounding errors; the sum
    over the last ``n`` rows is then a difference, whose error doesn't grow with
    the block.  Terms are NULL where a value is missing and count as 0."""

    def __init__(self, df: DataFrame, keys: Sequence[str], terms: dict[str, str], counts: dict[str, str]):
        self.w = w = _Over(keys, BLK)
        df = with_sql(df, {**{f"{t}_t": f"COALESCE({x}, 0D)" for t, x in terms.items()}, **{f"{c}_t": x for c, x in counts.items()}})
        df = with_sql(df, {**{f"{t}_s": f"SUM({t}_t) {w.run}" for t in terms}, **{f"{t}_b": f"COALESCE(SUM({t}_t) {w.before}, 0D)" for t in terms},
                           **{f"{c}_s": f"SUM({c}_t) {w.run}" for c in counts}})
        # what rounding took from s = b + t, exactly
        error = "({t}_b - ({t}_s - ({t}_s - {t}_b))) + ({t}_t - ({t}_s - {t}_b))"
        self.df = with_sql(df, {f"{t}_e": f"SUM({error.format(t=t)}) {w.run}" for t in terms})

    def over(self, term: str, n: int) -> str:
        """Sum of a term over the last ``n`` rows."""
        return f"({term}_s - LAG({term}_s, {n}, 0D) {self.w.row}) + ({term}_e - LAG({term}_e, {n}, 0D) {self.w.row})"

    def count(self, name: str, n: int) -> str:
        return f"{name}_s - LAG({name}_s, {n}, 0L) {self.w.row}" if n > 0 else "0L"


def centred(df: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """For each name -> x: ``name_a``, the first value of the block, from which
    sums are taken, and ``name_p``, the value before the row's."""
    w = _Over(keys, BLK)
    return with_sql(df, {**{f"{c}_a": f"FIRST({_q(x)}, true) {w.run}" for c, x in columns.items()},
                         **{f"{c}_p": f"LAST({_q(x)}, true) {w.before}" for c, x in columns.items()}})


def seen(x: str) -> str:
    return f"CAST({x} IS NOT NULL AS INT)"


def changed(x: str, before: str) -> str:
    return f"CAST(COALESCE({x} != {before}, false) AS INT)"


def add_rolling(df: DataFrame, keys: Sequence[str], specs: Sequence[Rolling]) -> DataFrame:
    """The moments of ``specs``; specs of one column share its running sums.

    Sums are taken of ``x`` less the block's first value and of its square.
    A frame of equal values is told apart by a count of changes: its mean is
    the value and its std 0, exactly.  The halo must hold ``n`` rows."""
    keys, keep = list(keys), [c for c in df.columns if c not in {o for r in specs for o in (r.mean, r.std)}]
    name = {x: f"_m{k}" for k, x in enumerate(dict.fromkeys(r.x for r in specs))}
    # NaN counts as missing
    df = with_sql(df, {f"{c}_v": f"NANVL(CAST({_q(x)} AS DOUBLE), CAST(NULL AS DOUBLE))" for x, c in name.items()})
    df = centred(df, keys, {c: f"{c}_v" for c in name.values()})
    terms, counts = {}, {}
    for x, c in name.items():
        z = f"({c}_v - {c}_a)"
        terms[f"{c}z"] = z
        if any(r.std for r in specs if r.x == x):
            terms[f"{c}q"] = f"{z} * {z}"
        counts[f"{c}n"], counts[f"{c}k"] = seen(f"{c}_v"), changed(f"{c}_v", f"{c}_p")
    sums = Prefix(df, keys, terms, counts)
    parts: dict[str, str] = {}
    for r in specs:
        c, n = name[r.x], r.n
        parts |= {f"{c}z{n}": sums.over(f"{c}z", n), f"{c}n{n}": sums.count(f"{c}n", n), f"{c}k{n}": sums.count(f"{c}k", n - 1)}
        if r.std:
            parts[f"{c}q{n}"] = sums.over(f"{c}q", n)
    df, outs = with_sql(sums.df, parts), {}
    for r in specs:
        c, n = name[r.x], r.n
        full, same, s = f"{c}n{n} = {n}", f"{c}k{n} = 0", f"{c}z{n}"
        if r.mean:
            outs[r.mean] = f"CASE WHEN {full} THEN CASE WHEN {same} THEN {c}_v ELSE {c}_a + {s} / {n} END END"
        if r.std:
            var = f"GREATEST(0D, {c}q{n} - {s} * {s} / {n}) / {max(n - 1, 1)}"
            outs[r.std] = f"CASE WHEN {full} AND {n} > 1 THEN CASE WHEN {same} THEN 0D ELSE SQRT({var}) END END"
    return df.selectExpr(*map(_q, keep), *[f"{x} AS {_q(o)}" for o, x in outs.items()])


# ---------------------------------------------------------------- scans

@dataclass(frozen=True)
class Run:
    """Running ``kind`` ("sum", "max", "min", "product", "last") of ``x`` from
    the start of the series.  NULLs are skipped; the result is NULL where ``x``
    is, except that "last" (forward fill) repeats the last value there."""
    kind: str
    x: str
    out: str


@dataclass(frozen=True)
class Ema:
    """pandas ``x.ewm(alpha=alpha, adjust=False, min_periods=...).mean()`` as
    ``out``, and ``gap``: the value (the last one, on a NULL row) less the
    average.  A value ``g`` rows after the last one enters with weights
    ``q ** g`` to ``alpha``, scaled to 1; a NULL row repeats the average;
    ``min_periods`` counts values."""
    x: str
    out: str | None
    alpha: float
    min_periods: int = 0
    gap: str | None = None


# running aggregate (in a block, and of blocks' totals), combination with the carry
_RUNS = {
    "sum": ("SUM({})", "COALESCE({c}, 0) + {r}"),
    "max": ("MAX({})", "GREATEST({c}, {r})"),
    "min": ("MIN({})", "LEAST({c}, {r})"),
    "product": (None, "COALESCE({c}, 1D) * {r}"),  # no SQL name
    "last": ("LAST({}, true)", "COALESCE({r}, {c})"),
}

#: Products of decay factors that are divided by stay above exp(-DECAY).
DECAY = 600.0


def _decay_rows(alpha: float) -> int:
    """Most rows, a power of two, after which the average keeps exp(-DECAY)."""
    return 1 << max(0, int(math.log2(max(1.0, DECAY / -math.log(1.0 - alpha)))))


def _factor(gap: str, alpha: float) -> str:
    """What a value ``gap`` rows after the last one leaves to the average."""
    if alpha >= 1:
        return "0D"
    q, decay = f"{1.0 - alpha!r}D", f"POW({1.0 - alpha!r}D, {gap})"
    return f"CASE WHEN {gap} = 1 THEN {q} ELSE {decay} / ({decay} + {alpha!r}D) END"


def _products(df: DataFrame, columns: dict[str, Column], keys: Sequence[str], *more: str, order: str = IDX) -> DataFrame:
    w = Window.partitionBy(*keys, *more).orderBy(order).rowsBetween(UNB, 0)
    return df.withColumns({out: F.product(x).over(w) for out, x in columns.items()}) if columns else df


def scan(df: DataFrame, keys: Sequence[str], specs: Sequence[Run | Ema], halo: int | None = None) -> DataFrame:
    """Add the running results of ``specs`` to a blocked frame.

    The frame with its in-block states is written once.  The blocks' last rows
    (a pushed filter on that table) hold all that the next block needs; their
    carry is a window over a table of one row a block.  The result is blocked
    again, with ``halo`` rows (by default as many as before).

    Averages run on differences: with ``e`` the value less the average, ``a``
    the factor of the value and ``d`` its difference from the value before,
    ``e = a (e' + d)``.  So equal values add exactly nothing, however long they
    last, and ``x - e`` is then ``x`` itself.  Inside a block ``e = P (G + u)``
    with ``P`` the product of the factors after its first value, ``G`` the sum
    of ``a d / P`` and ``u`` the first value's ``e``; over a whole block ``e``
    at its end is ``A + D e'``, a pair (D, A) that composes (``_affine``)."""
    keys, about = list(keys), df.schema[BLK].metadata
    rows, halo = about["rows"], about["halo"] if halo is None else halo
    emas = [s for s in specs if isinstance(s, Ema)]
    runs = [s for s in specs if isinstance(s, Run)]
    outs = [o for s in specs for o in ((s.out, s.gap) if isinstance(s, Ema) else (s.out,)) if o]
    keep = [c for c in df.columns if c not in {*outs, BLK, HALO}]
    width = min([rows, *(_decay_rows(s.alpha) for s in emas if s.alpha < 1)])
    blk = _q(BLK) if width == rows else f"FLOOR({IDX} / {width}) AS {BLK}"
    own = df.filter(f"NOT {HALO}").selectExpr(*[_q(c) for c in df.columns if c not in (BLK, HALO)], blk)
    w = _Over(keys, BLK)
    name = {x: f"_x{k}" for k, x in enumerate(dict.fromkeys(s.x for s in emas))}

    state = {"_end": f"LEAD({IDX}) {w.row} IS NULL"}
    state |= {f"_r{k}": f"{_RUNS[s.kind][0].format(_q(s.x))} {w.run}" for k, s in enumerate(runs) if s.kind != "product"}
    for x, c in name.items():
        at, x = f"CASE WHEN {_q(x)} IS NOT NULL THEN {IDX} END", _q(x)
        state |= {f"{c}_px": f"LAST({x}, true) {w.before}", f"{c}_pi": f"LAST({at}, true) {w.before}", f"{c}_lx": f"LAST({x}, true) {w.run}",
                  f"{c}_li": f"LAST({at}, true) {w.run}", f"{c}_fx": f"FIRST({x}, true) {w.run}", f"{c}_fi": f"FIRST({at}, true) {w.run}", f"{c}_n": f"COUNT({x}) {w.run}"}
    own = with_sql(own, state)
    later = {s.x: f"{_q(s.x)} IS NOT NULL AND {name[s.x]}_pi IS NOT NULL" for s in emas}
    own = with_sql(own, {f"_a{k}": f"CASE WHEN {later[s.x]} THEN {_factor(f'({IDX} - {name[s.x]}_pi)', s.alpha)} ELSE 1D END" if s.alpha < 1 else "1D"
                         for k, s in enumerate(emas)})
    own = _products(own, {f"_p{k}": F.col(f"_a{k}") for k in range(len(emas))} | {f"_r{k}": F.col(s.x) for k, s in enumerate(runs) if s.kind == "product"}, keys, BLK)
    gain = {f"_g{k}": f"_p{k} * SUM(CASE WHEN {later[s.x]} THEN _a{k} * ({_q(s.x)} - {name[s.x]}_px) / _p{k} ELSE 0D END) {w.run}" if s.alpha < 1 else "0D"
            for k, s in enumerate(emas)}
    per_x = [f"{c}_{f}" for c in name.values() for f in ("lx", "li", "fx", "fi", "n")]
    per_ema = [f"_{f}{k}" for k in range(len(emas)) for f in "pg"]
    per_run = [f"_r{k}" for k in range(len(runs))]
    done = materialize(with_sql(own, gain).select(*keep, BLK, "_end", *per_x, *per_ema, *per_run), "scan")

    ends = done.filter("_end").select(*keys, BLK, *per_x, *per_ema, *per_run)
    o = _Over(keys, order=BLK)
    carry = {f"_c{k}": f"{_RUNS[s.kind][0].format(f'_r{k}')} {o.before}" for k, s in enumerate(runs) if s.kind != "product"}
    for c in name.values():
        carry |= {f"{c}_cx": f"LAST({c}_lx, true) {o.before}", f"{c}_ci": f"LAST({c}_li, true) {o.before}", f"{c}_cn": f"COALESCE(SUM({c}_n) {o.before}, 0L)"}
    ends = with_sql(ends, carry)
    products = [k for k, s in enumerate(runs) if s.kind == "product"]
    ends = _products(ends, {f"_t{k}": F.col(f"_r{k}") for k in products}, keys, order=BLK)
    ends = with_sql(ends, {f"_c{k}": f"LAG(_t{k}) {o.row}" for k in products})
    first, whole, into_first = {}, {}, {}
    for k, s in enumerate(emas):
        c = name[s.x]
        known = f"{c}_ci IS NOT NULL AND {c}_n > 0"
        first |= {f"_f{k}": f"CASE WHEN {known} THEN {_factor(f'({c}_fi - {c}_ci)', s.alpha)} ELSE 0D END",
                  f"_j{k}": f"CASE WHEN {known} THEN {c}_fx - {c}_cx ELSE 0D END"}
        whole |= {f"_dec{k}": f"CASE WHEN {c}_n > 0 THEN _p{k} * _f{k} ELSE 1D END", f"_add{k}": f"CASE WHEN {c}_n > 0 THEN _g{k} + _p{k} * _f{k} * _j{k} ELSE 0D END"}
        into_first[f"_u{k}"] = f"_f{k} * (_in{k} + _j{k})"
    if emas:
        ends = _affine(with_sql(with_sql(ends, first), whole), keys, len(emas))
    into = [f"{c}_{f}" for c in name.values() for f in ("cx", "cn")] + [f"_in{k}" for k in range(len(emas))] + [f"_c{k}" for k in range(len(runs))]
    ends = materialize(with_sql(ends, into_first).select(*keys, BLK, *into, *into_first), "carry")

    both = done.join(ends, [*keys, BLK])  # small by its files: the planner broadcasts it up to its threshold
    result = {}
    for k, s in enumerate(runs):
        value = _RUNS[s.kind][1].format(c=f"_c{k}", r=f"_r{k}")
        result[s.out] = value if s.kind == "last" else f"CASE WHEN {_q(s.x)} IS NOT NULL THEN {value} END"
    for k, s in enumerate(emas):
        c = name[s.x]
        e = f"CASE WHEN {c}_n = 0 THEN _in{k} ELSE _g{k} + _p{k} * _u{k} END"
        counted = f"{c}_n + {c}_cn >= {max(1, s.min_periods)}"
        if s.out:
            result[s.out] = f"CASE WHEN {counted} THEN COALESCE({c}_lx, {c}_cx) - ({e}) END"
        if s.gap:
            result[s.gap] = f"CASE WHEN {counted} THEN {e} END"
    return with_blocks(both.selectExpr(*map(_q, keep), *[f"{x} AS {_q(out)}" for out, x in result.items()]), halo, rows)


def _affine(ends: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``_in{k}``: for each row of a small table ordered by block, the value
    before it of the recursion ``E = A + D E'`` from 0 on, with 0 <= D <= 1.

    Rows are grouped by the decay they add up to, ``DECAY`` a group, so that
    products inside a group can be divided by.  What lies two groups back has
    decayed by more than exp(-DECAY), three groups back by more than doubles
    hold, so the value is that of the whole recursion."""
    keys, each = list(keys), range(n)
    o = _Over(keys, order=BLK)
    inside = [_Over(keys, f"_grp{k}", order=BLK) for k in each]
    lost = "CASE WHEN _dec{k} > 0 THEN LEAST(-LN(_dec{k}), {most}D) ELSE {most}D END"
    ends = with_sql(ends, {f"_grp{k}": f"FLOOR(SUM({lost.format(k=k, most=2 * DECAY)}) {o.run} / {DECAY}D)" for k in each})
    ends = with_sql(ends, {**{f"_o{k}": f"COALESCE(LAG(_grp{k}) {o.row} != _grp{k}, true)" for k in each},
                           **{f"_z{k}": f"COALESCE(LEAD(_grp{k}) {o.row} != _grp{k}, true)" for k in each}})
    for k in each:
        ends = _products(ends, {f"_pro{k}": F.expr(f"CASE WHEN _o{k} THEN 1D ELSE _dec{k} END")}, keys, f"_grp{k}", order=BLK)
        ends = with_sql(ends, {f"_own{k}": f"_pro{k} * SUM(_add{k} / _pro{k}) {inside[k].run}", f"_tail{k}": f"_pro{k} * FIRST(_dec{k}) {inside[k].run}"})
    end = "COALESCE(LAST(CASE WHEN _z{k} THEN {c} END, true) {over}, 0D)"
    ends = with_sql(ends, {f"_near{k}": f"_own{k} + _tail{k} * {end.format(k=k, c=f'_own{k}', over=o.before)}" for k in each})
    ends = with_sql(ends, {f"_sum{k}": f"_own{k} + _tail{k} * {end.format(k=k, c=f'_near{k}', over=o.before)}" for k in each})
    return with_sql(ends, {f"_in{k}": f"COALESCE(LAG(_sum{k}) {o.row}, 0D)" for k in each})


def carry_scan(df: DataFrame, keys: Sequence[str], x: str, out: str, kind: str) -> DataFrame:
    """Running aggregate of column ``x`` over a blocked series (``Run``)."""
    return carry_scans(df, keys, [(x, out, kind)])


def carry_scans(df: DataFrame, keys: Sequence[str], specs, halo: int | None = None) -> DataFrame:
    """Several running aggregates ``(x, out, kind)`` in one scan."""
    return scan(df, keys, [Run(kind, x, out) for x, out, kind in specs], halo)


def ffill_scan(df: DataFrame, keys: Sequence[str], x: str, out: str, halo: int | None = None) -> DataFrame:
    """Forward fill (last non-null at or before the row) across blocks."""
    return scan(df, keys, [Run("last", x, out)], halo)


def ema_halo(alphas: Sequence[float], depth: int = 1, window: int = 0) -> int:
    """Halo rows that averages need: none, their history is carried; only the
    ``window`` rows of other frames count."""
    return window


def add_ema(df: DataFrame, keys: Sequence[str], x: str, out: str, alpha: float,
            min_periods: int = 0) -> DataFrame:
    """One recursive average (``Ema``)."""
    return add_emas(df, keys, [(x, out, alpha, min_periods)])


def add_emas(df: DataFrame, keys: Sequence[str], specs) -> DataFrame:
    """Several independent averages ``(x, out, alpha, min_periods)`` in one scan."""
    return scan(df, keys, [Ema(*s) for s in specs])
