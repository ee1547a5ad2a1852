"""Plan shape: filters and columns reach the scan, no Python in the hot
path, windows of one frame share one exchange."""

from helpers import SF_MID, SF_SMALL
from tickwise.operators import indicators as I
from tickwise.operators import medallion as M
from tickwise.operators.zones import drop_missing
from tickwise.sources.fixtures import load_bars, load_ticks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_scan_reads_only_needed_columns(spark):
    p = plan(load_bars(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan and all("l_tax" not in s and "l_comment" not in s for s in scan)


def test_not_null_filter_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    M.windowed_features(load_ticks(spark, SF_SMALL)).write.parquet(path)
    from tickwise.sources.lake import read_silver
    p = plan(M.gold_features(read_silver(spark, path)))
    assert "PushedFilters: [IsNotNull(SMA), IsNotNull(volatility)]" in p


def jobs(monkeypatch, build):
    """The plans of the tables that building a query writes, and its own."""
    from tickwise import catalog
    from tickwise.plans import materialize as M
    from tickwise.plans import series as S
    plans, write = [], M.materialize

    def seen(df, name="t"):
        plans.append((name, plan(df)))
        return write(df, name)
    monkeypatch.setattr(S, "materialize", seen)
    monkeypatch.setattr(catalog, "materialize", seen)
    result = plan(build())
    return [*plans, ("result", result)]


def size(p):
    return {"scans": p.count("FileScan parquet"), "exchanges": p.count("Exchange hashpartitioning"), "sorts": p.count("Sort ["), "joins": p.count("Join ")}


def test_panel_has_no_python_and_one_block_exchange(spark, bars_small, monkeypatch):
    for name, p in jobs(monkeypatch, lambda: I.technical_panel(bars_small)):
        assert "EvalPython" not in p and "InArrow" not in p and "InPandas" not in p
        blk = [line for line in p.splitlines() if "Exchange hashpartitioning(ticker" in line and "_blk" in line]
        assert len(blk) <= (1 if name == "scan" else 0), (name, blk)


def test_headline_plans_are_small(spark, monkeypatch):
    """Every query walks the ticks once; each scan reads what the one before
    has written once, and the carries are broadcast."""
    from tickwise.catalog import QUERIES
    for name, scans in (("technical_panel", 2), ("chart_indicators", 2), ("leaderboard", 2), ("backtest_curves", 3), ("drawdown", 1)):
        found = jobs(monkeypatch, lambda: QUERIES[name](spark, SF_MID))
        assert [n for n, _ in found] == ["scan", "carry"] * scans + ["result"]
        monkeypatch.undo()
        own = [size(p) for n, p in found if n == "scan"]
        assert own[0]["scans"] == 1 and own[0]["exchanges"] <= 4 and own[0]["sorts"] <= 4 and own[0]["joins"] == 0, own
        for later in own[1:]:  # the table before and its carry
            assert later["scans"] == 2 and later["exchanges"] == 1 and later["sorts"] == 1, own
        assert "lineitem" not in found[-1][1] and found[-1][1].count("SortMergeJoin") == 0
        total = [size(p) for _, p in found]
        assert sum(t["exchanges"] for t in total) <= 4 + 2 * scans + 2 and sum("lineitem" in p for _, p in found) == 1, name


def test_rolling_frames_cost_the_same_for_any_length(spark, bars_small):
    """No frame of n rows is added up again for every row."""
    from tickwise.plans import series as S
    for n in (20, 2000):
        f = S.add_rolling(I.prepare(bars_small, n), ["ticker"], [S.Rolling("close", n, "m", "s")])
        p = plan(I.finish(f))
        assert f"-{n - 1}, currentrow" not in p and f"RowFrame, -{n}" not in p.replace(f"RowFrame, -{n}, -{n}", "")


def test_bar_ranges_list_only_the_folders_asked_for(spark, tmp_path):
    from tickwise.sources.lake import BarStore
    store = BarStore(str(tmp_path / "bars"), buckets=4).write(load_bars(spark, SF_MID))

    def files(df):
        df.collect()
        p = df._jdf.queryExecution().executedPlan()
        text = p.toString()
        leaf = p.collectLeaves().head()
        if "AdaptiveSparkPlan" in text:
            leaf = p.finalPhysicalPlan().collectLeaves().head()
            leaf = leaf if "QueryStage" not in leaf.getClass().getSimpleName() else leaf.plan().collectLeaves().head()
        return text, leaf

    every = store.read(spark).select("month", "bucket").distinct().count()
    two = store.load_range(spark, ["AF"], "1997-01-10", "1997-03-01")
    text, leaf = files(two)
    assert "PartitionFilters: [" in text and "month" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in text.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(d,1997-01-10)" in text
    assert leaf.metrics().apply("numFiles").value() <= 2 < every
    # a lookback waits for the last date, a request table for its buckets
    text, _ = files(store.load_period(spark, None, "1mo"))
    filters = lambda text: [x.split("PushedFilters")[0].lower() for x in text.split("PartitionFilters: [")[1:]]
    assert any("month" in x and "subquery" in x for x in filters(text))
    asked = spark.createDataFrame([("AF",), ("zz",), ("",), (None,), ("AF",)], "symbol string")
    some = store.load_range(spark, asked)
    text, _ = files(some)
    assert any("dynamicpruning" in x for x in filters(text))
    assert {r.ticker for r in some.collect()} == {"AF"}


def test_request_table_of_many_rows(spark, tmp_path):
    from tickwise.sources.lake import BarStore
    bars = load_bars(spark, SF_SMALL)
    store = BarStore(str(tmp_path / "bars"), buckets=4).write(bars)
    asked = spark.range(100_000).selectExpr("CASE WHEN id % 5000 = 7 THEN 'NO' ELSE concat('X', id) END AS symbol")
    assert store.load_range(spark, asked).count() == bars.filter("ticker = 'NO'").count() > 0


def test_drop_missing_removes_nan(spark):
    df = spark.createDataFrame([("A", float("nan"), 1.0), ("A", 1.0, 1.0), ("A", None, 1.0)],
                               "ticker string, SMA double, volatility double")
    assert drop_missing(df, ["SMA", "volatility"]).count() == 1


def test_the_ticks_are_read_once(spark):
    from tickwise.catalog import QUERIES
    assert "events" not in plan(QUERIES["silver_rows"](spark, SF_SMALL))
    # not the cached bars of the fixtures
    p = plan(load_bars(spark, SF_MID))
    assert "InMemoryTableScan" not in p and p.count("FileScan parquet") == 1 and "SortAggregate" not in p


def test_no_shared_folder_no_work():
    from tickwise.session import checkpoint_dir

    class Conf(dict):
        def get(self, k, d=None):
            return d

    class Remote:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn", "getConf": staticmethod(lambda: Conf())})()

    import pytest
    with pytest.raises(ValueError):
        checkpoint_dir(Remote())
