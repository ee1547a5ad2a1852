"""Streaming silver: watermark, late data, dedup across micro-batches and
restart from the checkpoint (file source + availableNow)."""

from tickwise.schemas import TICK
from tickwise.sources import lake
from tickwise.streaming import medallion as SM


def _write(spark, path, rows):
    spark.createDataFrame(rows, TICK).coalesce(1).write.mode("append").parquet(path)


def _silver(spark, root):
    bronze = lake.read_bronze(spark, f"{root}/bronze", stream=True, max_files_per_trigger=1)
    SM.run_available(SM.silver_stream(bronze, "1 minute", "30 seconds", "2 minutes"),
                     f"{root}/silver", f"{root}/ck")
    return lake.read_silver(spark, f"{root}/silver")


def test_late_rows_dropped_duplicates_removed_restart(spark, tmp_path):
    root = str(tmp_path)
    t0 = 1_700_000_000 - 1_700_000_000 % 60
    # batch 1: ticks at t0 .. t0+600 for A
    _write(spark, f"{root}/bronze", [("A", 10.0 + i, t0 + 60 * i, "s") for i in range(11)])
    out1 = _silver(spark, root)
    n1 = out1.count()
    assert n1 > 0
    # everything emitted so far ends at or before the watermark t0+600-120
    assert out1.selectExpr("max(unix_seconds(window_end))").first()[0] <= t0 + 600 - 120
    # batch 2 (restart from the same checkpoint): one late tick (far behind the
    # watermark), one duplicate of an already seen key, and new ticks
    _write(spark, f"{root}/bronze", [("A", 999.0, t0 + 5, "late"), ("A", 555.0, t0 + 600, "dup")]
           + [("A", 30.0 + i, t0 + 660 + 60 * i, "s") for i in range(5)])
    out2 = _silver(spark, root).toPandas()
    assert len(out2) > n1                        # restart resumed and appended
    assert (out2["SMA"] < 500).all()             # late 999 and duplicate 555 never counted
    # no window emitted twice across restarts
    assert not out2.duplicated(["ticker", "window_start"]).any()


def test_gold_stream_recomputes(spark, tmp_path):
    root = str(tmp_path)
    t0 = 1_700_000_040
    _write(spark, f"{root}/bronze", [("A", float(i % 5), t0 + 20 * i, "s") for i in range(60)])
    _silver(spark, root)
    SM.run_gold(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckg")
    g = lake.read_gold(spark, f"{root}/gold").collect()
    assert len(g) == 1 and g[0]["ticker"] == "A" and g[0]["avg_volatility"] > 0


def test_gold_state_across_restarts_equals_full_recompute(spark, tmp_path):
    """Gold keeps per-ticker sums in the state store: after two silver
    appends and two gold runs (restart from the checkpoint) it equals the
    batch means over the whole silver table."""
    from tickwise.operators.medallion import gold_features
    root = str(tmp_path)
    t0 = 1_700_000_040
    _write(spark, f"{root}/bronze", [(t, float(i % 7) + k, t0 + 20 * i, "s")
                                     for k, t in enumerate("AB") for i in range(60)])
    _silver(spark, root)
    SM.run_gold(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckg")
    _write(spark, f"{root}/bronze", [(t, float(i % 3) + k, t0 + 1200 + 20 * i, "s")
                                     for k, t in enumerate("AB") for i in range(60)])
    silver = _silver(spark, root)
    SM.run_gold(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckg")
    got = {r["ticker"]: r for r in lake.read_gold(spark, f"{root}/gold").collect()}
    exp = {r["ticker"]: r for r in gold_features(silver).collect()}
    assert set(got) == set(exp) == {"A", "B"}
    for t in exp:
        assert abs(got[t]["avg_SMA"] - exp[t]["avg_SMA"]) < 1e-9
        assert abs(got[t]["avg_volatility"] - exp[t]["avg_volatility"]) < 1e-9


def test_stream_keeps_the_survivor_of_batch(spark, tmp_path):
    """Duplicates inside one micro-batch, in any order: the smallest (price,
    source) stays, as in batch."""
    from tickwise.operators.medallion import dedup_ticks, windowed_features
    root = str(tmp_path)
    t0 = 1_700_000_040
    rows = [(t, float((7 * i) % 11 + k), t0 + 20 * (i // 3), f"s{(i * k) % 4}") for k, t in enumerate("AB") for i in range(90)]
    _write(spark, f"{root}/bronze", rows[::-1])
    _write(spark, f"{root}/bronze", [("A", 1.0, t0 + 4000, "s")])
    got = {(r.ticker, r.window_start): (r.SMA, r.volatility) for r in _silver(spark, root).collect()}
    batch = windowed_features(dedup_ticks(spark.createDataFrame(rows, TICK)), "1 minute", "30 seconds")
    want = {(r.ticker, r.window_start): (r.SMA, r.volatility) for r in batch.collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-12 for k in want)


def test_windows_with_a_slide_below_a_second(spark, tmp_path):
    """A tick falls into the same windows as in batch."""
    from tickwise.operators.medallion import windowed_features
    root, rows = str(tmp_path), [("A", float(i), 1_700_000_000 + i, "s") for i in range(20)]
    _write(spark, f"{root}/bronze", rows)
    _write(spark, f"{root}/bronze", [("A", 1.0, 1_700_009_000, "s")])
    bronze = lake.read_bronze(spark, f"{root}/bronze", stream=True)
    SM.run_available(SM.silver_stream(bronze, "1 second", "500 milliseconds"), f"{root}/silver", f"{root}/ck")
    got = {(r.window_start, r.SMA) for r in lake.read_silver(spark, f"{root}/silver").collect()}
    want = {(r.window_start, r.SMA) for r in windowed_features(spark.createDataFrame(rows, TICK), "1 second", "500 milliseconds").collect()}
    assert got == want and len(got) == 40


def test_versions_are_whole_and_few(spark, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"), keep=2)
    frame = lambda *rows: spark.createDataFrame(rows, "ticker string, avg_SMA double, avg_volatility double")
    assert t.read() is None
    t.upsert(frame(("A", 1.0, 1.0), ("B", 1.0, 1.0)), 3, "ticker")
    held = t.read()
    t.upsert(frame(("A", 2.0, 2.0)), 4, "ticker")
    t.upsert(frame(("A", 2.0, 2.0)), 4, "ticker")  # replayed
    assert sorted(map(tuple, t.read().collect())) == [("A", 2.0, 2.0), ("B", 1.0, 1.0)]
    assert len(held.collect()) == 2  # a reader of the version before is not disturbed
    # a version without its commit marker isn't read
    (tmp_path / "t" / "v-000000000009").mkdir()
    assert t.versions() == [3, 4]
    t.upsert(frame(("C", 3.0, 3.0)), 10, "ticker")
    assert t.versions() == [4, 10] and t.read().count() == 3


def _frames(spark, path, rows):
    import json
    text = [r if isinstance(r, str) else json.dumps(dict(zip(("ticker", "price", "timestamp", "source"), r))) for r in rows]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.mode("append").text(path)


def test_live_medallion_and_every_row_accounted_for(spark, tmp_path):
    """Input arrives after the start; gold is refreshed by its interval and a
    reader in between sees a whole table; rows in = kept + late + repeated +
    malformed."""
    from pyspark.sql import functions as F

    from tickwise.operators.medallion import dedup_ticks, gold_features, windowed_features
    root, t0 = str(tmp_path), 1_700_000_040
    (tmp_path / "frames").mkdir()
    frames = spark.readStream.text(f"{root}/frames").select(F.col("value").cast("binary").alias("value"))
    run = SM.Medallion(frames, root, "1 minute", "1 minute", "2 minutes", interval="200 milliseconds")
    try:
        first = [(t, float(i % 7), t0 + 20 * i, "s") for t in "AB" for i in range(60)]
        _frames(spark, f"{root}/frames", [*first, first[5], first[5], "no json", '{"price": 1.0}'])
        run.drain()
        early = run.gold()
        before = sorted(map(tuple, early.collect()))
        assert [r[0] for r in before] == ["A", "B"]
        second = [("A", 3.0, t0 + 1200 + 20 * i, "s") for i in range(60)]
        late = [("A", 9e9, t0 + 5, "s"), ("B", 9e9, t0 + 6, "s"), ("B", 9e9, t0 + 6, "s")]
        _frames(spark, f"{root}/frames", [*second, *late])
        run.drain()
        assert sorted(map(tuple, early.collect())) == before
        counts, gold = run.counts(), {r.ticker: r for r in run.gold().collect()}
    finally:
        run.stop()
    assert (counts.rows, counts.malformed, counts.late, counts.repeated) == (len(first) + 4 + 63, 2, 3, 2)
    kept = [*first, *second]
    assert counts.kept == len(kept)
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    end = max(r[2] for r in kept) - 120
    silver = windowed_features(dedup_ticks(spark.createDataFrame(kept, TICK)), "1 minute", "1 minute").filter(F.unix_seconds("window_end") <= end)
    assert lake.read_silver(spark, f"{root}/silver").count() == silver.count()
    for r in gold_features(silver).collect():
        assert abs(gold[r.ticker].avg_SMA - r.avg_SMA) < 1e-12
