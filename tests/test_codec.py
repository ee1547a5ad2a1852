from pyspark.sql import functions as F

from tickwise.sources import kafka as K


def test_decode_malformed_and_wrong_types(spark):
    rows = [('{"ticker":"AAPL","price":1.5,"timestamp":10,"source":"x"}',),
            ('{not json',),
            ('{"ticker":"MSFT","price":"abc","timestamp":11,"source":"y"}',)]
    frames = spark.createDataFrame(rows, "value string").select(F.col("value").cast("binary").alias("value"))
    out = K.decode_ticks(frames, keep_raw=True).collect()
    assert out[0]["ticker"] == "AAPL" and out[0]["price"] == 1.5
    assert all(out[1][c] is None for c in ("ticker", "price", "timestamp", "source"))
    assert out[2]["ticker"] == "MSFT" and out[2]["price"] is None and out[2]["timestamp"] == 11
    assert K.quarantine(K.decode_ticks(frames, keep_raw=True)).count() == 1


def test_roundtrip(spark):
    t = spark.createDataFrame([("A", 1.25, 100, "s")], "ticker string, price double, timestamp long, source string")
    back = K.decode_ticks(K.encode_ticks(t)).collect()[0]
    assert tuple(back) == ("A", 1.25, 100, "s")


def test_now_epoch_is_query_start_or_pinned(spark):
    import time

    from tickwise.functions.columns import now_epoch
    t0 = int(time.time())
    r = spark.range(3).select(now_epoch().alias("a"), now_epoch(1735689600).alias("b")).collect()
    assert len({x["a"] for x in r}) == 1 and t0 - 5 <= r[0]["a"] <= int(time.time()) + 5
    assert all(x["b"] == 1735689600 for x in r)
