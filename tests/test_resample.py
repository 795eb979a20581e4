from pyspark.sql import functions as F

from sensorlake.operators import resample


def _long(df):
    return {(r.parameter, r.bucket_start): (r.timestamp, r.value) for r in df.collect()}


def test_hourly_gold_fixture(spark):
    df = spark.createDataFrame([("DTS_01", 100, 1769904000 + 12, 25.5)], "asset_id string, depth int, timestamp long, temperature double")
    g = _long(resample.summarize(df, ["asset_id", "depth"], "timestamp", ["temperature"], 3600))
    b = 1769904000
    assert g[("temperature_count", b)] == (b, 1.0)
    assert g[("temperature_sum", b)] == (b, 25.5)
    assert g[("temperature_min", b)][1] == g[("temperature_max", b)][1] == 25.5


def test_empty_bucket_keeps_only_count(spark):
    df = spark.createDataFrame([("A", 10, 1.0)], "asset_id string, t long, v double")
    assert [r.bucket_start for r in resample.bucket_calendar(spark, 0, 7199, 3600).collect()] == [0, 3600]
    g = _long(resample.summarize(df, ["asset_id"], "t", ["v"], 3600, calendar=(0, 7199)))
    assert g[("v_count", 3600)] == (3600, 0.0)
    assert ("v_sum", 3600) not in g and ("v_min", 3600) not in g and ("v_max", 3600) not in g


def test_tie_of_extremes(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 3, 5.0)], "asset_id string, t long, v double")
    g = _long(resample.summarize(df, ["asset_id"], "t", ["v"], 3600))
    assert g[("v_min", 0)][0] == 1 and g[("v_max", 0)][0] == 3


def test_counts_sum_to_input(spark):
    df = spark.range(0, 10_000).select(F.lit("A").alias("asset_id"), (F.col("id") * 7).alias("t"),
                                       (F.col("id") % 13).cast("double").alias("v"))
    g = resample.summarize(df, ["asset_id"], "t", ["v"], 3600)
    total = g.filter(F.col("parameter") == "v_count").agg(F.sum("value")).collect()[0][0]
    assert total == 10_000


def test_refresh_twice_equals_once(spark):
    df = spark.range(0, 2000).select(F.lit("A").alias("asset_id"), (F.col("id") * 60).alias("t"),
                                     (F.col("id") % 17).cast("double").alias("v"))
    gold = resample.summarize(df.filter("t < 60000"), ["asset_id"], "t", ["v"], 3600).drop("bucket_start")
    new = resample.summarize(df.filter("t >= 28800"), ["asset_id"], "t", ["v"], 3600).drop("bucket_start")
    once = resample.refresh_gold(gold, new, ["asset_id"], 3600)
    twice = resample.refresh_gold(once.drop("bucket_start"), new, ["asset_id"], 3600)
    a = sorted(map(tuple, once.select("parameter", "bucket_start", "timestamp", "value").collect()))
    b = sorted(map(tuple, twice.select("parameter", "bucket_start", "timestamp", "value").collect()))
    assert a == b
    full = resample.summarize(df, ["asset_id"], "t", ["v"], 3600)
    c = sorted(map(tuple, full.select("parameter", "bucket_start", "timestamp", "value").collect()))
    assert a == c


def test_wide_summary(spark):
    df = spark.createDataFrame([("A", 10, 1.0), ("A", 20, 3.0), ("A", 90000, 2.0)], "asset_id string, t long, v double")
    w = {r.epoch_timestamp: r for r in resample.summarize_wide(df, ["asset_id"], "t", ["v"], "day").collect()}
    assert w[0].min_v == 1.0 and w[0].min_v_epoch_timestamp == 10 and w[0].max_v_epoch_timestamp == 20
    assert w[86400].max_v == 2.0


def test_gauge_summary_eight_parameters(spark):
    df = spark.createDataFrame([("G1", 10, 2000.0, 50.0), ("G1", 20, 2005.0, 49.0)],
                               "asset_id string, epoch long, pressure double, temperature double")
    g = resample.summarize(df, ["asset_id"], "epoch", ["pressure", "temperature"], 3600)
    params = sorted(r.parameter for r in g.collect())
    assert len(params) == 8 and params[0] == "pressure_count" and params[-1] == "temperature_sum"


def test_gold_products_rollup_equals_direct(spark):
    df = spark.range(0, 5000).select(F.lit("A").alias("asset_id"), (F.col("id") * 7).alias("t"),
                                     ((F.col("id") * 37) % 101).cast("double").alias("v"))
    got = resample.gold_products(df, ["asset_id"], "t", ["v"], sizes=(60, 3600, 90))
    for size in (60, 3600, 90):
        direct = resample.summarize(df, ["asset_id"], "t", ["v"], size)
        a = sorted((r.parameter, r.bucket_start, r.timestamp, round(r.value, 6))
                   for r in got.filter(F.col("bucket_size") == size).collect())
        b = sorted((r.parameter, r.bucket_start, r.timestamp, round(r.value, 6)) for r in direct.collect())
        assert a == b, size
