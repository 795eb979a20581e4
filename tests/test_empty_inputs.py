"""Operators on empty inputs return empty results (no errors, no driver-side assumptions)."""

from pyspark.sql import functions as F

from sensorlake.operators import aggregates as ag
from sensorlake.operators import fibre as fb
from sensorlake.operators import intervals as iv
from sensorlake.operators import islands as isl
from sensorlake.operators import resample
from sensorlake.operators import windows as wn
from sensorlake.plans import rules as ru


def _empty(spark):
    return spark.createDataFrame([], "asset_id long, parameter string, epoch long, value double, k int")


def test_empty_series_operators(spark):
    r = _empty(spark)
    assert isl.islands(r, ["asset_id"], "epoch", 5).count() == 0
    assert wn.forward_average(r, ["asset_id"], "epoch", "value", 60).count() == 0
    assert wn.trailing_zscore(r, ["asset_id"], "epoch", "value", 60).count() == 0
    assert wn.moving_average(r, ["asset_id"], "epoch", "value", 3).count() == 0
    assert wn.exp_smooth(r, ["asset_id"], "epoch", "value", 0.3).count() == 0
    assert wn.equal_count_buckets(r, ["asset_id"], "epoch", 4).count() == 0
    assert resample.summarize(r, ["asset_id"], "epoch", ["value"], 3600, calendar=(0, 7200)).count() == 0
    assert ag.array_average(spark.createDataFrame([], "k int, a array<double>"), ["k"], "a").count() == 0


def test_empty_rules_and_intervals(spark):
    r = _empty(spark)
    cond = spark.createDataFrame([(1, 1, "p", "raw", ">", 1.0, 0, 5, "or")],
                                 "rule_id int, condition_id int, parameter string, function string, operator string, "
                                 "threshold double, duration long, data_frequency long, join_condition string")
    for f in ru.CONDITION_SCHEMA.fields:
        if f.name not in cond.columns:
            cond = cond.withColumn(f.name, F.lit(None).cast(f.dataType))
    cond = cond.withColumn("start_time", F.lit(0).cast("long")).withColumn("end_time", F.lit(100).cast("long"))
    assert ru.evaluate(r, cond).count() == 0
    e = spark.createDataFrame([], "k int, ls long, le long")
    e2 = spark.createDataFrame([], "k int, rs long, re long")
    assert iv.overlap_join(e, e2, ["k"], "ls", "le", "rs", "re").count() == 0
    f = spark.createDataFrame([], "asset_id string, depth int, timestamp long, value double")
    assert fb.matrix_product(f, ["asset_id"], "timestamp", "depth", "value", 4).count() == 0
