import pytest
from pyspark.sql import functions as F

from sensorlake.operators import model as ml
from sensorlake.operators import reconcile as rc


def test_linear_fit_and_spark_ml(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2.0) for x in range(20)], "x double, y double")
    r = ml.linear_fit(df, "x", "y").collect()[0]
    assert r.slope == pytest.approx(3.0) and r.intercept == pytest.approx(2.0)
    train, test = ml.split(df, 2 / 3)
    model, va = ml.fit_linear_regression(train, ["x"], "y")
    assert model.coefficients[0] == pytest.approx(3.0, rel=1e-6)


def test_prepare_features(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "x double, c string")
    m = ml.prepare_features(df, ["x"], ["c"])
    out = m.transform(df).select("features").collect()
    assert len(out) == 3


def test_predict_and_long(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    coef = spark.createDataFrame([("a", 2.0), ("b", -1.0), ("__intercept__", 0.5)], "feature string, coef double")
    assert ml.predict_wide(df, coef).collect()[0].predicted == pytest.approx(1.5)
    wide = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0)], "t int, x__raw double, x__filtered double, y__raw double, y__filtered double")
    long = ml.to_long(wide, ["t"], ["x", "y"], ["raw", "filtered"]).collect()
    assert sorted((r.variable, r.raw, r.filtered) for r in long) == [("x", 1.0, 2.0), ("y", 3.0, 4.0)]


def test_preprocess_chain(spark):
    rows = [("s", t, 10.0 if t != 600 else 999.0) for t in range(0, 3600, 30)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    out = {r.t: r for r in ml.preprocess(df, ["k"], "t", "v", 0.0, 100.0).collect()}
    assert out[600].in_range is False and out[600].modified == 10.0
    assert out[3540].filtered == pytest.approx(10.0)


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    b = spark.createDataFrame([(2,), (None,)], "id int")
    assert sorted(r.id for r in rc.missing_ids(a, b, "id").collect()) == [1, 3]
    feats = spark.createDataFrame([(1, "X-FUS-1", "jointType", "Optical"), (2, "X-ABC-2", "jointType", "Optical")],
                                  "id int, name string, attribute string, value string")
    rules = spark.createDataFrame([("-FUS-", "jointType", "Electrical")], "pattern string, attribute string, expected string")
    v = rc.attribute_violations(feats, rules, "id", "name").collect()
    assert [(r.id, r.actual, r.expected) for r in v] == [(1, "Optical", "Electrical")]
    fixed = rc.correct(feats, [(F.col("name").contains("-FUS-"), "value", F.lit("Electrical"))]).collect()
    assert {r.id: (r.value, r.corrected) for r in fixed} == {1: ("Electrical", True), 2: ("Optical", False)}
    cls = {r.id: r.cable_class for r in rc.split_by_pattern(feats, "name", {"fus": "-FUS-"}).collect()}
    assert cls == {1: "fus", 2: "other"}
