from pyspark.sql import functions as F

from sensorlake.functions.scalars import compare, pct_change
from sensorlake.operators import fibre as fb
from sensorlake.plans import combine, lifecycle
from sensorlake.plans import rules as ru


def _cond(spark, rows):
    df = spark.createDataFrame(rows, "rule_id int, condition_id int, asset_id long, parameter string, function string, "
                                     "operator string, threshold double, duration long, data_frequency long, "
                                     "join_condition string")
    for f in ru.CONDITION_SCHEMA.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.withColumn("start_time", F.lit(0).cast("long")).withColumn("end_time", F.lit(1000).cast("long"))


def test_zero_baseline_gives_no_hit(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 5.0)], "b double, c double")
    out = df.select(pct_change("c", "b").alias("p")).collect()
    assert out[0].p is None and out[1].p == 150.0


def test_compare_column_operator(spark):
    df = spark.createDataFrame([(5.0, ">", 3.0), (5.0, "<=", 3.0), (3.0, "==", 3.0), (1.0, "??", 0.0)],
                               "v double, op string, t double")
    assert [r.h for r in df.select(compare("v", F.col("op"), F.col("t")).alias("h")).collect()] == [True, False, True, None]


def test_evaluate_or_and(spark):
    readings = spark.createDataFrame(
        [(1, "p", t, 10.0) for t in range(100, 200, 5)] + [(1, "q", t, 10.0) for t in range(150, 260, 5)]
        + [(2, "p", t, 10.0) for t in range(100, 120, 5)],
        "asset_id long, parameter string, epoch long, value double").withColumn("k", F.lit(None).cast("int"))
    cond = _cond(spark, [(1, 1, None, "p", "raw", ">", 5.0, 0, 5, "or"),
                         (2, 1, None, "p", "raw", ">", 5.0, 0, 5, "and"),
                         (2, 2, None, "q", "raw", ">", 5.0, 0, 5, "and")])
    got = sorted((r.rule_id, r.asset_id, r.start_time, r.end_time) for r in ru.evaluate(readings, cond).collect())
    assert (1, 1, 100, 195) in got and (1, 2, 100, 115) in got
    assert (2, 1, 150, 195) in got and not any(r[0] == 2 and r[1] == 2 for r in got)


def test_combinations_or_and(spark):
    orr = spark.createDataFrame([(1, 1, "A"), (1, 1, "B"), (1, 2, "A"), (1, 2, "B")],
                                "rule_id int, condition_id int, asset_id string")
    assert combine.combination_count(orr).collect()[0].combinations == 4
    andr = spark.createDataFrame([(2, 1, "A"), (2, 2, "B")], "rule_id int, condition_id int, asset_id string")
    assert combine.combination_count(andr).collect()[0].combinations == 1


def test_rule_cdc(spark):
    existing = spark.createDataFrame([(1, "a", "create"), (2, "b", "create"), (3, "c", "create")],
                                     "rule_id int, rule_name string, operation string")
    incoming = spark.createDataFrame(
        [(1, "a2", "update", "f1"), (2, "x", "update", "f1"), (2, "b", "delete", "f2"), (3, "c9", "create", "f1"),
         (4, "d", "create", "f1")], "rule_id int, rule_name string, operation string, file_name string")
    out = {r.rule_id: r.rule_name for r in lifecycle.apply_rule_changes(existing, incoming).collect()}
    assert out == {1: "a2", 3: "c", 4: "d"}


def test_window_start_fixture(spark):
    r = spark.range(1).select(fb.window_start(F.lit(1609459200), 3600).alias("c"),
                              fb.window_start(F.lit(1609459200), 3600, previous=True).alias("p")).collect()[0]
    assert (r.c, r.p) == (1609459200, 1609455600)


def test_execution_window(spark):
    rules = spark.createDataFrame([(1, 900, 0, 10_000, 10_000 + 3600)],
                                  "rule_id int, rule_run_frequency int, delay int, last_run_time long, max_bronze_time long")
    r = lifecycle.execution_window(rules, 1800, 7200, now=0).collect()[0]
    # last = 10000, g = 2, t = 10000, m = 10000 % 900 = 100
    assert r.end_time == 10000 - 100 + 3600 and r.start_time == 10000 - 1800 - ((10000 - 1800) % 900)
    assert r.next_run_time == 10000 + 3600 + 1800


def test_rule_plan_has_no_nested_loop(spark):
    readings = spark.createDataFrame([(1, "p", 1, 1.0, 0)], "asset_id long, parameter string, epoch long, value double, k int")
    cond = _cond(spark, [(1, 1, None, "p", "raw", ">", 0.0, 0, 5, "and"), (1, 2, None, "p", "avg", ">", 0.0, 10, 5, "and")])
    plan = ru.evaluate(readings, cond)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def _readings(spark, rows):
    return spark.createDataFrame(rows, "asset_id long, parameter string, epoch long, value double, k int")


def test_and_rule_over_explicit_assets(spark):
    rows = [(1, "p", t, 10.0, None) for t in range(100, 200, 5)] + [(2, "p", t, 10.0, None) for t in range(150, 260, 5)]
    cond = _cond(spark, [(7, 1, 1, "p", "raw", ">", 5.0, 0, 5, "and"), (7, 1, 2, "p", "raw", ">", 5.0, 0, 5, "and")])
    got = [(r.rule_id, r.asset_id, r.start_time, r.end_time) for r in ru.evaluate(_readings(spark, rows), cond).collect()]
    assert got == [(7, None, 150, 195)]


def test_count_rule_and_over_assets(spark):
    # grid of 100 s from 0: asset 1 has events in cells 0 and 1, asset 2 only in cell 1
    rows = [(1, "e", 10, 1.0, None), (1, "e", 150, 1.0, None), (2, "e", 160, 1.0, None)]
    cond = _cond(spark, [(8, 1, 1, "e", "count", ">=", 1.0, 100, 5, "and"),
                         (8, 1, 2, "e", "count", ">=", 1.0, 100, 5, "and")])
    got = [(r.rule_id, r.start_time, r.end_time) for r in ru.evaluate(_readings(spark, rows), cond).collect()]
    assert got == [(8, 100, 200)]


def test_wildcard_differential_and_zero_baseline(spark):
    rows = [(1, "p", 0, 10.0, None), (1, "p", 10, 30.0, None), (1, "p", 20, 10.5, None),
            (2, "p", 0, 0.0, None), (2, "p", 10, 5.0, None)]
    cond = _cond(spark, [(9, 1, None, "p", "differential", ">", 50.0, 0, 5, "or")]) \
        .withColumn("baseline_time", F.lit(0).cast("long")).withColumn("threshold_unit", F.lit("%"))
    got = sorted((r.asset_id, r.start_time, r.end_time) for r in ru.evaluate(_readings(spark, rows), cond).collect())
    assert got == [(1, 10, 10)]  # asset 2: zero baseline -> no hit, no error


def test_one_plan_equals_rule_by_rule(spark):
    """RU10: all rule kinds evaluated together give the union of evaluating each rule alone."""
    import random
    rnd = random.Random(2)
    rows = []
    for a in (1, 2):
        for p in ("p", "q"):
            t = 0
            for _ in range(200):
                t += rnd.choice([1, 2, 5])
                rows.append((a, p, t, float(rnd.randint(0, 20)), rnd.randint(0, 3)))
    readings = _readings(spark, rows)
    spec = [(1, 1, None, "p", "raw", ">", 15.0, 5, 3, "or"),
            (2, 1, None, "q", "avg", ">", 10.0, 20, 3, "or"),
            (3, 1, None, "p", "zscore", ">", 1.5, 30, 3, "or"),
            (4, 1, None, "q", "magnitude", ">=", 19.0, 0, 3, "or"),
            (5, 1, None, "p", "count", ">=", 3.0, 50, 3, "or"),
            (6, 1, None, "p", "raw", ">", 10.0, 0, 3, "and"),
            (6, 2, None, "q", "raw", ">", 10.0, 0, 3, "and"),
            (7, 1, 1, "p", "count", ">=", 2.0, 40, 3, "and"),
            (7, 1, 2, "p", "count", ">=", 2.0, 40, 3, "and")]
    cond = _cond(spark, spec).withColumn("end_time", F.lit(900).cast("long"))
    together = sorted(tuple(r) for r in ru.evaluate(readings, cond).collect())
    alone = []
    for rid in sorted({s[0] for s in spec}):
        alone += [tuple(r) for r in ru.evaluate(readings, cond.filter(F.col("rule_id") == rid)).collect()]
    assert together == sorted(alone) and len(together) > 0


def test_magnitude_and_needs_every_member_at_the_time(spark):
    """Two readings of one condition are not two members; one more reading does not lose a time."""
    cond = _cond(spark, [(5, 1, None, "p", "magnitude", ">", 1.0, 0, 5, "and"), (5, 2, None, "q", "magnitude", ">", 1.0, 0, 5, "and")])
    one = _readings(spark, [(1, "p", 100, 5.0, None), (1, "p", 100, 6.0, None)])
    assert ru.evaluate(one, cond).count() == 0
    both = _readings(spark, [(1, "p", 100, 5.0, None), (1, "p", 100, 6.0, None), (1, "q", 100, 5.0, None)])
    assert [(r.start_time, r.end_time) for r in ru.evaluate(both, cond).collect()] == [(100, 100)]


def test_magnitude_by_arrival(spark):
    """A late reading counts in the run it arrives in."""
    cond = _cond(spark, [(5, 1, None, "p", "magnitude", ">", 1.0, 0, 5, "or")])
    r = _readings(spark, [(1, "p", -50, 5.0, None), (1, "p", 60, 5.0, None)]).withColumn(
        "arrival", F.when(F.col("epoch") < 0, 10).otherwise(5000).cast("long"))
    assert [x.start_time for x in ru.evaluate(r, cond).collect()] == [-50]


def test_sensor_type_joins_only_its_readings(spark):
    cond = _cond(spark, [(5, 1, None, "p", "raw", ">", 1.0, 0, 5, "or")]).withColumn("sensor_type", F.lit("gauge"))
    r = _readings(spark, [(1, "p", 10, 5.0, None), (2, "p", 10, 5.0, None)]).withColumn(
        "sensor_type", F.when(F.col("asset_id") == 1, "gauge").otherwise("flow"))
    assert [x.asset_id for x in ru.evaluate(r, cond).collect()] == [1]


def test_dispatch_names_and_errors(spark):
    rows = [(1, "pressure", " Average ", ">"), (2, "no_of_events", "raw", ">"), (3, "magnitude", None, ">"),
            (4, "dts", "maximum", ">"), (5, "axial_strain", "differential over a baseline value", "<"),
            (6, "pressure", "maximum", ">"), (7, "pressure", "median", ">"), (8, "colour", "raw", ">"), (9, "pressure", "raw", "~")]
    c = spark.createDataFrame(rows, "rule_id int, parameter string, function string, operator string")
    good, errors = ru.dispatch(c)
    assert {r.rule_id: (r.function, r.parameter) for r in good.collect()} == {
        1: ("avg", "pressure"), 2: ("count", "no_of_events"), 3: ("magnitude", "magnitude"), 4: ("fibre_max", "curr_temp"),
        5: ("fibre_differential", "axial_strain_thermal")}
    assert {r.rule_id: r.error for r in errors.collect()} == {
        6: "function not available for parameter", 7: "unknown function", 8: "unknown parameter", 9: "unknown operator"}


def test_unknown_kind_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        ru.evaluate(_readings(spark, [(1, "p", 1, 1.0, None)]), _cond(spark, [(1, 1, None, "p", "average", ">", 0.0, 0, 5, "or")]))


def test_window_work_does_not_grow_with_the_rules(spark):
    """100 average rules on one series: the same shuffles as one rule up to the hits."""
    r = _readings(spark, [(1, "p", t, float(t % 7), None) for t in range(300)])
    plans = []
    for n in (1, 100):
        c = _cond(spark, [(i, 1, None, "p", "avg", ">", 100.0 + i, 20, 5, "or") for i in range(n)])
        df = ru.avg_hits(r, ru.prepare(c))
        assert df.count() == 0
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
    assert plans[0] == plans[1]


def test_messages_are_paged(spark):
    import json
    an = spark.createDataFrame([(1, None, t * 50_000, t * 50_000 + 1) for t in range(25)], "rule_id int, asset_id long, start_time long, end_time long")
    rules = spark.createDataFrame([(1, 0, 10, "x")], "rule_id int, start_time long, end_time long, name string")
    got = sorted((r.page, json.loads(r.message)) for r in ru.messages(an, rules, page=10).collect())
    assert [len(m["anomalies"]) for _, m in got] == [10, 10, 5]
    assert [a["start_time"] for _, m in got for a in m["anomalies"]] == [t * 50_000 for t in range(25)]
