"""Script rules on frames, their documents, and engine runs in a plain session."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sensorlake.plans import engine, scripts
from sensorlake.session import local_frame
from sensorlake.sources import files

CONDITION = "rule_id int, condition_id int, asset_id string, parameter string, path string, operator string, threshold double, duration int, start_time long, end_time long"
READING = "asset_id string, parameter string, epoch long, value double, k int, sensor_type string"


def functions():
    """Frame rules of the tests (made here, so that workers need not import this file)."""
    import numpy as np

    def late_sum(data, time_range, rule):
        """Sum of the last ``duration`` seconds at every reading of the range."""
        t, v = data["epoch"].to_numpy(), data["value"].to_numpy()
        for i in np.flatnonzero((t >= time_range["start_time"]) & (t <= time_range["end_time"])).tolist():
            total = int(v[(t > t[i] - rule["duration"]) & (t <= t[i])].sum())
            yield {"start_time": int(t[i]), "end_time": total}

    def silence(data, time_range, rule):
        """A range without any reading."""
        if not data["epoch"].between(time_range["start_time"], time_range["end_time"]).any():
            yield time_range

    def size(data, time_range, rule):
        yield {"start_time": time_range["start_time"], "end_time": len(data)}

    return {"late_sum": late_sum, "silence": silence, "size": size}


@pytest.mark.parametrize("cell", [10, 60, 10_000])
def test_cells_do_not_change_the_result(spark, cell):
    rows = [(a, "p", t, 1.0, None, "g") for a in ("A", "B") for t in range(0, 1000, 7)]
    readings = local_frame(spark, rows, READING)
    c = local_frame(spark, [(1, 1, "A", "p", "late_sum", ">", 1.0, 100, 300, 900), (2, 1, "B", "p", "late_sum", ">", 1.0, 0, 0, 50),
                            (3, 1, "A", "p", "nowhere", ">", 1.0, 0, 0, 50)], CONDITION)
    got = scripts.run_frame_rules(c, readings, cell=cell, registry=functions())
    want = [(1, "A", t, sum(1 for x in range(0, 1000, 7) if t - 100 < x <= t)) for t in range(0, 1000, 7) if 300 <= t <= 900]
    want += [(2, "B", t, 0) for t in range(0, 51, 7)]
    assert sorted((r["rule_id"], r["asset_id"], r["start_time"], r["end_time"]) for r in got.collect()) == sorted(want)


def test_groups_are_cells(spark):
    """A long window of one asset is many groups, each with its history's copies only; empty cells are called too."""
    readings = local_frame(spark, [("A", "p", t, 1.0, None, "g") for t in [*range(0, 500, 5), *range(900, 1000, 5)]], READING)
    c = local_frame(spark, [(1, 1, "A", "p", "size", ">", 1.0, 10, 0, 999), (2, 1, "A", "p", "silence", ">", 0.0, 0, 0, 999)], CONDITION)

    got = scripts.run_frame_rules(c, readings, cell=100, registry=functions()).collect()
    sizes = {r["start_time"]: r["end_time"] for r in got if r["rule_id"] == 1}
    assert len(sizes) == 10 and max(sizes.values()) == 22 and sizes[600] == 0
    assert sorted(r["start_time"] for r in got if r["rule_id"] == 2) == [500, 600, 700, 800]


def documents(spark, tmp, docs):
    p = os.path.join(tmp, "rules.json")
    with open(p, "w") as f:
        json.dump(docs, f)
    return files.read_rules(spark, p)


def rule(i, sensor, conditions, kind=None):
    return {"rule_id": i, "rule_name": f"r{i}", "tenant_id": "t", "join_condition": "or", "severity": "high", "risk_register_controls": [],
            "operation": "create", **({"rule_type": kind} if kind else {}),
            "conditions": [{"condition_id": k + 1, "asset_id": ["W1"], "parameter": p, "operator": ">", "threshold": t, "duration": d,
                            "rule_run_frequency": 1800, "sensor_type": sensor, **extra} for k, (p, t, d, extra) in enumerate(conditions)]}


def test_documents_reach_their_functions(spark, tmp):
    s0 = 1_700_000_000
    docs = documents(spark, tmp, [
        rule(1, "gauge", [("pressure", 100.0, 0, {"function": "raw"})]),
        rule(2, "gauge", [("pressure", 2.0, 600, {"path": "above_history"})], "script"),
        rule(3, "gauge", [("pressure", 2.0, 600, {"path": "missing"})], "SCRIPT"),
        rule(4, "gauge", [("pressure", 60.0, 600, {"path": "spread"}), ("temperature", 0.0, 600, {"path": "spread"})], "script")])
    assets = local_frame(spark, [("W1", 1)], "asset_id string, data_frequency int")
    rows = [("W1", "pressure", s0 + t, 120.0 if 900 <= t < 905 else 40.0, None, "gauge") for t in range(3600)]
    rows += [("W1", "temperature", s0 + 600, 50.0, None, "gauge")]
    readings = local_frame(spark, rows, READING)
    state = local_frame(spark, [("wf", "gauge", s0 + 2700, None)], "workflow_id string, sensor_type string, last_run_time long, last_updated_date timestamp")
    run = engine.run_rules(docs, assets, readings, state, "wf", engine_period=1800, downtime=7200, now=s0 + 3600)
    got = sorted(tuple(r) for r in run.anomalies.collect())
    assert [r for r in got if r[0] == 1] == [(1, "W1", s0 + 900, s0 + 904)]
    assert [r for r in got if r[0] == 2] == [(2, "W1", s0 + t, s0 + t) for t in range(900, 905)]
    assert [r for r in got if r[0] == 4] == [(4, "W1", s0 + t, s0 + t) for t in range(900, 905)]
    assert {r[0] for r in got} == {1, 2, 4}
    assert [(r["rule_id"], r["error"], r["detail"]) for r in run.errors.collect()] == [(3, "unknown script", "missing")]
    graph = json.loads(run.graphs.filter("rule_id = 2").orderBy("start_time").first()["graphs"])
    assert graph[0]["yaxis"] == {"label": "pressure", "data": [120.0]}
    assert {r["rule_id"] for r in run.messages.collect()} == {1, 2, 4}


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_first_run_of_one_of_two_sensors(spark, tmp, arrow):
    """One sensor has a watermark, the other none yet: both get their windows, with or without Arrow."""
    s0 = 1_700_000_000
    docs = documents(spark, tmp, [rule(1, "gauge", [("pressure", 10.0, 0, {"function": "raw"})]), rule(2, "flow", [("temperature", 10.0, 0, {"function": "raw"})])])
    assets = local_frame(spark, [("W1", 1)], "asset_id string, data_frequency int")
    readings = local_frame(spark, [("W1", "pressure", s0 + 2000, 50.0, None, "gauge"), ("W1", "temperature", s0 + 2000, 50.0, None, "flow")], READING)
    state = local_frame(spark, [("wf", "gauge", s0 + 900, None)], "workflow_id string, sensor_type string, last_run_time long, last_updated_date timestamp")
    old = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    try:
        run = engine.run_rules(docs, assets, readings, state, "wf", engine_period=1800, downtime=7200, now=s0 + 3600)
        last = {r["sensor_type"]: r["last_run_time"] for r in run.state.collect()}
        windows = {r["rule_id"]: (r["start_time"], r["end_time"]) for r in run.windows.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", old)
    assert set(last) == {"gauge", "flow"} and all(isinstance(t, int) for t in last.values())
    assert set(windows) == {1, 2} and windows[1][0] is not None


def test_local_frames_keep_declared_types(spark):
    rows = [("a", None, None, True), ("b", 10, 2.5, None)]
    df = local_frame(spark, rows, "s string, n long, x double, b boolean")
    assert [tuple(r) for r in df.collect()] == rows and df.schema["n"].dataType.simpleString() == "bigint"
    assert local_frame(spark, [], "n long").count() == 0
    assert df.select(F.max("n")).first()[0] == 10
