import json
import os

from pyspark.sql import functions as F

from sensorlake.plans.engine import run_rules
from sensorlake.sources import files


def test_rule_engine_run(spark, tmp):
    s0 = 1_700_000_000
    docs = [
        {"rule_id": 1, "rule_name": "hi pressure", "tenant_id": "t", "join_condition": "or", "severity": "high",
         "risk_register_controls": [1], "operation": "create",
         "conditions": [{"condition_id": 1, "asset_id": ["W1", "W2"], "parameter": "pressure", "operator": ">",
                         "threshold": 100.0, "duration": 20, "function": "raw", "rule_run_frequency": 1800,
                         "sensor_type": "gauge"}]},
        {"rule_id": 2, "rule_name": "unknown asset", "tenant_id": "t", "join_condition": "or", "severity": "low",
         "risk_register_controls": [], "operation": "create",
         "conditions": [{"condition_id": 1, "asset_id": ["W9"], "parameter": "pressure", "operator": ">",
                         "threshold": 1.0, "duration": 0, "function": "raw", "rule_run_frequency": 1800,
                         "sensor_type": "gauge"}]},
    ]
    p = os.path.join(tmp, "rules.json")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    d = spark.read.schema(files.RULE_DOC).json(p)
    assets = spark.createDataFrame([("W1", 1), ("W2", 1)], "asset_id string, data_frequency int")
    rows = [("W1", "pressure", s0 + i, 150.0 if 300 <= i < 360 else 10.0, None, "gauge") for i in range(0, 3600)]
    rows += [("W2", "pressure", s0 + i, 10.0, None, "gauge") for i in range(0, 3600)]
    readings = spark.createDataFrame(rows, "asset_id string, parameter string, epoch long, value double, k int, "
                                           "sensor_type string")
    state = spark.createDataFrame([("wf", "gauge", s0 + 1800 + 900, None)],
                                  "workflow_id string, sensor_type string, last_run_time long, last_updated_date timestamp")
    res = run_rules(d, assets, readings, state, "wf", engine_period=1800, downtime=7200, now=s0 + 3600)
    assert [(r.rule_id, r.detail) for r in res.errors.collect()] == [(2, "W9")]
    an = [(r.rule_id, r.asset_id, r.start_time, r.end_time) for r in res.anomalies.collect()]
    w = res.windows.filter(F.col("rule_id") == 1).collect()[0]
    # S10 by hand: last = s0+2700, g = 899/1800, t mod 1800 = 1700 -> [s0-800, s0+1899]
    assert (w.start_time, w.end_time, w.next_run_time) == (s0 - 800, s0 + 1899, s0 + 5399)
    assert an == [(1, "W1", s0 + 300, s0 + 359)]
    msgs = {r.rule_id: json.loads(r.message) for r in res.messages.collect()}
    assert msgs[1]["rule"]["severity"] == "high" and msgs[1]["anomalies"][0]["start_time"] == s0 + 300
    assert msgs[1]["time_range"] == {"start": s0 - 800 - 1, "end": s0 + 1899}  # start - (2f - 1), f = 1
    assert msgs[1]["rule"]["conditions"][0]["parameter"] == "pressure"
    st = {r.sensor_type: r.last_run_time for r in res.state.collect()}
    assert st["gauge"] == w.next_run_time
