import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorlake.functions import scalars as sc
from sensorlake.operators import aggregates as ag
from sensorlake.operators import fibre as fb
from sensorlake.operators import joins as jn
from sensorlake.operators import windows as wn
from sensorlake.plans import lifecycle, scripts
from sensorlake.sources import files, sinks
from sensorlake.streaming import tags as st


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("T1", 2000.0, "01/31/2024", " Pressure ", "123"), ("T2", 10.0, "2024-31-01", "x", "9" * 20)],
                               "tag string, v double, d string, name string, id string")
    r = df.select(sc.scale_units("v", "tag", {"T1": 1 / 1000}).alias("s"), sc.parse_epoch("d").alias("e"),
                  sc.normalise("name", {"pressure": "pressure_psi"}).alias("n"), sc.zfill("id").alias("z")).collect()
    assert r[0].s == 2.0 and r[1].s == 10.0
    assert r[0].e == 1706659200 and r[1].e == 1706659200
    assert r[0].n == "pressure_psi" and r[1].n == "x"
    assert r[0].z == "000000000000000123" and r[1].z == "9" * 20


def test_asset_frequency_and_errors(spark):
    rules = spark.createDataFrame([(1, ["A", "B"]), (2, ["A", "Z"])], "rule_id int, asset_id array<string>")
    assets = spark.createDataFrame([("A", 10), ("B", 30)], "asset_id string, data_frequency int")
    ok, err = lifecycle.rules_with_frequency(rules, assets)
    r = ok.collect()[0]
    assert r.rule_id == 1 and r.frequencies == [19, 59] and r.max_frequency == 30
    e = err.collect()[0]
    assert e.rule_id == 2 and e.detail == "Z"


def test_rule_headers_and_parse(spark):
    cond = spark.createDataFrame([(1, 2, "p", ">", 1.0, 5, "raw"), (1, 1, "q", "<", 2.0, 5, "avg")],
                                 "rule_id int, condition_id int, parameter string, operator string, threshold double, "
                                 "duration int, function string")
    rules = spark.createDataFrame([(1, "high", [3, 4])], "rule_id int, severity string, risk_register_controls array<int>")
    h = lifecycle.rule_headers(cond, rules).collect()[0]
    assert h.condition_ids == [1, 2] and '"parameter":"q"' in h.conditions_json
    header = spark.createDataFrame([(1, h.conditions_json)], "rule_id int, js string")
    p = jn.with_parsed(rules, header, "rule_id", "js", "array<struct<condition_id:int,parameter:string>>").collect()[0]
    assert [c.parameter for c in p.parsed] == ["q", "p"]


def test_watermark_state_and_gate(spark):
    data = spark.createDataFrame([("gauge", 100), ("gauge", 300), ("flow", 50)], "sensor string, t long")
    state = lifecycle.first_run_state(data, "wf", "sensor", "t")
    assert {r.sensor_type: r.last_run_time for r in state.collect()} == {"gauge": 300, "flow": 50}
    runs = spark.createDataFrame([("wf", "gauge", 2100)], "workflow_id string, sensor_type string, next_run_time long")
    adv = {r.sensor_type: r.last_run_time for r in lifecycle.advance_watermark(state, runs).collect()}
    assert adv == {"gauge": 2100, "flow": 50}
    assert lifecycle.has_data(data) and not lifecycle.has_data(data.filter("t < 0"))


def test_script_rules(spark):
    s = 1_000_000
    rows = [(1, s + i, 100.0 + (i % 3)) for i in range(4000)] + [(1, s + 3900, 100.0)]
    rows[3500] = (1, s + 3500, 500.0)
    r = spark.createDataFrame(rows, "asset_id long, epoch long, value double")
    out = scripts.run_script_rules([{"rule_id": 9, "script": "zscore_spike", "asset_ids": [1], "start_time": s + 3000,
                                     "end_time": s + 3999, "history": 3600, "params": {"d": 3600, "threshold": 10}}], r)
    assert [(x.start_time, x.end_time) for x in out.collect()] == [(s + 3500, s + 3500)]
    ch = scripts.chart(r.filter(F.col("epoch") < s + 3), ["asset_id"], "epoch", "value").collect()[0]
    assert ch.x == [s, s + 1, s + 2]


def test_misc_aggregates(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["b", "c"]), (2, ["x"])], "k int, l array<string>")
    assert {r.k: r.o for r in ag.flatten_lists(df, ["k"], "l", "o").collect()} == {1: ["a", "b", "c"], 2: ["x"]}
    w = spark.createDataFrame([(1, 1.0, 2.0)], "t int, a double, b double")
    assert sorted((r.parameter, r.value) for r in ag.melt(w, ["t"], ["a", "b"]).collect()) == [("a", 1.0), ("b", 2.0)]
    ids = wn.combination_ids(spark.createDataFrame([(2, "b"), (1, "z"), (1, "a")], "r int, q string"), ["r", "q"])
    assert [(r.r, r.q, r.combination_id) for r in ids.orderBy("combination_id").collect()] == [(1, "a", 1), (1, "z", 2), (2, "b", 3)]
    assert wn.first_by(spark.createDataFrame([(3,), (1,), (2,)], "t int"), ["t"]).collect()[0].t == 1


def test_baseline_join_and_enrich(spark):
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 7.0), (2, 10, 1.0)], "a int, t long, v double")
    b = jn.baseline_join(r.filter("t = 20"), r, ["a"], "t", "v", 10).collect()
    assert [(x.a, x.v, x.baseline_value) for x in b] == [(1, 7.0, 5.0)]
    dim = spark.createDataFrame([(1, "one")], "a int, name string")
    assert jn.enrich(r, dim, "a").count() == 2 and jn.present_in(r, dim, "a").count() == 2
    assert jn.exclude(r, dim, "a").count() == 1


def test_stream_static_joins(spark):
    raw = spark.createDataFrame([("t1", 1.0), ("agg1", 2.0)], "tag_id string, value double")
    aggs = spark.createDataFrame([("agg1",)], "tag_id string")
    assert [r.tag_id for r in st.physical_tags(raw, aggs).collect()] == ["t1"]
    meta = spark.createDataFrame([("t1", "uuid-1")], "source_tag_id string, measurement_set_uuid string")
    assert st.enrich_gold(raw, meta).collect()[0].measurement_set_uuid == "uuid-1"


def test_das_bronze_shape_and_products(spark, tmp):
    decoded = spark.createDataFrame([("d1", 0, 3), ("d9", 1, 2)], "device_id string, band_id int, n_depth int")
    bands = spark.createDataFrame([(0, 0, 100), (1, 100, 200)], "band_id int, start int, end int")
    assets = spark.createDataFrame([("d1", "W1")], "device_id string, asset_id string")
    out = {r.device_id: r for r in fb.shape_das_bronze(decoded, bands, assets).collect()}
    assert out["d1"].freq_band == "0-100" and out["d1"].depth == [0, 1, 2]
    assert out["d9"].asset_id == fb.MISSING_ASSET
    prod = spark.createDataFrame([("W1", [1], [10], [[1.0]])], "asset_id string, time array<long>, depth array<int>, data array<array<double>>")
    fb.write_products(prod, os.path.join(tmp, "p"))
    assert any(n.startswith("asset_id=W1") for n in os.listdir(os.path.join(tmp, "p")))
    import json
    doc = json.loads(spark.read.text(os.path.join(tmp, "p")).collect()[0].value)
    assert doc == {"data": [[1.0]], "time": [1], "depth": ["10"]}
    new = spark.createDataFrame([("W1", [2], [10, 20], [[2.0], [3.0]])],
                                "asset_id string, time array<long>, depth array<int>, data array<array<double>>")
    ap = fb.append_product(prod, new, ["asset_id"]).collect()[0]
    assert ap.time == [1, 2] and ap.depth == [10, 20] and ap.data == [[1.0, 2.0], [None, 3.0]]


def test_xml_features_and_landing_sink(spark, tmp):
    p = os.path.join(tmp, "f.xml")
    with open(p, "w") as f:
        f.write('<root xmlns:n="urn:x"><n:joint><n:id>A-FUS-1</n:id><n:jointType>Optical</n:jointType></n:joint>'
                '<n:joint><n:id>B-2</n:id><n:jointType>CIU</n:jointType></n:joint></root>')
    df = files.read_features(spark, p, "n:joint")
    assert sorted(r.id for r in df.collect()) == ["A-FUS-1", "B-2"]
    src = os.path.join(tmp, "src")
    spark.createDataFrame([("m", "[1]"), ("m", "[2]")], "source_module string, body string").write.parquet(src)
    stream = files.read_stream_table(spark, src, schema=spark.read.parquet(src).schema)
    q = sinks.write_landing(stream, os.path.join(tmp, "landing"), os.path.join(tmp, "ck"))
    q.awaitTermination(120)
    assert len([n for n in os.listdir(os.path.join(tmp, "landing")) if n.endswith(".json")]) == 2
    log = sinks.log_files(spark.createDataFrame([("a.h5",)], "file_name string"), "error", "bad header").collect()[0]
    assert log.status == "error" and log.error_message == "bad header"
    assert files.rename_columns(spark.createDataFrame([(1, 2)], "a int, b int"), ["x", "y"], "c_").columns == ["c_x", "c_y"]


@pytest.mark.parametrize("rows", [1, 2, 4000])
def test_landing_files_of_one_input_file_by_many_tasks(spark, tmp, rows):
    """a batch from one file lands in files of one record each, created by many tasks, none of them empty."""
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "landing")
    sent = spark.range(rows).selectExpr("id", "IF(id % 2 = 0, NULL, 'same') AS name", "timestamp_seconds(id) AS at").coalesce(1)
    sent.write.parquet(src)
    q = sinks.write_landing(spark.readStream.schema(sent.schema).parquet(src), out, os.path.join(tmp, "ck"))
    assert q.awaitTermination(120)
    names = [n for n in os.listdir(out) if n.endswith(".json")]
    assert len(names) == rows
    for n in names[:50]:
        with open(os.path.join(out, n)) as f:
            assert len(f.read().splitlines()) == 1
    assert min(os.path.getsize(os.path.join(out, n)) for n in names) > 0
    by_task = Counter(n.split("-")[1] for n in names)  # part-<task>-...
    assert len(by_task) == min(rows, 4) and max(by_task.values()) <= -(-rows // 4) + 1
    back = spark.read.schema(sent.schema).json(out)
    assert back.exceptAll(sent).isEmpty() and back.count() == rows


def test_route_rule_types(spark):
    rules = spark.createDataFrame([(1, None), (2, "script"), (3, "Standard")], "rule_id int, rule_type string")
    std, scr = scripts.route_rule_types(rules)
    assert sorted(r.rule_id for r in std.collect()) == [1, 3] and [r.rule_id for r in scr.collect()] == [2]


def test_publish_gates(spark):
    import datetime as dt
    def at(h, m):
        return int(dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc).timestamp())
    rows = spark.createDataFrame([(at(5, 31),), (at(5, 10),), (at(23, 45),), (at(11, 40),)], "t long")
    week, month = fb.publish_gates(F.col("t"))
    got = [(r.w, r.m) for r in rows.select(week.alias("w"), month.alias("m")).collect()]
    assert got == [(True, False), (False, False), (True, True), (True, False)]


def test_quadratic_prediction(spark):
    from sensorlake.operators import model as ml
    long = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], "id int, feature string, value double")
    q = ml.expand_quadratic(long, ["id"], "feature", "value")
    assert sorted((r.feature, r.value) for r in q.collect()) == [("a", 2.0), ("a*a", 4.0), ("a*b", 6.0), ("b", 3.0), ("b*b", 9.0)]
    coef = spark.createDataFrame([("a", 1.0), ("a*b", 0.5), ("__intercept__", 2.0)], "feature string, coef double")
    assert ml.predict_linear(q, coef, ["id"], "feature", "value").collect()[0].predicted == 2.0 + 2.0 + 3.0


def test_band_registry_upsert(spark):
    silver = spark.createDataFrame([("W1", "0-100", 50), ("W1", "0-100", 70), ("W2", "100-200", 10)],
                                   "asset_id string, freq_band string, time long")
    old = spark.createDataFrame([("W1", "0-100", 20), ("W3", "0-100", 5)], "asset_id string, freq_band string, latest_epoch long")
    got = sorted(tuple(r) for r in fb.band_registry(silver, old).collect())
    assert got == [("W1", "0-100", 70), ("W2", "100-200", 10), ("W3", "0-100", 5)]
