import base64
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from sensorlake.sources import broker, files, generate, sinks


def test_landing_to_bronze(spark, tmp):
    body = json.dumps([{"nodeId": "n1", "displayName": "T1", "value": {"value": 1.5, "timestamp": "2024-01-01 00:00:01",
                                                                       "statusCode": "Good"}},
                       {"nodeId": "n2", "displayName": "T[2]}", "value": {"value": 2.5, "timestamp": "bad",
                                                                          "statusCode": "Good"}}])
    path = os.path.join(tmp, "landing")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write(json.dumps({"source_module": "opc", "body": body}) + "\n")
    df = files.read_landing(spark, path, streaming=False)
    out = {r.tag_id: r for r in files.landing_to_bronze(df).collect()}
    assert out["T1"].value == 1.5 and out["T1"].timestamp is not None
    assert out["T[2]}"].value == 2.5 and out["T[2]}"].timestamp is None  # bracket kept, bad time -> null


def test_broker_shape_and_decompress(spark):
    payload = base64.b64encode(gzip.compress(b'{"a": 1}')).decode()
    df = spark.createDataFrame([(payload.encode(), "2024-01-02 00:00:00", {"module": "opc"}),
                                (b"x", "2023-12-01 00:00:00", {"module": "opc"})],
                               "body binary, enqueuedTime string, properties map<string,string>")
    df = df.withColumn("enqueuedTime", F.col("enqueuedTime").cast("timestamp"))
    s = broker.shape_broker(df, "2024-01-01 00:00:00", "module", "opc")
    out = broker.decompress_body(s).collect()
    assert len(out) == 1 and out[0].body == '{"a": 1}' and out[0].source_module == "opc"
    b = broker.to_broker_body(spark.createDataFrame([("t", 1.0)], "tag_id string, value double"), {"tag_id": "tagId"})
    assert json.loads(bytes(b.collect()[0].body).decode()) == {"tagId": "t", "value": 1.0}


def test_read_delimited_multichar(spark, tmp):
    p = os.path.join(tmp, "d.txt")
    with open(p, "w") as f:
        f.write("1;@5;@\n2;@;@7\n")
    df = files.read_delimited(spark, p, ";@", ["id", "a", "b"])
    assert sorted(map(tuple, df.collect())) == [(1, 5, 0), (2, 0, 7)]


def test_read_rules_and_flatten(spark, tmp):
    from sensorlake.plans.lifecycle import flatten_rules
    doc = {"rule_id": 7, "rule_name": "r", "tenant_id": "t", "join_condition": "", "severity": "high",
           "risk_register_controls": [1], "operation": "create",
           "conditions": [{"condition_id": 1, "asset_id": ["A", "B"], "parameter": "pressure", "operator": ">",
                           "threshold": 10.0, "duration": 60, "function": "raw"}]}
    p = os.path.join(tmp, "rule.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    d = files.read_rules(spark, p)
    assert d.collect()[0].file_name.endswith("rule.json")
    flat = flatten_rules(d).collect()
    assert sorted(r.asset_id for r in flat) == ["A", "B"] and flat[0].join_condition == "or"


def test_text_blocks(spark):
    text = "head\nSTART\n1 2\n3 4\nEND\njunk\nSTART\n5 6\nEND"
    df = spark.createDataFrame([("f1", text)], "file string, value string")
    lines = files.split_lines(df, "file", "value")
    out = [(r.block_id, r.value) for r in files.parse_block_text(lines, "^START", "^END").orderBy("line_no").collect()]
    assert out == [(1, "1 2"), (1, "3 4"), (2, "5 6")]


def test_upsert_is_idempotent_and_delete(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, n string, v double")
    s = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0)], "k int, n string, v double")
    once = sinks.upsert(t, s, ["k"])
    twice = sinks.upsert(once, s, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0)]
    part = sinks.upsert(t, s.select("k", "v"), ["k"], set_cols=["v"])
    assert sorted(map(tuple, part.collect())) == [(1, "a", 1.0), (2, "b", 20.0), (3, None, 3.0)]
    assert sorted(r.k for r in sinks.delete_matching(t, s, ["k"]).collect()) == [1]


def test_conform_and_versions(spark, tmp):
    schema = StructType([StructField("tag_id", StringType()), StructField("value", DoubleType()),
                         StructField("last_updated_date", TimestampType())])
    df = spark.createDataFrame([(1.0, "x")], "value double, tag_id string")
    c = sinks.conform(df, schema, {"last_updated_date": F.current_timestamp()})
    assert c.columns == ["tag_id", "value", "last_updated_date"] and c.collect()[0].last_updated_date is not None
    base = os.path.join(tmp, "tbl")
    sinks.write_version(c, base)
    sinks.write_version(c.withColumn("value", F.lit(2.0)), base)
    assert sinks.read_latest(spark, base).collect()[0].value == 2.0


def test_generate_gauge(spark):
    g = generate.generate_gauge(spark, 0, 100, ["A", "B"], {"pressure": (2000, 2010), "temperature": (50, 60)},
                                anomalies=[("A", 10, 19, "pressure", 2100.0)])
    assert g.count() == 200
    r = g.agg(F.min("temperature"), F.max("temperature")).collect()[0]
    assert 50 <= r[0] and r[1] <= 60
    assert g.filter((F.col("asset_id") == "A") & (F.col("pressure") == 2100.0)).count() == 10


def test_generate_gauge_for_many_assets(spark):
    """a thousand assets, each with a window, as sequences and as frames; the plan does not grow with them."""
    names = [f"A{i}" for i in range(1000)]
    bounds = {"pressure": (10.0, 20.0), "temperature": (50.0, 60.0)}
    windows = [(a, 4, 6, "pressure", 99.0) for a in names] + [("A7", 6, 7, "pressure", 98.0), ("A8", 3, 3, "temperature", None)]
    g = generate.generate_gauge(spark, 0, 10, names, bounds, anomalies=windows).cache()
    assert g.columns == ["epoch_timestamp", "asset_id", "pressure", "temperature", "last_updated_date"]
    assert g.count() == 10_000 and g.filter("pressure = 99").count() == 2999
    assert [r[0] for r in g.filter("pressure = 98").orderBy("epoch_timestamp").select("epoch_timestamp").collect()] == [6, 7]
    assert [tuple(r) for r in g.filter("temperature IS NULL").select("asset_id", "epoch_timestamp").collect()] == [("A8", 3)]
    assert g.filter("pressure < 90 AND NOT pressure BETWEEN 10 AND 20 OR NOT temperature BETWEEN 50 AND 60").count() == 0
    assert g.select("pressure").distinct().count() > 6900
    frames = generate.generate_gauge(
        spark, 0, 10, spark.createDataFrame([(a,) for a in names], "asset_id string").repartition(7), bounds,
        anomalies=spark.createDataFrame([(a, n, *w) for n, (a, *w) in enumerate(windows)], generate.WINDOW_SCHEMA))
    assert frames.exceptAll(g).isEmpty() and g.exceptAll(frames).isEmpty()  # by seed, whatever the partitions
    g.unpersist()


def test_generate_gauge_blocks_and_odd_assets(spark):
    """Seconds over several blocks, a window across their border, null and repeated assets, an empty range."""
    border = generate.BLOCK
    g = generate.generate_gauge(spark, 5, 2 * border + 1, ["A", None, "A"], {"pressure": (0, 1)},
                                anomalies=[("A", border - 1, border + 8, "pressure", 7.0), (None, 0, 9, "pressure", 7.0)])
    rows = {r.asset_id: (r.n, r.lo, r.hi, r.hits) for r in g.groupBy("asset_id").agg(
        F.count("pressure").alias("n"), F.min("epoch_timestamp").alias("lo"), F.max("epoch_timestamp").alias("hi"),
        F.count(F.when(F.col("pressure") == 7, 1)).alias("hits")).collect()}
    n = 2 * border - 4
    assert rows == {"A": (2 * n, 5, 2 * border, 20), None: (n, 5, 2 * border, 0)}
    assert generate.generate_gauge(spark, 5, 5, ["A"], {"pressure": (0, 1)}).count() == 0
    with pytest.raises(ValueError, match="unknown columns"):
        generate.generate_gauge(spark, 0, 5, ["A"], {"pressure": (0, 1)}, anomalies=[("A", 0, 1, "flow", 1.0)])


def test_write_clustered_prunes(spark, tmp):
    df = spark.range(0, 3 * 86400, 600).select(F.col("id").alias("epoch"), (F.col("id") % 7).cast("string").alias("tag"),
                                                F.lit(1.0).alias("value"))
    p = os.path.join(tmp, "clustered")
    sinks.write_clustered(df, p, "epoch", ["tag"])
    back = spark.read.parquet(p)
    assert back.count() == df.count()
    q = back.filter((F.col("day") == "1970-01-02") & (F.col("tag") == "3"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and q.count() > 0


def test_read_text_lines_blocks(spark, tmp):
    for name, text in [("a.txt", "x\nSTART\n1\n2\nEND\n"), ("b.txt", "START\n9\nEND\nSTART\n8\nEND")]:
        with open(os.path.join(tmp, name), "w") as f:
            f.write(text)
    lines = files.read_text_lines(spark, tmp)
    blocks = files.parse_block_text(lines, "^START", "^END")
    got = sorted((r.file.split("/")[-1], r.block_id, r.value) for r in blocks.collect())
    assert got == [("a.txt", 1, "1"), ("a.txt", 1, "2"), ("b.txt", 1, "9"), ("b.txt", 2, "8")]


def test_read_with_outcome(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    with open(os.path.join(d, "good.json"), "w") as f:
        f.write('{"source_module": "m", "body": "[]"}\n{"source_module": "m", "body": "[1]"}\n')
    with open(os.path.join(d, "bad.json"), "w") as f:
        f.write('{"source_module": "m", "body": "[]"}\n{not json\n')
    rows, outcome = files.read_with_outcome(spark, d, files.LANDING_SCHEMA)
    out = {r.file_name.split("/")[-1]: (r.status, r.n_rows, r.n_errors) for r in outcome.collect()}
    assert out == {"good.json": ("processed", 2, 0), "bad.json": ("error", 2, 1)}
    assert rows.count() == 3


def test_retain_version(spark, tmp):
    base = os.path.join(tmp, "tbl")
    sinks.write_version(spark.createDataFrame([(1, 1.0), (5, 2.0), (9, 3.0)], "t long, v double"), base)
    path = sinks.retain_version(spark, base, "t", 5)
    assert path.endswith("v000002")
    assert sorted(r.t for r in sinks.read_latest(spark, base).collect()) == [5, 9]


def test_decompress_invalid_payload_is_null(spark):
    df = spark.createDataFrame([("not-base64!",), (None,)], "body string")
    assert [r.body for r in broker.decompress_body(df).collect()] == [None, None]


def test_write_clustered_timestamp_column(spark, tmp):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 23, 59)
    df = spark.createDataFrame([("a", t0, 1.0), ("a", t0 + dt.timedelta(minutes=2), 2.0)], "tag string, ts timestamp, v double")
    p = os.path.join(tmp, "c")
    sinks.write_clustered(df, p, "ts", ["tag"], files_per_day=2)
    days = sorted(r.day.isoformat() for r in spark.read.parquet(p).select("day").distinct().collect())
    assert days == ["2024-01-01", "2024-01-02"]


def _files(path):
    import os
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.startswith("part")) for d in sorted(os.listdir(path)) if d.startswith("day=")}


def test_updates_rewrite_only_the_touched_days(spark, tmp):
    import os
    path = os.path.join(tmp, "gold")
    rows = [(a, t, float(a + t)) for t in (0, 86400, 2 * 86400) for a in (1, 2)]
    sinks.replace_days(spark.createDataFrame(rows, "asset int, t long, v double"), path, "t")
    before = _files(path)
    new = spark.createDataFrame([(1, 86400, -1.0), (3, 86400, -3.0)], "asset int, t long, v double")
    sinks.upsert_days(spark, path, new, ["asset", "t"], "t")
    after = _files(path)
    assert [d for d in before if before[d] != after[d]] == ["day=1970-01-02"]
    got = sorted((r.asset, r.t, r.v) for r in spark.read.parquet(path).collect())
    assert got == sorted([r for r in rows if r[:2] != (1, 86400)] + [(1, 86400, -1.0), (3, 86400, -3.0)])
    sinks.refresh_days(spark, path, new, lambda old, s: s, "t")
    assert spark.read.parquet(path).count() == 6
    assert sinks.drop_days_before(spark, path, "1970-01-02") == ["1970-01-01"]
    assert list(_files(path)) == ["day=1970-01-02", "day=1970-01-03"]


def test_landing_errors(spark):
    rows = [("m", '[{"displayName": "T", "value": {"value": 1.0}}]'), ("m", "no json"), ("m", None)]
    df = spark.createDataFrame(rows, "source_module string, body string")
    assert files.landing_to_bronze(df).count() == 1
    assert sorted(str(r.body) for r in files.landing_errors(df).collect()) == ["None", "no json"]


def test_read_delimited_with_schema_reads_once(spark, tmp):
    import os
    p = os.path.join(tmp, "x.csv")
    with open(p, "w") as f:
        f.write("1;@5;@\n2;@;@7\n")
    df = files.read_delimited(spark, p, schema="a int, b int, c int")
    assert sorted(map(tuple, df.collect())) == [(1, 5, 0), (2, 0, 7)]
