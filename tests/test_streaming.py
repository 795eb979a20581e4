import os

from pyspark.sql import functions as F

from sensorlake.sources import sinks
from sensorlake.streaming import tags as st


def _write_batches(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "tag_id string, value double, timestamp timestamp").coalesce(1) \
            .write.mode("append").parquet(os.path.join(path, f"b{i}"))


def test_dedup_stream_equals_batch(spark, tmp):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", 1.0, t0), ("a", 1.0, t0), ("b", 2.0, t0 + dt.timedelta(seconds=5)),
            ("a", 3.0, t0 + dt.timedelta(seconds=40)), ("a", 3.0, t0 + dt.timedelta(seconds=40))]
    src = os.path.join(tmp, "src")
    spark.createDataFrame(rows, "tag_id string, value double, timestamp timestamp").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out = os.path.join(tmp, "out")
    q = sinks.write_stream(st.dedup_silver(stream), out, os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    batch = sorted(map(tuple, st.dedup_silver(spark.read.parquet(src)).collect()))
    assert got == batch and len(got) == 3


def test_soft_tags_stream(spark, tmp):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("x", 1.0, t0), ("y", 3.0, t0 + dt.timedelta(seconds=10)), ("x", 5.0, t0 + dt.timedelta(seconds=70)),
            ("x", 1.0, t0 + dt.timedelta(seconds=400))]
    src = os.path.join(tmp, "src")
    spark.createDataFrame(rows, "tag_id string, value double, timestamp timestamp").coalesce(1).write.parquet(src)
    mapping = spark.createDataFrame([("avg_xy", "x", "average"), ("avg_xy", "y", "average")],
                                    "output_tag string, input_tag string, function string")
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    results = []

    def sink(df, batch_id):
        results.extend(df.collect())
    q = sinks.write_stream_batch(st.soft_tag_stream(stream, mapping), sink, os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(120)
    got = {r.window_start: r.value for r in results}
    assert got[t0] == 2.0 and got[t0 + dt.timedelta(seconds=60)] == 5.0


def test_resample_stream_batch(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0, 1.0, 10.0), (t0 + dt.timedelta(seconds=30), 3.0, 20.0),
                                (t0 + dt.timedelta(seconds=61), 5.0, 30.0)], "ts timestamp, a double, b double")
    out = sorted(map(tuple, st.resample_stream(df, "ts", ["a", "b"]).collect()))
    assert out == [(t0, 2.0, 15.0), (t0 + dt.timedelta(seconds=60), 5.0, 30.0)]


def test_pivot_batch(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", 10.0, t0, 1), ("B", 20.0, t0, 1), ("C", 30.0, t0, 1)],
                               "tag_id string, value double, timestamp timestamp, last_updated_date int")
    fn = st.pivot_batch(["A", "B", "C"], lambda j: 100.0 - F.col("A") - F.col("B") - F.col("C"))
    assert fn(df).collect()[0].value == 40.0


def test_landing_to_gold_stream(spark, tmp):
    """SR1 -> PJ1/PJ2 -> SM1 -> JN2 -> JN1 -> SK1 as streams with availableNow; equals the batch result."""
    import json

    from sensorlake.sources import files
    landing = os.path.join(tmp, "landing")
    os.makedirs(landing)
    bodies = [[("T1", 1.0, "2024-01-01 00:00:01"), ("T1", 1.0, "2024-01-01 00:00:01"), ("AGG", 5.0, "2024-01-01 00:00:02")],
              [("T2", 2.0, "2024-01-01 00:00:03")]]
    for i, rows in enumerate(bodies):
        body = json.dumps([{"nodeId": n, "displayName": n, "value": {"value": v, "timestamp": t, "statusCode": "Good"}}
                           for n, v, t in rows])
        with open(os.path.join(landing, f"f{i}.json"), "w") as f:
            f.write(json.dumps({"source_module": "opc", "body": body}) + "\n")
    aggs = spark.createDataFrame([("AGG",)], "tag_id string")
    meta = spark.createDataFrame([("T1", "u1"), ("T2", "u2")], "source_tag_id string, measurement_set_uuid string")

    def stages(df):
        bronze = files.landing_to_bronze(df).drop("last_updated_date")
        silver = st.physical_tags(st.dedup_silver(bronze), aggs)
        return st.enrich_gold(silver, meta)

    out = os.path.join(tmp, "gold")
    q = sinks.write_stream(stages(files.read_landing(spark, landing)), out, os.path.join(tmp, "ck"),
                           available_now=True)
    q.awaitTermination(120)
    got = sorted((r.tag_id, r.value, r.measurement_set_uuid) for r in spark.read.parquet(out).collect())
    batch = sorted((r.tag_id, r.value, r.measurement_set_uuid)
                   for r in stages(files.read_landing(spark, landing, streaming=False)).collect())
    assert got == batch == [("T1", 1.0, "u1"), ("T2", 2.0, "u2")]


def test_late_rows_dropped_by_watermark(spark, tmp):
    """SM2: after the watermark passed, an old row (and a replay of it) is not emitted."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    src = os.path.join(tmp, "src")
    schema = "tag_id string, value double, timestamp timestamp"
    spark.createDataFrame([("a", 1.0, t0 + dt.timedelta(seconds=120))], schema).coalesce(1) \
        .write.mode("append").parquet(os.path.join(src, "b0"))
    out, ck = os.path.join(tmp, "out"), os.path.join(tmp, "ck")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        sinks.write_stream(st.dedup_silver(stream), out, ck, available_now=True).awaitTermination(120)
    run()
    spark.createDataFrame([("b", 2.0, t0), ("c", 3.0, t0 + dt.timedelta(seconds=200))], schema).coalesce(1) \
        .write.mode("append").parquet(os.path.join(src, "b1"))
    run()
    got = sorted(r.tag_id for r in spark.read.parquet(out).collect())
    assert got == ["a", "c"]


def test_idempotent_batch_writer(spark, tmp):
    df = spark.createDataFrame([("a", 1.0)], "tag_id string, value double")
    fn = sinks.idempotent_batch_writer(os.path.join(tmp, "out"))
    fn(df, 0)
    fn(df, 0)  # replay of the same batch
    fn(df, 1)
    assert spark.read.parquet(os.path.join(tmp, "out")).count() == 2
