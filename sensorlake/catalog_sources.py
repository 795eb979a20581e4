"""Registered sources, sinks and small operators: text files in splits, rule documents, XML, compressed bodies,
landing files, audit rows, day-partitioned tables, exact medians."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .catalog import DAY, _r6, register
from .functions import scalars
from .operators import aggregates as ag
from .operators import fibre as fb
from .operators import joins, model
from .plans import lifecycle
from .session import ensure_checkpoint_dir, local_frame
from .sources import broker, files, generate, sinks
from .tables import FIBRE_SQL, READINGS_SQL, fibre, readings, table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorlake-{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources

SR6_LINES_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS line_no,
       CAST(o_orderkey AS VARCHAR) || ';' || o_orderstatus AS value FROM orders
"""


@register("sr6_numbered_lines", SR6_LINES_SQL)
def sr6_numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """SR6: text files (one a month of orders) read in splits, with every line's number in its file."""
    path = _folder(spark, "text")
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", F.concat(
        F.col("o_orderkey").cast("string"), F.lit(";"), "o_orderstatus").alias("value"))
    o.repartition("month").sortWithinPartitions("month", "o_orderkey").select("month", "value").write.partitionBy("month").text(path)
    lines = files.read_text_lines(spark, path)
    return lines.select(F.regexp_extract("file", "month=([0-9-]+)", 1).alias("month"), "line_no", "value")


SR3_SQL = "SELECT 'opc' AS source_module, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"


@register("sr3_compressed_bodies", SR3_SQL)
def sr3_compressed_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """SR3/SR2: messages whose bodies are base64 gzip, unpacked and parsed."""
    rows = table(spark, sf, "customer").select(F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))).alias("body"))

    def pack(batches):
        import base64
        import gzip
        for pdf in batches:
            pdf["body"] = pdf["body"].map(lambda t: base64.b64encode(gzip.compress(t.encode())).decode())
            yield pdf

    sent = rows.mapInPandas(pack, "body string").select(
        F.col("body").cast("binary").alias("body"), F.lit("2024-01-02").cast("timestamp").alias("enqueuedTime"),
        F.create_map(F.lit("module"), F.lit("opc")).alias("properties"))
    got = broker.decompress_body(broker.shape_broker(sent, "2024-01-01", "module"))
    return got.select("source_module", F.from_json("body", "id long, name string, balance double").alias("r")).select("source_module", "r.*")


SR5_SQL = """
SELECT CAST(s_suppkey AS INTEGER) AS rule_id, s_name AS rule_name, 'or' AS join_condition, 1 AS condition_id,
       unnest(['A' || CAST(s_nationkey AS VARCHAR), 'B']) AS asset_id, 'pressure' AS parameter, s_acctbal AS threshold FROM supplier
"""


@register("sr5_rule_documents_read", SR5_SQL)
def sr5_rule_documents_read(spark: SparkSession, sf: str) -> DataFrame:
    """SR5/PJ8: rule documents as JSON files, read with the nested schema and flattened."""
    s = table(spark, sf, "supplier")
    cond = F.struct(F.lit(1).alias("condition_id"), F.array(F.concat(F.lit("A"), F.col("s_nationkey").cast("string")), F.lit("B")).alias("asset_id"),
                    F.lit("pressure").alias("parameter"), F.lit(">").alias("operator"), F.col("s_acctbal").alias("threshold"))
    docs = s.select(F.col("s_suppkey").alias("rule_id"), F.col("s_name").alias("rule_name"), F.lit(" ").alias("join_condition"),
                    F.array(cond).alias("conditions"))
    path = _folder(spark, "rules")
    # files of one JSON array of fifty rules, as a rule store writes them
    docs.groupBy(F.floor(F.col("rule_id") / 50).alias("_f")).agg(F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value")) \
        .select("value").write.option("maxRecordsPerFile", 1).text(path)
    flat = lifecycle.flatten_rules(files.read_rules(spark, path))
    return flat.select("rule_id", "rule_name", "join_condition", "condition_id", "asset_id", "parameter", "threshold")


SR9_SQL = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer"


@register("sr9_xml_features", SR9_SQL)
def sr9_xml_features(spark: SparkSession, sf: str) -> DataFrame:
    """SR9: features written as XML, read by row tag with a schema."""
    path = _folder(spark, "xml")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                               F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    rows.write.format("xml").option("rootTag", "features").option("rowTag", "feature").save(path)
    return files.read_features(spark, path, "gml:feature", "id long, name string, balance double, segment string")


# ---------------------------------------------------------------- sinks

SK3_SQL = "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, 1 AS records FROM supplier"


@register("sk3_landing_files", SK3_SQL)
def sk3_landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """SK3: a stream written as landing files of one record each, read back with the records of every file."""
    folder = _folder(spark, "landing")
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                        F.col("s_acctbal").alias("balance")).write.parquet(f"{folder}/in")
    schema = "id long, name string, balance double"
    sinks.write_landing(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/ck").awaitTermination()
    back = spark.read.schema(schema).json(f"{folder}/out").withColumn("_file", F.input_file_name())
    of_file = Window.partitionBy("_file")  # every file is opened once
    return back.select("id", "name", "balance", F.count(F.lit(1)).over(of_file).cast("int").alias("records"))


SK9_SQL = """
SELECT o_orderstatus AS part, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'processed' END AS status, count(*) AS n_rows,
       count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0) AS n_errors,
       round(sum(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice END), 2) AS total
FROM orders GROUP BY o_orderstatus
"""


@register("sk9_file_outcomes", SK9_SQL)
def sk9_file_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """SK9: JSON-lines files read record by record; every file's outcome is an audit row, malformed lines are counted."""
    path = _folder(spark, "audit")
    o = table(spark, sf, "orders")
    text = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    broken = (F.col("o_orderstatus") == "F") & (F.pmod("o_orderkey", F.lit(7)) == 0)
    o.select(F.col("o_orderstatus").alias("part"), F.when(broken, F.substring(text, 1, 9)).otherwise(text).alias("value")) \
        .write.partitionBy("part").text(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType())])
    rows, outcome = files.read_with_outcome(spark, f"{path}/part=*", schema)
    part = F.regexp_extract("file_name", "part=([A-Z])", 1).alias("part")
    logged = sinks.log_files(outcome.filter("status = 'error'"), "error", "malformed records").select(part, "status").distinct()
    per = outcome.groupBy(part).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_errors").alias("n_errors"))
    total = rows.groupBy(part).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return per.join(logged, "part", "left").join(total, "part").select(
        "part", F.coalesce("status", F.lit("processed")).alias("status"), "n_rows", "n_errors", "total")


SK11_SQL = """
SELECT asset_id, count(*) AS n_rows, min(epoch) AS first_time, max(epoch) AS last_time, 300 AS n_anomalies, true AS inside
FROM (SELECT s_name AS asset_id, unnest(range(0, 3600)) AS epoch FROM supplier) GROUP BY asset_id
"""


@register("sk11_generated_gauges", SK11_SQL)
def sk11_generated_gauges(spark: SparkSession, sf: str) -> DataFrame:
    """SK11: an hour of generated gauge rows for every supplier as asset, five minutes of anomalies injected."""
    assets = table(spark, sf, "supplier").select(F.col("s_name").alias("asset_id")).distinct()
    windows = assets.select("asset_id", F.lit(0).alias("n"), F.lit(600).alias("start_time"), F.lit(899).alias("end_time"),
                            F.lit("pressure").alias("column"), F.lit(99.0).alias("value"))
    g = generate.generate_gauge(spark, 0, 3600, assets, {"pressure": (10.0, 20.0), "temperature": (50.0, 60.0)}, anomalies=windows)
    ok = ((F.col("pressure").between(10, 20) | (F.col("pressure") == 99)) & F.col("temperature").between(50, 60))
    return g.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("epoch_timestamp").alias("first_time"),
                                     F.max("epoch_timestamp").alias("last_time"), F.count(F.when(F.col("pressure") == 99, 1)).cast("int").alias("n_anomalies"),
                                     F.every(ok).alias("inside"))


# ---------------------------------------------------------------- day-partitioned tables

SK5_DAYS_SQL = f"""
WITH r AS ({READINGS_SQL}), g AS (SELECT asset_id, parameter, epoch, max(value) AS value FROM r GROUP BY ALL)
SELECT asset_id, parameter, epoch, CASE WHEN asset_id % 7 = 0 THEN value + 0.5 ELSE value END AS value FROM g
UNION ALL SELECT -1, 'new', epoch, 1.0 FROM (SELECT DISTINCT epoch - epoch % {DAY} AS epoch FROM g WHERE asset_id % 7 = 0)
"""


@register("sk5_upsert_days", SK5_DAYS_SQL)
def sk5_upsert_days(spark: SparkSession, sf: str) -> DataFrame:
    """SK5/SK7: updates and new rows merged into the days of a clustered table, each day in many tasks."""
    path = _folder(spark, "days")
    g = readings(spark, sf).groupBy("asset_id", "parameter", "epoch").agg(F.max("value").alias("value"))
    sinks.append_days(g, path, "epoch", ["asset_id", "parameter"])
    changed = g.filter(F.pmod("asset_id", F.lit(7)) == 0).withColumn("value", F.col("value") + 0.5)
    new = changed.select(F.lit(-1).cast("long").alias("asset_id"), F.lit("new").alias("parameter"),
                         (F.col("epoch") - F.pmod("epoch", F.lit(DAY))).alias("epoch"), F.lit(1.0).alias("value")).distinct()
    sinks.upsert_days(spark, path, changed.unionByName(new), ["asset_id", "parameter", "epoch"], "epoch")
    return spark.read.parquet(path).select("asset_id", "parameter", "epoch", "value")


PB7_DAYS_SQL = f"""
WITH f AS ({FIBRE_SQL}), c AS (SELECT max(timestamp) - max(timestamp) % {DAY} - {9 * DAY} AS cut FROM f)
SELECT asset_id, depth, timestamp, value FROM f, c WHERE timestamp >= cut
"""


@register("pb7_drop_days", PB7_DAYS_SQL)
def pb7_drop_days(spark: SparkSession, sf: str) -> DataFrame:
    """PB7: retention of the last ten days of a day-partitioned table: older days are dropped, nothing is rewritten."""
    path = _folder(spark, "retention")
    sinks.append_days(fibre(spark, sf), path, "timestamp", ["asset_id"])
    held = spark.read.parquet(path)
    last = held.agg(F.max("day").alias("d")).first()["d"]
    if last is not None:
        import datetime
        sinks.drop_days_before(spark, path, str(last - datetime.timedelta(days=9)))
    return spark.read.schema(held.schema).parquet(path).select("asset_id", "depth", "timestamp", "value")


# ---------------------------------------------------------------- products, joins, text times, models

PB6_SQL = """
WITH v AS (SELECT r_name AS asset_id, n_nationkey AS depth, n_nationkey * 1.5 AS value FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT asset_id, '{"data":[[' || string_agg(CAST(CAST(value AS DOUBLE) AS VARCHAR), '],[' ORDER BY depth) || ']],"time":[7],"depth":["'
       || string_agg(CAST(depth AS VARCHAR), '","' ORDER BY depth) || '"]}' AS value
FROM v GROUP BY asset_id
"""


@register("pb6_product_documents", PB6_SQL)
def pb6_product_documents(spark: SparkSession, sf: str) -> DataFrame:
    """PB6: matrix products written as one compressed JSON document per asset, read back."""
    v = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("asset_id"), F.col("n_nationkey").alias("depth"), (F.col("n_nationkey") * 1.5).cast("double").alias("value"))
    rows = v.groupBy("asset_id").agg(F.sort_array(F.collect_list(F.struct("depth", "value"))).alias("_d"))
    products = rows.select("asset_id", F.array(F.lit(7).cast("long")).alias("time"), F.transform("_d", lambda x: x["depth"]).alias("depth"),
                           F.transform("_d", lambda x: F.array(x["value"])).alias("data"))
    path = _folder(spark, "products")
    fb.write_products(products, path)
    return spark.read.text(path).select("asset_id", "value")


JN12_SQL = "SELECT o_orderkey AS rule_id, c_name AS name, c_acctbal AS limit_value FROM orders JOIN customer ON o_custkey = c_custkey"


@register("jn12_parsed_headers", JN12_SQL)
def jn12_parsed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """JN12: rules joined to headers whose JSON text is parsed by schema."""
    header = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.to_json(F.struct("c_name", "c_acctbal")).alias("text"))
    rules = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rule_id"), F.col("o_custkey").alias("key"))
    j = joins.with_parsed(rules, header, "key", "text", "c_name string, c_acctbal double")
    return j.select("rule_id", F.col("parsed.c_name").alias("name"), F.col("parsed.c_acctbal").alias("limit_value"))


PJ6_SQL = f"""
SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE floor(epoch(o_orderdate))::BIGINT // {DAY} * {DAY} END AS epoch FROM orders
"""


@register("pj6_text_times", PJ6_SQL)
def pj6_text_times(spark: SparkSession, sf: str) -> DataFrame:
    """PJ6: times written in four text patterns, and some in none of them, parsed to epoch seconds."""
    o = table(spark, sf, "orders")
    d = F.to_timestamp(F.to_date("o_orderdate"))
    text = F.element_at(F.array(F.date_format(d, "yyyy-MM-dd HH:mm:ss"), F.date_format(d, "MM/dd/yyyy"), F.date_format(d, "yyyy-dd-MM"),
                                F.date_format(d, "dd-MMM-yyyy"), F.lit("sometime")), (F.pmod("o_orderkey", F.lit(5)) + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), scalars.parse_epoch(text).alias("epoch"))


ML6_SQL = """
WITH f AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer),
m AS (SELECT f.id, coalesce(balance, (SELECT avg(balance) FROM f)) AS b FROM f)
SELECT id, round((b - (SELECT avg(b) FROM m)) / (SELECT stddev_samp(b) FROM m), 6) AS scaled FROM m
"""


@register("ml6_prepared_features", ML6_SQL)
def ml6_prepared_features(spark: SparkSession, sf: str) -> DataFrame:
    """ML6: mean imputation, indexing, one-hot encoding and scaling; the scaled numeric feature is returned."""
    from pyspark.ml.functions import vector_to_array
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), "c_mktsegment", F.when(F.pmod("c_custkey", F.lit(5)) != 0, F.col("c_acctbal")).alias("balance"))
    fitted = model.prepare_features(c, ["balance"], ["c_mktsegment"])
    return fitted.transform(c).select("id", F.round(vector_to_array("features")[0], 6).alias("scaled"))


CH2_SQL = f"""
SELECT parameter AS sensor_type, count(*) AS n FROM ({READINGS_SQL}) GROUP BY parameter
"""


@register("ch2_sensors_with_data", CH2_SQL)
def ch2_sensors_with_data(spark: SparkSession, sf: str) -> DataFrame:
    """CH2: stages run for sensors that have data only: two named sensors without any are passed over."""
    r = readings(spark, sf)
    parts = [r.filter(F.col("parameter") == s) for s in ("click", "view", "error", "purchase", "signup", "no sensor", "nothing")]
    found = [p for p in parts if lifecycle.has_data(p)]
    counts = [p.groupBy(F.col("parameter").alias("sensor_type")).agg(F.count(F.lit(1)).alias("n")) for p in found]
    out = counts[0] if counts else local_frame(spark, [], "sensor_type string, n long")
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# ---------------------------------------------------------------- exact medians (AG3)

AG3_MEDIAN_MAP = [("all", t) for t in ("click", "view", "error", "purchase", "signup")] + [("clicks", "click"), ("rare", "signup"), ("pair", "view"), ("pair", "error")]
AG3_MEDIAN_SQL = f"""
WITH r AS ({READINGS_SQL}),
m AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in AG3_MEDIAN_MAP)}) AS t(output_tag, parameter))
SELECT output_tag AS tag_id, year(make_timestamp(epoch * 1000000)) AS period, round(median(value), 6) AS value, max(epoch) AS epoch, 'Good' AS quality
FROM r JOIN m USING (parameter) GROUP BY ALL
"""


@register("ag3_hot_medians", AG3_MEDIAN_SQL)
def ag3_hot_medians(spark: SparkSession, sf: str) -> DataFrame:
    """AG3: exact medians of whole tables: one output tag over every reading, one over a single hot tag."""
    r = readings(spark, sf).withColumn("period", F.year(F.timestamp_seconds("epoch")))
    mapping = local_frame(spark, [(a, b, "median") for a, b in AG3_MEDIAN_MAP], "output_tag string, input_tag string, function string")
    st = ag.soft_tags(r, mapping, ["period"], "parameter", "value", "epoch")
    return st.select("tag_id", "period", _r6(), "epoch", "quality")
