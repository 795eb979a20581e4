"""Registered queries: gold refresh and variants, sinks, stream stages in batch
form, model preprocessing, reconciliation, scheduling and text blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import DAY, RUN_END, RUN_START, _r6, register
from .operators import model as ml
from .operators import reconcile as rc
from .operators import resample
from .plans import combine, lifecycle
from .sources import files, sinks
from .streaming import tags as st
from .session import local_frame
from .tables import READINGS_SQL, readings, table

HOUR = 3600

# ---------------------------------------------------------------- GO1 + GO2 + JN8 gap fill

GO1_START, GO1_END = 1705276800, 1705363199  # 2024-01-15, one day of hourly buckets
GO1_SQL = f"""
WITH r AS ({READINGS_SQL}),
b AS (SELECT asset_id, epoch, value, epoch - epoch % {HOUR} AS bucket_start FROM r
      WHERE value IS NOT NULL AND epoch BETWEEN {GO1_START} AND {GO1_END}),
a AS (SELECT asset_id, bucket_start, min({{'v': value, 't': epoch}}) AS mn, max({{'v': value, 't': epoch}}) AS mx,
             sum(value) AS s, count(value) AS c FROM b GROUP BY ALL),
cal AS (SELECT range AS bucket_start FROM range({GO1_START}, {GO1_END + 1}, {HOUR})),
g AS (SELECT k.asset_id, cal.bucket_start FROM (SELECT DISTINCT asset_id FROM a) k CROSS JOIN cal),
f AS (SELECT g.asset_id, g.bucket_start, a.mn, a.mx, a.s, coalesce(a.c, 0) AS c FROM g LEFT JOIN a USING (asset_id, bucket_start))
SELECT asset_id, bucket_start, 'value_min' AS parameter, mn.t AS timestamp, round(mn.v, 6) AS value FROM f WHERE mn IS NOT NULL
UNION ALL SELECT asset_id, bucket_start, 'value_max', mx.t, round(mx.v, 6) FROM f WHERE mx IS NOT NULL
UNION ALL SELECT asset_id, bucket_start, 'value_sum', bucket_start, round(s, 6) FROM f WHERE s IS NOT NULL
UNION ALL SELECT asset_id, bucket_start, 'value_count', bucket_start, CAST(c AS DOUBLE) FROM f
"""


@register("go1_hourly_gap_fill", GO1_SQL)
def go1_hourly_gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    """GO1/GO2/JN8/GO3: one day of hourly gold with a bucket calendar: every asset seen
    that day gets every hour; empty hours keep only count = 0."""
    r = readings(spark, sf, since=GO1_START, until=GO1_END)
    b = resample.assign_bucket(r, "epoch", HOUR, GO1_START, GO1_END, required=["value"])
    g = resample.summarize(b, ["asset_id"], "epoch", ["value"], HOUR, calendar=(GO1_START, GO1_END))
    return g.select("asset_id", "bucket_start", "parameter", "timestamp", _r6())


GO5_SQL = f"""
WITH r AS ({READINGS_SQL}),
a AS (SELECT parameter AS asset_id, CAST(epoch(date_trunc('day', to_timestamp(epoch))) AS BIGINT) AS epoch_timestamp,
             min({{'v': value, 't': epoch}}) AS lv, max({{'v': value, 't': epoch}}) AS hv,
             min({{'v': CAST(k AS DOUBLE), 't': epoch}}) AS lk, max({{'v': CAST(k AS DOUBLE), 't': epoch}}) AS hk
      FROM r GROUP BY ALL)
SELECT epoch_timestamp, asset_id, lv.t AS min_value_epoch_timestamp, lv.v AS min_value,
       hv.t AS max_value_epoch_timestamp, hv.v AS max_value, lk.t AS min_k_epoch_timestamp, lk.v AS min_k,
       hk.t AS max_k_epoch_timestamp, hk.v AS max_k FROM a
"""


@register("go5_wide_daily_summary", GO5_SQL)
def go5_wide_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    """GO5/AG6/AG7: wide gold by calendar day: min/max of two measures with the epoch of each extreme."""
    r = readings(spark, sf).select(F.col("parameter").alias("asset_id"), "epoch", "value",
                                   F.col("k").cast("double").alias("k"))
    return resample.summarize_wide(r, ["asset_id"], "epoch", ["value", "k"], "day")


GO7_OLD_END, GO7_NEW_START = 1706140799, 1705708800  # gold up to Jan 24; refresh from Jan 20


def _gold(spark, sf, since=None, until=None):
    r = readings(spark, sf, since=since, until=until).withColumnRenamed("parameter", "tag")
    return resample.summarize(r, ["asset_id", "tag"], "epoch", ["value"], DAY, name_col="tag").drop("bucket_start")


def _gold_sql(lo: int | None, hi: int | None) -> str:
    cond = " AND ".join(x for x in [f"epoch >= {lo}" if lo else "", f"epoch <= {hi}" if hi else ""] if x) or "TRUE"
    return f"""(WITH r AS ({READINGS_SQL}),
a AS (SELECT asset_id, parameter AS tag, epoch - epoch % {DAY} AS bucket_start,
             min({{'v': value, 't': epoch}}) AS mn, max({{'v': value, 't': epoch}}) AS mx, sum(value) AS s, count(value) AS c
      FROM r WHERE {cond} GROUP BY ALL)
SELECT asset_id, tag, tag || '_min' AS parameter, mn.t AS timestamp, mn.v AS value FROM a
UNION ALL SELECT asset_id, tag, tag || '_max', mx.t, mx.v FROM a
UNION ALL SELECT asset_id, tag, tag || '_sum', bucket_start, s FROM a
UNION ALL SELECT asset_id, tag, tag || '_count', bucket_start, CAST(c AS DOUBLE) FROM a)"""


GO7_SQL = f"""
WITH old AS (SELECT *, timestamp - timestamp % {DAY} AS bucket_start FROM {_gold_sql(None, GO7_OLD_END)}),
new AS (SELECT *, timestamp - timestamp % {DAY} AS bucket_start FROM {_gold_sql(GO7_NEW_START, None)})
SELECT asset_id, tag, parameter, timestamp, round(value, 6) AS value, bucket_start FROM (
  SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.asset_id = old.asset_id AND new.tag = old.tag
        AND new.parameter = old.parameter AND new.bucket_start = old.bucket_start)
  UNION ALL SELECT * FROM new)
"""


@register("go7_refresh_gold", GO7_SQL)
def go7_refresh_gold(spark: SparkSession, sf: str) -> DataFrame:
    """GO7/SK7: gold up to Jan 24 refreshed with a recomputation from Jan 20: overlapping
    buckets replaced (left anti by bucket), new ones appended; idempotent."""
    old = _gold(spark, sf, until=GO7_OLD_END)
    new = _gold(spark, sf, since=GO7_NEW_START)
    out = resample.refresh_gold(old, new, ["asset_id", "tag"], DAY)
    return out.select("asset_id", "tag", "parameter", "timestamp", _r6(), "bucket_start")


@register("go7_refresh_days", GO7_SQL)
def go7_refresh_days(spark: SparkSession, sf: str) -> DataFrame:
    """GO7/SK7 on a table: the days that the recomputation holds are rewritten, the others stay."""
    import uuid
    from .session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorlake-gold-{uuid.uuid4().hex}"
    day = (F.col("timestamp") - F.pmod("timestamp", F.lit(DAY))).alias("bucket_start")
    keys = ["asset_id", "tag"]
    sinks.append_days(_gold(spark, sf, until=GO7_OLD_END).select("asset_id", "tag", "parameter", "timestamp", "value", day), path, "bucket_start", keys)

    def merge(old, new):
        return resample.refresh_gold(old.drop("bucket_start"), new.drop("bucket_start"), keys, DAY)
    new = _gold(spark, sf, since=GO7_NEW_START).select("asset_id", "tag", "parameter", "timestamp", "value", day)
    sinks.refresh_days(spark, path, new, merge, "bucket_start", keys)
    return spark.read.parquet(path).select("asset_id", "tag", "parameter", "timestamp", _r6(), "bucket_start")


GO8_SQL = f"""
WITH g AS (SELECT * FROM {_gold_sql(None, GO7_OLD_END)} UNION ALL SELECT * FROM {_gold_sql(GO7_NEW_START, None)}),
a AS (SELECT asset_id, tag, parameter, timestamp - timestamp % {DAY} AS bucket_start,
             min({{'v': value, 't': timestamp}}) AS lo, max({{'v': value, 't': timestamp}}) AS hi,
             sum(value) AS s, min(timestamp) AS t0 FROM g GROUP BY ALL)
SELECT asset_id, tag, parameter, bucket_start,
       CASE WHEN parameter LIKE '%\\_min' ESCAPE '\\' THEN lo.t WHEN parameter LIKE '%\\_max' ESCAPE '\\' THEN hi.t ELSE t0 END AS timestamp,
       round(CASE WHEN parameter LIKE '%\\_min' ESCAPE '\\' THEN lo.v WHEN parameter LIKE '%\\_max' ESCAPE '\\' THEN hi.v ELSE s END, 6) AS value
FROM a
"""


@register("go8_compact_gold", GO8_SQL)
def go8_compact_gold(spark: SparkSession, sf: str) -> DataFrame:
    """GO8: a gold table holding two overlapping loads compacted to one row per key and bucket
    (min/max by value then time, sum/count added)."""
    g = _gold(spark, sf, until=GO7_OLD_END).unionByName(_gold(spark, sf, since=GO7_NEW_START))
    c = resample.compact_gold(g, ["asset_id", "tag"], DAY)
    return c.select("asset_id", "tag", "parameter", "bucket_start", "timestamp", _r6())


GO9_SIZES = (60, 120, 3600, 21600, 86400)
GO9_SQL = "\nUNION ALL\n".join(
    f"""SELECT {n} AS bucket_size, * FROM (
WITH r AS ({READINGS_SQL}),
a AS (SELECT asset_id, epoch - epoch % {n} AS bucket_start, min({{'v': value, 't': epoch}}) AS mn,
             max({{'v': value, 't': epoch}}) AS mx, sum(value) AS s, count(value) AS c FROM r GROUP BY ALL)
SELECT asset_id, bucket_start, 'value_min' AS parameter, mn.t AS timestamp, round(mn.v, 6) AS value FROM a
UNION ALL SELECT asset_id, bucket_start, 'value_max', mx.t, round(mx.v, 6) FROM a
UNION ALL SELECT asset_id, bucket_start, 'value_sum', bucket_start, round(s, 6) FROM a
UNION ALL SELECT asset_id, bucket_start, 'value_count', bucket_start, CAST(c AS DOUBLE) FROM a)""" for n in GO9_SIZES)


@register("go9_multi_size_gold", GO9_SQL)
def go9_multi_size_gold(spark: SparkSession, sf: str) -> DataFrame:
    """GO9: gold for all five bucket sizes from one scan and one aggregate."""
    r = readings(spark, sf)
    g = resample.gold_products(r, ["asset_id"], "epoch", ["value"], GO9_SIZES)
    return g.select(F.col("bucket_size").cast("int").alias("bucket_size"), "asset_id", "bucket_start",
                    "parameter", "timestamp", _r6())


# ---------------------------------------------------------------- SK5 / SK6 upsert and delete

SK5_SQL = """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, floor(o_totalprice * 1.1 * 100 + 0.5) / 100 AS o_totalprice,
                  o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
UNION ALL SELECT * FROM s
"""


@register("sk5_upsert", SK5_SQL)
def sk5_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """SK5: orders upserted with repriced urgent orders (update matched, insert rest)."""
    o = table(spark, sf, "orders")
    src = o.filter(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_totalprice", F.floor(F.col("o_totalprice") * 1.1 * 100 + 0.5) / 100)
    return sinks.upsert(o, src, ["o_orderkey"])


SK6_SQL = """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""


@register("sk6_delete_matching", SK6_SQL)
def sk6_delete_matching(spark: SparkSession, sf: str) -> DataFrame:
    """SK6: orders after deleting those with a returned line (delete matched by key)."""
    o = table(spark, sf, "orders")
    src = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return sinks.delete_matching(o, src, ["o_orderkey"])


# ---------------------------------------------------------------- streaming stages in batch form

SM1_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT DISTINCT parameter AS tag_id, value, epoch AS timestamp FROM r WHERE epoch > 1704240000
"""


@register("sm1_dedup_within_watermark", SM1_SQL)
def sm1_dedup_within_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """SM1/SM2 (batch form of the stream): replayed copies and rows before the reset date
    dropped; dedup on (tag, value, timestamp)."""
    r = readings(spark, sf)
    ev = r.select(F.col("parameter").alias("tag_id"), "value", F.timestamp_seconds("epoch").alias("timestamp"))
    replay = ev.unionByName(ev.filter(F.col("value") > 50))  # a replayed batch
    out = st.dedup_silver(replay, reset_date="2024-01-03 00:00:00")
    return out.select("tag_id", "value", F.unix_seconds("timestamp").alias("timestamp"))


SM6_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT asset_id, epoch - epoch % {6 * HOUR} AS timestamp, round(avg(value), 6) AS value, round(avg(k), 6) AS k
FROM r GROUP BY ALL
"""


@register("sm6_tumbling_resample", SM6_SQL)
def sm6_tumbling_resample(spark: SparkSession, sf: str) -> DataFrame:
    """SM6: 6-hour tumbling mean of every numeric column per asset (event-time window)."""
    r = readings(spark, sf).select("asset_id", F.timestamp_seconds("epoch").alias("ts"), "value",
                                   F.col("k").cast("double").alias("k"))
    out = st.resample_stream(r, "ts", ["value", "k"], "6 hours", keys=["asset_id"])
    return out.select("asset_id", F.unix_seconds("ts").alias("timestamp"), _r6("value"), _r6("k"))


# ---------------------------------------------------------------- model (ML1-ML5)

ML1_SQL = f"""
WITH RECURSIVE r AS ({READINGS_SQL}),
rs AS (SELECT asset_id, parameter, epoch - epoch % {DAY} AS epoch, avg(value) AS raw FROM r GROUP BY ALL),
h AS (SELECT *, raw BETWEEN 5 AND 60 AS good,
             last(CASE WHEN raw BETWEEN 5 AND 60 THEN {{'t': epoch, 'v': raw}} END IGNORE NULLS)
               OVER (PARTITION BY asset_id, parameter ORDER BY epoch ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS lg
      FROM rs),
h2 AS (SELECT asset_id, parameter, epoch, raw,
              CASE WHEN good THEN raw WHEN epoch - lg.t <= {3 * DAY} THEN lg.v END AS modified FROM h),
m AS (SELECT *, avg(modified) OVER (PARTITION BY asset_id, parameter ORDER BY epoch
                                    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS moving_avg,
             row_number() OVER (PARTITION BY asset_id, parameter ORDER BY epoch) AS i FROM h2),
s AS (SELECT asset_id, parameter, i, moving_avg AS y, moving_avg AS state FROM m WHERE i = 1
      UNION ALL
      SELECT m.asset_id, m.parameter, m.i,
             CASE WHEN m.moving_avg IS NULL THEN NULL WHEN s.state IS NULL THEN m.moving_avg
                  ELSE 0.3 * m.moving_avg + 0.7 * s.state END,
             CASE WHEN m.moving_avg IS NULL THEN s.state WHEN s.state IS NULL THEN m.moving_avg
                  ELSE 0.3 * m.moving_avg + 0.7 * s.state END
      FROM s JOIN m ON m.asset_id = s.asset_id AND m.parameter = s.parameter AND m.i = s.i + 1),
w AS (SELECT m.asset_id, m.parameter, m.epoch, m.raw, m.modified, coalesce(s.y, m.modified) AS filtered,
             m.moving_avg * 0.9 + 1.0 AS predicted FROM m JOIN s USING (asset_id, parameter, i))
SELECT asset_id, parameter, epoch, variable, floor(v * 10000 + 0.3712345678) / 10000 AS v FROM (
  SELECT asset_id, parameter, epoch, 'raw' AS variable, raw AS v FROM w
  UNION ALL SELECT asset_id, parameter, epoch, 'modified', modified FROM w
  UNION ALL SELECT asset_id, parameter, epoch, 'filtered', filtered FROM w
  UNION ALL SELECT asset_id, parameter, epoch, 'predicted', predicted FROM w
  UNION ALL SELECT asset_id, parameter, epoch, 'prediction_bias', filtered - predicted FROM w)
"""


@register("ml1_preprocess_chain", ML1_SQL)
def ml1_preprocess_chain(spark: SparkSession, sf: str) -> DataFrame:
    """ML1/ML3/ML4: daily resample -> range [5, 60] hold-last-good -> moving average ->
    exponential smoothing -> bias vs a linear prediction -> long rows."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    p = ml.preprocess(r, ["asset_id", "parameter"], "epoch", "value", 5.0, 60.0, period=DAY, max_lag=3 * DAY,
                      rows=30, window=5, alpha=0.3)
    p = p.withColumn("predicted", F.col("moving_avg") * 0.9 + 1.0)
    p = ml.bias(p)
    wide = p.select("asset_id", "epoch", *[F.col(c).alias(f"{c}__v") for c in
                                           ("raw", "modified", "filtered", "predicted", "prediction_bias")],
                    "parameter")
    long = ml.to_long(wide, ["asset_id", "parameter", "epoch"],
                      ["raw", "modified", "filtered", "predicted", "prediction_bias"], ["v"])
    # 4 decimals, cut in both engines off the exact halves that the recursion yields
    return long.withColumn("v", F.floor(F.col("v") * 10000 + 0.3712345678) / 10000)


ML2_COEF = [("l_quantity", 12.5), ("l_discount", -300.0), ("l_tax", 150.0), ("__intercept__", 7.0)]
ML2_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(7.0 + CAST(-300.0 AS DOUBLE) * l_discount + CAST(12.5 AS DOUBLE) * l_quantity
             + CAST(150.0 AS DOUBLE) * l_tax, 6) AS predicted FROM lineitem
"""


@register("ml2_linear_prediction", ML2_SQL)
def ml2_linear_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """ML2: prediction from coefficients held as data (model read once -> one select)."""
    li = table(spark, sf, "lineitem")
    coef = local_frame(spark, ML2_COEF, "feature string, coef double")
    p = ml.predict_wide(li, coef)
    return p.select("l_orderkey", "l_linenumber", "l_partkey", _r6("predicted"))


ML5_SQL = """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, regr_count(l_extendedprice, l_quantity) AS n
FROM lineitem GROUP BY l_returnflag
"""


@register("ml5_linear_fit", ML5_SQL)
def ml5_linear_fit(spark: SparkSession, sf: str) -> DataFrame:
    """ML5: least-squares line of price on quantity per return flag (closed form aggregates)."""
    f = ml.linear_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return f.select("l_returnflag", _r6("slope"), _r6("intercept"), _r6("r2"), "n")


# ---------------------------------------------------------------- reconciliation

RC2_SQL = """
WITH c AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')
SELECT o_orderkey FROM c
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F' AND l_discount >= 0.09)
"""


@register("rc2_staged_check", RC2_SQL)
def rc2_staged_check(spark: SparkSession, sf: str) -> DataFrame:
    """RC2: high-priority orders neither marked (returned line) nor flagged (closed line with top discount)."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return rc.staged_check(o, "o_orderkey", "o_orderpriority", ["1", "2"],
                           li, F.col("l_returnflag") == "R",
                           li, (F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.09))


RC3_RULES = [("BRASS", "p_size", "1"), ("^SMALL", "p_brand", "Brand#11"), ("PLATED", "p_container_kind", "BOX")]
RC3_SQL = """
WITH f AS (SELECT p_partkey, p_type, 'p_size' AS attribute, CAST(p_size AS VARCHAR) AS value FROM part
           UNION ALL SELECT p_partkey, p_type, 'p_brand', p_brand FROM part
           UNION ALL SELECT p_partkey, p_type, 'p_container_kind', split_part(p_name, ' ', 1) FROM part),
r AS (SELECT * FROM (VALUES ('BRASS', 'p_size', '1'), ('^SMALL', 'p_brand', 'Brand#11'),
                            ('PLATED', 'p_container_kind', 'BOX')) AS t(pattern, attribute, expected))
SELECT p_partkey, f.attribute, f.value AS actual, r.expected, r.pattern
FROM f JOIN r ON f.attribute = r.attribute
WHERE regexp_matches(p_type, r.pattern) AND f.value IS DISTINCT FROM r.expected
"""


@register("rc3_attribute_rules", RC3_SQL)
def rc3_attribute_rules(spark: SparkSession, sf: str) -> DataFrame:
    """RC3: id-pattern => expected attribute rules over part features; violation rows."""
    p = table(spark, sf, "part")
    f = p.select("p_partkey", "p_type", F.inline(F.array(
        F.struct(F.lit("p_size").alias("attribute"), F.col("p_size").cast("string").alias("value")),
        F.struct(F.lit("p_brand").alias("attribute"), F.col("p_brand").alias("value")),
        F.struct(F.lit("p_container_kind").alias("attribute"), F.split("p_name", " ")[0].alias("value")))))
    rules = local_frame(spark, RC3_RULES, "pattern string, attribute string, expected string")
    return rc.attribute_violations(f, rules, "p_partkey", "p_type")


RC5_SQL = """
SELECT 'lineitem' AS child, 'l_partkey' AS fk, CAST(l_partkey AS VARCHAR) AS value, count(*) AS n_rows
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey
UNION ALL
SELECT 'orders', 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
UNION ALL
SELECT 'labels', 'doc_id', CAST(doc_id AS VARCHAR), count(*) FROM labels
WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents) GROUP BY doc_id
UNION ALL
SELECT 'customer', 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer
WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation) GROUP BY c_nationkey
"""


@register("rc5_foreign_key_report", RC5_SQL)
def rc5_foreign_key_report(spark: SparkSession, sf: str) -> DataFrame:
    """RC4/RC5: orphan foreign keys per declared relation (left anti per key), one report."""
    t = lambda n: table(spark, sf, n)
    parts = [rc.fk_report(t("lineitem"), "lineitem", "l_partkey", t("part"), "p_partkey"),
             rc.fk_report(t("orders"), "orders", "o_custkey", t("customer"), "c_custkey"),
             rc.fk_report(t("labels"), "labels", "doc_id", t("documents"), "doc_id"),
             rc.fk_report(t("customer"), "customer", "c_nationkey", t("nation"), "n_nationkey")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RC6_SQL = """
WITH c AS (SELECT p_partkey, p_type, CASE WHEN regexp_matches(p_type, 'BRASS') THEN 1 ELSE p_size END AS p_size,
                  (regexp_matches(p_type, 'BRASS') AND p_size IS DISTINCT FROM 1) AS corrected, p_brand FROM part)
SELECT p_brand, p_type, min({'c': corrected, 'k': p_partkey, 's': p_size}).k AS p_partkey,
       min({'c': corrected, 'k': p_partkey, 's': p_size}).s AS p_size,
       min({'c': corrected, 'k': p_partkey, 's': p_size}).c AS corrected
FROM c GROUP BY p_brand, p_type
"""


@register("rc6_correct_and_dedupe", RC6_SQL)
def rc6_correct_and_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """RC6: conditional attribute correction, then one row per (brand, type) by preference
    (uncorrected first, then smallest key)."""
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    c = rc.correct(p, [(F.col("p_type").rlike("BRASS"), "p_size", F.lit(1))])
    d = rc.dedupe_by_preference(c.select("p_brand", "p_type", "corrected", "p_partkey", "p_size"),
                                ["p_brand", "p_type"], ["corrected", "p_partkey", "p_size"])
    return d.select("p_brand", "p_type", "p_partkey", "p_size", "corrected")


RC7_SQL = """
SELECT p_partkey, CASE WHEN contains(p_type, 'BRASS') THEN 'brass' WHEN contains(p_type, 'STEEL') THEN 'steel'
                       ELSE 'other' END AS cable_class,
       'CABLE_' || CAST(p_size AS VARCHAR) || '_RIBBON' AS label FROM part
"""


@register("rc7_split_by_pattern", RC7_SQL)
def rc7_split_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """RC7: class per id pattern with a derived label (export split by class)."""
    p = table(spark, sf, "part")
    s = rc.split_by_pattern(p, "p_type", {"brass": "BRASS", "steel": "STEEL"})
    return s.select("p_partkey", "cable_class",
                    F.concat(F.lit("CABLE_"), F.col("p_size").cast("string"), F.lit("_RIBBON")).alias("label"))


# ---------------------------------------------------------------- SR6 text blocks

SR6_SQL = """
WITH l AS (SELECT page_id AS file, unnest(string_split(html, '<')) AS value,
                  generate_subscripts(string_split(html, '<'), 1) AS line_no FROM pages),
t AS (SELECT *, CAST(regexp_matches(value, '^article') AS INTEGER) AS s1, CAST(regexp_matches(value, '^/article') AS INTEGER) AS e1 FROM l),
w AS (SELECT *, sum(s1) OVER (PARTITION BY file ORDER BY line_no) AS s, sum(e1) OVER (PARTITION BY file ORDER BY line_no) AS e FROM t)
SELECT file, line_no, s AS block_id, value FROM w WHERE s > 0 AND e - e1 < s AND s1 = 0 AND e1 = 0
"""


@register("sr6_text_blocks", SR6_SQL)
def sr6_text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """SR6: whole pages split into tag lines; lines between start / end markers become
    numbered blocks per file (running sums per file, files in parallel)."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("file"), "html")
    lines = files.split_lines(pages, "file", "html", sep="<")
    return files.parse_block_text(lines, "^article", "^/article", file_col="file", line_no="line_no", text="value")


# ---------------------------------------------------------------- RU13 / CH1 scheduling

RU13_SPEC = [("click", 900, 0), ("view", 3600, 300), ("purchase", 7200, 0), ("signup", 1800, 60), ("error", 600, 0)]
RU13_EF, RU13_DOWN = 1800, 7200
RU13_SQL = f"""
WITH r AS ({READINGS_SQL}),
m AS (SELECT parameter, max(epoch) AS max_bronze_time, max(epoch) - 5400 AS last_run_time FROM r GROUP BY parameter),
s AS (SELECT * FROM (VALUES {", ".join(f"('{p}', {rf}, {d})" for p, rf, d in RU13_SPEC)}) AS t(parameter, rule_run_frequency, delay)),
b AS (SELECT s.parameter, rule_run_frequency AS rf, delay, CAST(max_bronze_time AS DOUBLE) AS mx,
             greatest(CAST(last_run_time AS DOUBLE), CAST(max_bronze_time AS DOUBLE) - {RU13_DOWN}) AS last FROM s JOIN m USING (parameter)),
c AS (SELECT *, greatest(0.0, (mx - last) / {RU13_EF}.0) AS g, last - delay AS t FROM b),
d AS (SELECT *, t - floor(t / rf) * rf AS mm FROM c)
SELECT parameter,
       CAST(CASE WHEN rf <= {RU13_EF} THEN t - {RU13_EF} - ((t - {RU13_EF}) - floor((t - {RU13_EF}) / rf) * rf)
                 WHEN mm < {RU13_EF} THEN t - mm - rf END AS BIGINT) AS start_time,
       CAST(CASE WHEN rf <= {RU13_EF} OR mm < {RU13_EF} THEN t - mm + {RU13_EF} * g END AS BIGINT) AS end_time,
       CAST(last + {RU13_EF} * g + {RU13_EF} AS BIGINT) AS next_run_time
FROM d
"""


@register("ru13_execution_windows", RU13_SQL)
def ru13_execution_windows(spark: SparkSession, sf: str) -> DataFrame:
    """RU13/CH1/AG14: run bounds per sensor rule from the newest data time, the stored
    last run, rule frequency, delay, engine period and downtime cap (S10)."""
    r = readings(spark, sf)
    m = r.groupBy("parameter").agg(F.max("epoch").alias("max_bronze_time"),
                                   (F.max("epoch") - 5400).alias("last_run_time"))
    spec = local_frame(spark, RU13_SPEC, "parameter string, rule_run_frequency int, delay int")
    w = lifecycle.execution_window(spec.join(m, "parameter"), RU13_EF, RU13_DOWN, now=1706659199)
    return w.select("parameter", "start_time", "end_time", "next_run_time")


# ---------------------------------------------------------------- ST4 / RU11 exact combination

ST4_SQL = f"""
WITH r AS ({READINGS_SQL}),
h AS (SELECT 61 AS rule_id,
             CASE parameter WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS condition_id, asset_id,
             {RUN_START} + {DAY} * CAST(floor((epoch - {RUN_START}) / {DAY}) AS BIGINT) AS start_time
      FROM r WHERE parameter IN ('click', 'view') AND epoch BETWEEN {RUN_START} AND {RUN_END}),
c AS (SELECT DISTINCT rule_id, condition_id, asset_id, start_time, start_time + {DAY} AS end_time FROM h),
p AS (SELECT rule_id, asset_id, start_time, end_time, condition_id, count(*) AS m FROM c GROUP BY ALL)
SELECT rule_id, asset_id, start_time, end_time, CAST(product(m) AS BIGINT) AS combinations FROM p
GROUP BY rule_id, asset_id, start_time, end_time HAVING count(*) = 2
"""


@register("st4_exact_combinations", ST4_SQL)
def st4_exact_combinations(spark: SparkSession, sf: str) -> DataFrame:
    """ST4/ST3/RU11 exact mode: per-asset rule with two event-count conditions (daily cells,
    count >= 1); a cell is an anomaly when every condition holds it; combinations counted,
    not enumerated."""
    from .catalog import SPEC_COLS, _conditions, _run_window
    from .plans import rules as ru
    spec = [(61, 1, "click", "count", ">=", 1.0, DAY, 43200, "and"), (61, 2, "view", "count", ">=", 1.0, DAY, 43200, "and")]
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, spec, SPEC_COLS), r)
    cells = ru.count_cells(r, ru.prepare(c))
    n = c.groupBy("rule_id").agg(F.count_distinct("condition_id").alias("n_conditions"))
    # per-asset rule: combinations are formed inside each asset's scope
    return combine.combine_exact(cells.select("rule_id", "condition_id", "asset_id", "start_time", "end_time"), n,
                                 group=["rule_id", "asset_id"])


# ---------------------------------------------------------------- GO6 since-midnight upsert

GO6_MIDNIGHT = 1705708800  # 2024-01-20 00:00:00 UTC
GO6_SQL = f"""
WITH old AS MATERIALIZED (SELECT * FROM {_gold_sql(None, GO6_MIDNIGHT + DAY - 1)}),
new AS MATERIALIZED (SELECT * FROM {_gold_sql(GO6_MIDNIGHT, None)})
SELECT asset_id, tag, parameter, timestamp, round(coalesce(n.value, o.value), 6) AS value
FROM old o FULL JOIN new n USING (asset_id, tag, parameter, timestamp)
"""


@register("go6_since_midnight_upsert", GO6_SQL)
def go6_since_midnight_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """GO6/SK5: gold loaded through Jan 20, then the since-midnight recomputation (no gap
    fill) upserted by (asset, tag, parameter, timestamp), updating the value only."""
    old = _gold(spark, sf, until=GO6_MIDNIGHT + DAY - 1)
    new = _gold(spark, sf, since=GO6_MIDNIGHT)
    out = sinks.upsert(old, new, ["asset_id", "tag", "parameter", "timestamp"], set_cols=["value"])
    return out.select("asset_id", "tag", "parameter", "timestamp", _r6())


CH1_SQL = f"""
WITH r AS ({READINGS_SQL}),
st AS (SELECT 'wf' AS workflow_id, parameter AS sensor_type, max(epoch) AS last_run_time FROM r GROUP BY parameter),
w AS ({RU13_SQL})
SELECT st.workflow_id, st.sensor_type, coalesce(w.next_run_time, st.last_run_time) AS last_run_time
FROM st LEFT JOIN w ON w.parameter = st.sensor_type
"""


@register("ch1_watermark_state", CH1_SQL)
def ch1_watermark_state(spark: SparkSession, sf: str) -> DataFrame:
    """CH1: first-run state from the newest data per sensor, advanced after a run by each
    sensor rule's next run time (upsert on workflow and sensor)."""
    r = readings(spark, sf)
    state = lifecycle.first_run_state(r, "wf", "parameter", "epoch")
    runs = ru13_execution_windows(spark, sf).select(
        F.lit("wf").alias("workflow_id"), F.col("parameter").alias("sensor_type"), "next_run_time")
    out = lifecycle.advance_watermark(state, runs)
    return out.select("workflow_id", "sensor_type", "last_run_time")


SR8_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag, coalesce(l_discount, 0) AS l_discount FROM lineitem
"""


@register("sr8_delimited_roundtrip", SR8_SQL)
def sr8_delimited_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SR8/PJ16: the line table exported as text with the multi-character separator ';@'
    and no header (to the checkpoint folder), read back with a fixed header list and nulls
    filled with 0."""
    import uuid
    from .session import ensure_checkpoint_dir
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_discount")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorlake-export-{uuid.uuid4().hex}"
    li.write.option("sep", ";@").option("header", "false").csv(path)
    return files.read_delimited(spark, path, ";@", schema="l_orderkey long, l_linenumber int, l_returnflag string, l_discount double")


SR1_SQL = """
SELECT event_type || ':' || CAST(user_id AS VARCHAR) AS tag_id, value,
       CAST(floor(epoch(ts)) AS BIGINT) AS epoch, 'Good' AS quality
FROM events
"""


@register("sr1_landing_roundtrip", SR1_SQL)
def sr1_landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SR1/PJ1/PJ2/SK3: readings packed as landing messages (JSON array bodies, one for an
    asset's ten minutes), written as JSON lines to the checkpoint folder, read back with the landing
    schema and exploded to bronze rows (tag, value, time, quality)."""
    import uuid
    from .session import ensure_checkpoint_dir
    from .sources.files import LANDING_SCHEMA, landing_to_bronze, read_landing
    ev = table(spark, sf, "events")
    item = F.struct(F.col("event_type").alias("nodeId"),
                    F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("displayName"),
                    F.struct(F.col("value").alias("value"),
                             F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                             F.lit("Good").alias("statusCode")).alias("value"))
    # one message per asset and ten minutes
    msgs = (ev.groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "10 minutes").alias("_page"))
              .agg(F.to_json(F.collect_list(item)).alias("body"))
              .select(F.lit("opc").alias("source_module"), "body"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorlake-landing-{uuid.uuid4().hex}"
    msgs.write.json(path)
    bronze = landing_to_bronze(read_landing(spark, path, LANDING_SCHEMA, streaming=False))
    return bronze.select("tag_id", "value", F.unix_seconds("timestamp").alias("epoch"), "quality")


SR2_SINCE = "2024-01-10 00:00:00"
SR2_SQL = f"""
SELECT event_type AS tagId, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, value
FROM events WHERE ts > TIMESTAMP '{SR2_SINCE}' AND event_type <> 'error'
"""


@register("sr2_broker_roundtrip", SR2_SQL)
def sr2_broker_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SK4/SR2: readings sent as binary JSON bodies (tag_id renamed tagId) with an
    enqueued time and a module property; the broker-shaped stream keeps messages after
    the reset time from the wanted module and parses the bodies back."""
    from .functions.scalars import epoch_seconds
    from .sources import broker
    ev = table(spark, sf, "events")
    rows = ev.select(F.col("event_type").alias("tag_id"),
                     epoch_seconds("ts", ev.schema["ts"].dataType).alias("epoch"), "value",
                     F.col("ts").cast("timestamp").alias("enqueuedTime"),
                     F.create_map(F.lit("module"), F.when(F.col("event_type") == "error", F.lit("diag"))
                                  .otherwise(F.lit("opc"))).alias("properties"))
    msgs = broker.to_broker_body(rows, {"tag_id": "tagId"}, cols=["tag_id", "epoch", "value"],
                                 keep=["enqueuedTime", "properties"])
    shaped = broker.shape_broker(msgs, SR2_SINCE, "module", "opc")
    return shaped.select(F.from_json("body", "tagId string, epoch long, value double").alias("r")).select("r.*")


SK10_SQL = """
SELECT event_type AS tag_id, value, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, 'Good' AS quality,
       CAST(floor(epoch(ts)) AS BIGINT) AS last_updated_date
FROM events
"""


@register("sk10_conform_schema", SK10_SQL)
def sk10_conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """SK10: readings brought to a declared table schema: column order and types, defaults
    for the missing quality and last-updated columns."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    schema = StructType([StructField("tag_id", StringType()), StructField("value", DoubleType()),
                         StructField("timestamp", LongType()), StructField("quality", StringType()),
                         StructField("last_updated_date", LongType())])
    r = readings(spark, sf).select(F.col("epoch").alias("timestamp"), "value", F.col("parameter").alias("tag_id"))
    return sinks.conform(r, schema, {"quality": F.lit("Good"), "last_updated_date": F.col("timestamp")})


RU15_D, RU15_T = 3 * DAY, 2.5
RU15_SQL = f"""
WITH r AS ({READINGS_SQL}),
s AS (SELECT asset_id, parameter, epoch, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
      FROM r WINDOW w AS (PARTITION BY asset_id, parameter ORDER BY epoch
                          RANGE BETWEEN {RU15_D} PRECEDING AND 1 PRECEDING))
SELECT 71 AS rule_id, asset_id, epoch AS start_time, epoch AS end_time FROM s
WHERE sd IS NOT NULL AND sd <> 0 AND abs((value - m) / sd) > {RU15_T}
"""


@register("ru15_script_rule", RU15_SQL)
def ru15_script_rule(spark: SparkSession, sf: str) -> DataFrame:
    """RU15/RU16: a script rule (a registered DataFrame function, never code text) over
    every asset: trailing z-score spikes as single-point anomalies."""
    from .plans import scripts
    r = readings(spark, sf)
    rule = {"rule_id": 71, "script": "zscore_spike", "asset_ids": None, "start_time": 0,
            "end_time": 4102444800, "history": RU15_D,  # a run over all data
            "params": {"d": RU15_D, "threshold": RU15_T, "keys": ["parameter"]}}
    return scripts.run_script_rules([rule], r)


# ---------------------------------------------------------------- rules from documents (RU2, RU3, RU10)

RULE_PERIOD = 30 * DAY
#: Parameters of the test readings as sensor families; 'error' readings count as magnitudes.
RULE_FAMILIES = {"click": "series", "view": "series", "purchase": "count", "error": "magnitude"}
#: (offset of the rule id, parameter, function, operator, threshold, duration, unit) of each asset's rules.
RULE_TEXTS = [(1, "click", "Average", ">", 30.0, 2 * DAY, "abs"), (2, "purchase", "raw", ">=", 2.0, 3 * DAY, "abs"),
              (3, "error", "RAW", ">", 100.0, 0, "abs"),
              (4, "view", "differential over a baseline value", "<", -20.0, 0, "abs"),
              (5, "click", "median", ">", 1.0, 0, "abs"), (6, "signup", "raw", ">", 1.0, 0, "abs"),
              (7, "view", "raw", "~", 1.0, 0, "abs")]


def _rule_documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rule documents (seven per asset, three of them faulty), assets, readings and watermarks."""
    r = readings(spark, sf).withColumn("sensor_type", F.lit("events"))
    base = r.filter(F.col("parameter") == "view").groupBy("asset_id").agg(F.min("epoch").alias("b"))
    per = r.select("asset_id").distinct().join(base, "asset_id", "left")
    rules = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("parameter"), F.lit(f).alias("function"), F.lit(o).alias("operator"),
                               F.lit(t).alias("threshold"), F.lit(d).alias("duration"), F.lit(u).alias("unit"))
                      for i, p, f, o, t, d, u in RULE_TEXTS])
    per = per.select("asset_id", "b", F.inline(rules))
    cond = F.struct(F.lit(1).alias("condition_id"), F.lit("c").alias("condition_name"),
                    F.array(F.col("asset_id").cast("string")).alias("asset_id"), "parameter", "operator",
                    F.lit(None).cast("int").alias("class"), "threshold", F.col("duration").cast("int").alias("duration"),
                    F.lit(None).cast("string").alias("wire"), "function", F.lit(None).cast("string").alias("wire_length_from"),
                    F.lit(None).cast("string").alias("wire_length_to"), F.lit(RULE_PERIOD).cast("int").alias("rule_run_frequency"),
                    F.lit("events").alias("sensor_type"), F.col("b").cast("int").alias("baseline_time"), F.col("unit").alias("threshold_unit"))
    docs = per.select((F.col("asset_id") * 10 + F.col("i")).cast("int").alias("rule_id"), F.concat(F.lit("rule "), "parameter").alias("rule_name"),
                      F.lit("t").alias("tenant_id"), F.lit("or").alias("join_condition"), F.lit("high").alias("severity"),
                      F.array().cast("array<int>").alias("risk_register_controls"), F.lit("create").alias("operation"),
                      F.array(cond).alias("conditions"))
    assets = r.select(F.col("asset_id").cast("string").alias("asset_id")).distinct().withColumn("data_frequency", F.lit(43200))
    newest = F.max("epoch")
    state = r.agg((newest - F.pmod(newest, F.lit(RULE_PERIOD)) + 100).alias("last_run_time")).select(
        F.lit("wf").alias("workflow_id"), F.lit("events").alias("sensor_type"), "last_run_time", F.lit(None).cast("timestamp").alias("last_updated_date"))
    return docs, assets, r.withColumn("asset_id", F.col("asset_id").cast("string")), state


def _run_documents(spark: SparkSession, sf: str):
    from .plans import engine
    from .session import cut_lineage
    docs, assets, r, state = _rule_documents(spark, sf)
    docs, assets, state = cut_lineage(docs), cut_lineage(assets), cut_lineage(state)  # tables of their own in a real run
    return engine.run_rules(docs, assets, r, state, "wf", engine_period=1800, downtime=RULE_PERIOD, now=0, families=RULE_FAMILIES)


_WINDOW_SQL = f"""
WITH r AS ({READINGS_SQL}),
t AS (SELECT max(epoch) AS mx, max(epoch) - max(epoch) % {RULE_PERIOD} + 100 AS lr FROM r),
win AS (SELECT CAST(trunc(CAST(lr AS DOUBLE) - 100.0 - {RULE_PERIOD}.0) AS BIGINT) AS lo,
               CAST(trunc(CAST(lr AS DOUBLE) - 100.0 + 1800.0 * ((mx - lr) / 1800.0)) AS BIGINT) AS hi FROM t)"""

RULE_DOC_SQL = _WINDOW_SQL + f""",
lim AS (SELECT 86399 AS l),
fa AS (SELECT DISTINCT asset_id, epoch, avg(value) OVER (PARTITION BY asset_id ORDER BY epoch RANGE BETWEEN CURRENT ROW AND {2 * DAY - 1} FOLLOWING) AS m
       FROM r, win WHERE parameter = 'click' AND epoch BETWEEN lo AND hi),
bt AS (SELECT asset_id, min(epoch) AS b FROM r WHERE parameter = 'view' GROUP BY asset_id),
bv AS (SELECT r.asset_id, max(value) AS bv FROM r JOIN bt ON r.asset_id = bt.asset_id AND r.epoch = bt.b WHERE parameter = 'view' GROUP BY r.asset_id),
h AS (SELECT asset_id * 10 + 1 AS rule_id, asset_id, epoch, {2 * DAY} AS dur FROM fa WHERE m > 30
      UNION ALL
      SELECT r.asset_id * 10 + 4, r.asset_id, epoch, 0 FROM r JOIN bv USING (asset_id), win
      WHERE parameter = 'view' AND epoch BETWEEN lo AND hi AND value - bv < -20),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch - p > 86399 THEN 1 ELSE 0 END) OVER (PARTITION BY rule_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS isl
      FROM (SELECT *, lag(epoch) OVER (PARTITION BY rule_id ORDER BY epoch) AS p FROM h)),
i AS (SELECT rule_id, asset_id, min(epoch) AS s, max(epoch) AS e, any_value(dur) AS dur FROM g GROUP BY rule_id, asset_id, isl),
c AS (SELECT asset_id, CAST(floor((epoch - lo) / {3 * DAY}) AS BIGINT) AS cell, any_value(lo) AS lo FROM r, win
      WHERE parameter = 'purchase' AND epoch BETWEEN lo AND hi GROUP BY ALL HAVING count(*) >= 2)
SELECT CAST(rule_id AS INTEGER) AS rule_id, CAST(asset_id AS VARCHAR) AS asset_id, s AS start_time, e AS end_time FROM i, win
WHERE e - s >= dur OR s = lo - 86399 OR e = hi
UNION ALL
SELECT CAST(asset_id * 10 + 2 AS INTEGER), CAST(asset_id AS VARCHAR), lo + {3 * DAY} * cell, lo + {3 * DAY} * cell + {3 * DAY} FROM c
UNION ALL
SELECT CAST(asset_id * 10 + 3 AS INTEGER), CAST(asset_id AS VARCHAR), epoch, epoch FROM r, win
WHERE parameter = 'error' AND value > 100 AND epoch BETWEEN lo AND hi
"""


@register("ru10_rule_documents", RULE_DOC_SQL)
def ru10_rule_documents(spark: SparkSession, sf: str) -> DataFrame:
    """RU10/PJ9/RU2/RU13: a run over rule documents, four valid ones per asset (average, number of
    events, magnitude, differential over a baseline value), all in one plan."""
    return _run_documents(spark, sf).anomalies.select("rule_id", "asset_id", "start_time", "end_time")


RULE_ERROR_SQL = f"""
WITH a AS (SELECT DISTINCT asset_id FROM ({READINGS_SQL}))
SELECT CAST(asset_id * 10 + 5 AS INTEGER) AS rule_id, 'unknown function' AS error, 'click median >' AS detail FROM a
UNION ALL SELECT CAST(asset_id * 10 + 6 AS INTEGER), 'unknown parameter', 'signup raw >' FROM a
UNION ALL SELECT CAST(asset_id * 10 + 7 AS INTEGER), 'unknown operator', 'view raw ~' FROM a
"""


@register("ru3_rule_errors", RULE_ERROR_SQL)
def ru3_rule_errors(spark: SparkSession, sf: str) -> DataFrame:
    """RU3: the same documents' error rows: unknown function, parameter and operator."""
    return _run_documents(spark, sf).errors


RULE_STATE_SQL = _WINDOW_SQL + """
SELECT 'wf' AS workflow_id, 'events' AS sensor_type,
       CAST(trunc(CAST(lr AS DOUBLE) + 1800.0 * ((mx - lr) / 1800.0) + 1800.0) AS BIGINT) AS last_run_time FROM t
"""


@register("ru13_run_watermark", RULE_STATE_SQL)
def ru13_run_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """RU13/CH1: the watermark after that run."""
    return _run_documents(spark, sf).state.select("workflow_id", "sensor_type", "last_run_time")


def _spec_conditions(spark: SparkSession, r: DataFrame, rows: list[tuple], cols: str) -> DataFrame:
    from .catalog import _conditions, _run_window
    return _run_window(_conditions(spark, rows, cols), r)


RU8_AND_SQL = f"""
WITH r AS (SELECT asset_id, parameter, epoch - epoch % {DAY} AS epoch, value FROM ({READINGS_SQL}))
SELECT 44 AS rule_id, asset_id, epoch AS start_time, epoch AS end_time
FROM r WHERE parameter IN ('error', 'view') AND value > 20 GROUP BY asset_id, epoch HAVING count(DISTINCT parameter) = 2
"""


@register("ru8_magnitude_and", RU8_AND_SQL)
def ru8_magnitude_and(spark: SparkSession, sf: str) -> DataFrame:
    """RU8 with AND: both conditions hit at the same time (days here), however many readings each has then."""
    from .plans import rules as ru
    r = readings(spark, sf).withColumn("epoch", F.col("epoch") - F.pmod("epoch", F.lit(DAY)))
    from .catalog import SPEC_COLS
    c = _spec_conditions(spark, r, [(44, 1, "error", "magnitude", ">", 20.0, 0, 43200, "and"),
                                    (44, 2, "view", "magnitude", ">", 20.0, 0, 43200, "and")], SPEC_COLS)
    return ru.evaluate(r, c)


RU11_EXACT_SQL = f"""
WITH r AS (SELECT asset_id, parameter, epoch - epoch % {DAY} AS epoch, value FROM ({READINGS_SQL})),
h AS (SELECT DISTINCT asset_id, parameter, epoch FROM r WHERE parameter IN ('click', 'view') AND value > 20),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch - p > {2 * DAY - 1} THEN 1 ELSE 0 END) OVER (PARTITION BY asset_id, parameter ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS isl
      FROM (SELECT *, lag(epoch) OVER (PARTITION BY asset_id, parameter ORDER BY epoch) AS p FROM h)),
i AS (SELECT asset_id, parameter, min(epoch) AS s, max(epoch) AS e FROM g GROUP BY asset_id, parameter, isl)
SELECT 53 AS rule_id, asset_id, s AS start_time, e AS end_time FROM i GROUP BY asset_id, s, e HAVING count(DISTINCT parameter) = 2
"""


@register("ru11_exact_mode", RU11_EXACT_SQL)
def ru11_exact_mode(spark: SparkSession, sf: str) -> DataFrame:
    """RU11 exact mode through the rule evaluation: intervals that both conditions hold alike."""
    from .catalog import SPEC_COLS
    from .plans import rules as ru
    r = readings(spark, sf).withColumn("epoch", F.col("epoch") - F.pmod("epoch", F.lit(DAY)))
    c = _spec_conditions(spark, r, [(53, 1, "click", "raw", ">", 20.0, 0, DAY, "and"), (53, 2, "view", "raw", ">", 20.0, 0, DAY, "and")], SPEC_COLS)
    return ru.evaluate(r, c, mode="exact")


FIBRE_COLS = ("rule_id int, condition_id int, parameter string, function string, operator string, threshold double, duration long, "
              "data_frequency long, join_condition string, threshold_unit string, baseline_time long, wire string, depth_from long, depth_to long")


def _fibre_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings as fibre profiles: time in hours, depth = class, one wire."""
    r = readings(spark, sf)
    return r.select("asset_id", "parameter", (F.col("epoch") - F.pmod("epoch", F.lit(3600))).alias("epoch"), "value", "k",
                    F.col("k").alias("depth"), F.lit("1").alias("wire"))


RU9_ENGINE_SQL = f"""
WITH r AS (SELECT asset_id, parameter, epoch - epoch % 3600 AS epoch, value, k AS depth FROM ({READINGS_SQL})),
p AS (SELECT asset_id, parameter, epoch, avg(value) AS a, min(value) AS lo, max(value) AS hi FROM r
      WHERE depth BETWEEN 10 AND 60 GROUP BY ALL),
bt AS (SELECT min(epoch) AS b FROM r),
d AS (SELECT DISTINCT c.asset_id, c.epoch FROM r c JOIN (SELECT asset_id, depth, max(value) AS bv FROM r, bt WHERE epoch = b AND parameter = 'click' GROUP BY ALL) b USING (asset_id, depth)
      WHERE c.parameter = 'click' AND c.value - b.bv < 0),
g AS (SELECT *, sum(CASE WHEN q IS NULL OR epoch - q > {2 * DAY - 1} THEN 1 ELSE 0 END) OVER (PARTITION BY asset_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS isl
      FROM (SELECT *, lag(epoch) OVER (PARTITION BY asset_id ORDER BY epoch) AS q FROM d))
SELECT 81 AS rule_id, asset_id, epoch AS start_time, epoch AS end_time FROM (SELECT DISTINCT asset_id, epoch FROM r WHERE parameter = 'click' AND depth BETWEEN 10 AND 60 AND value > 80)
UNION ALL SELECT 82, asset_id, epoch, epoch FROM p WHERE parameter = 'view' AND a > 40
UNION ALL SELECT 83, asset_id, epoch, epoch FROM p WHERE parameter = 'view' AND lo < 2
UNION ALL SELECT 84, asset_id, epoch, epoch FROM p WHERE parameter = 'error' AND hi >= 60
UNION ALL SELECT 85, asset_id, min(epoch), max(epoch) FROM g GROUP BY asset_id, isl
UNION ALL SELECT 86, x.asset_id, x.epoch, x.epoch FROM p x JOIN p y USING (asset_id, epoch)
  WHERE x.parameter = 'click' AND x.a > 10 AND y.parameter = 'view' AND y.a > 10
"""


@register("ru9_fibre_rule_engine", RU9_ENGINE_SQL)
def ru9_fibre_rule_engine(spark: SparkSession, sf: str) -> DataFrame:
    """RU9 in the rule evaluation: raw, average, minimum, maximum over a depth range of a wire,
    differential by depth with islands, and AND of two at the same time."""
    from .plans import rules as ru
    from .catalog import _conditions, _run_window
    r = _fibre_readings(spark, sf)
    rows = [(81, 1, "click", "fibre_raw", ">", 80.0, 0, DAY, "or", None, None, "1", 10, 60),
            (82, 1, "view", "fibre_avg", ">", 40.0, 0, DAY, "or", None, None, "1", 10, 60),
            (83, 1, "view", "fibre_min", "<", 2.0, 0, DAY, "or", None, None, "1", 10, 60),
            (84, 1, "error", "fibre_max", ">=", 60.0, 0, DAY, "or", None, None, "1", 10, 60),
            (85, 1, "click", "fibre_differential", "<", 0.0, 0, DAY, "or", "abs", None, "1", None, None),
            (86, 1, "click", "fibre_avg", ">", 10.0, 0, DAY, "and", None, None, "1", 10, 60),
            (86, 2, "view", "fibre_avg", ">", 10.0, 0, DAY, "and", None, None, "1", 10, 60)]
    c = _run_window(_conditions(spark, rows, FIBRE_COLS), r)
    first = r.select(F.min("epoch")).scalar()
    c = c.withColumn("baseline_time", F.when(F.col("function") == "fibre_differential", first))
    return ru.evaluate(r, c)


HUNDRED_AVG_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS (SELECT CAST(id AS INTEGER) AS rule_id, CAST(id / 2 AS DOUBLE) AS threshold FROM range(1, 101) t(id)),
fa AS (SELECT DISTINCT asset_id, epoch, avg(value) OVER (PARTITION BY asset_id ORDER BY epoch RANGE BETWEEN CURRENT ROW AND {DAY - 1} FOLLOWING) AS m
       FROM r WHERE parameter = 'click'),
h AS (SELECT rule_id, asset_id, epoch FROM fa JOIN spec ON m > threshold),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch - p > 86399 THEN 1 ELSE 0 END) OVER (PARTITION BY rule_id, asset_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS isl
      FROM (SELECT *, lag(epoch) OVER (PARTITION BY rule_id, asset_id ORDER BY epoch) AS p FROM h))
SELECT rule_id, asset_id, min(epoch) AS start_time, max(epoch) AS end_time FROM g GROUP BY rule_id, asset_id, isl
HAVING max(epoch) - min(epoch) >= {DAY} OR max(epoch) = {RUN_END} OR min(epoch) = {RUN_START} - 86399
"""


@register("ru5_hundred_averages", HUNDRED_AVG_SQL)
def ru5_hundred_averages(spark: SparkSession, sf: str) -> DataFrame:
    """RU5/RU10: 100 average rules that differ in their threshold: one sliding mean for all of them."""
    from .catalog import SPEC_COLS, _conditions, _run_window
    from .plans import rules as ru
    r = readings(spark, sf)
    spec = [(i, 1, "click", "avg", ">", i / 2, DAY, 43200, "or") for i in range(1, 101)]
    return ru.evaluate(r, _run_window(_conditions(spark, spec, SPEC_COLS), r))


# ---------------------------------------------------------------- further green rows

@register("ru12_rule_headers", """
SELECT CAST(l_orderkey AS INTEGER) AS rule_id, min(l_returnflag) AS severity,
       list(DISTINCT CAST(l_linenumber AS INTEGER) ORDER BY CAST(l_linenumber AS INTEGER)) AS condition_ids,
       to_json(list({'condition_id': CAST(l_linenumber AS INTEGER), 'parameter': l_returnflag, 'operator': '>', 'threshold': l_quantity,
                     'duration': CAST(l_suppkey AS INTEGER), 'function': 'raw'} ORDER BY l_linenumber, l_returnflag, l_quantity, l_suppkey)) AS conditions_json
FROM lineitem GROUP BY l_orderkey
""")
def ru12_rule_headers(spark: SparkSession, sf: str) -> DataFrame:
    """RU12: per rule (order) the payload header with its conditions (lines) as JSON."""
    li = table(spark, sf, "lineitem")
    cond = li.select(F.col("l_orderkey").cast("int").alias("rule_id"), F.col("l_linenumber").cast("int").alias("condition_id"),
                     F.col("l_returnflag").alias("parameter"), F.lit(">").alias("operator"), F.col("l_quantity").alias("threshold"),
                     F.col("l_suppkey").cast("int").alias("duration"), F.lit("raw").alias("function"))
    rules = li.groupBy(F.col("l_orderkey").cast("int").alias("rule_id")).agg(
        F.min("l_returnflag").alias("severity")).withColumn("risk_register_controls", F.array().cast("array<int>"))
    return lifecycle.rule_headers(cond, rules).select("rule_id", "severity", "condition_ids", "conditions_json")


@register("ru1_rule_changes", """
WITH o AS (SELECT o_orderkey AS rule_id, o_orderpriority AS rule_name, o_orderstatus AS s FROM orders),
inc AS (SELECT c_custkey AS rule_id, c_name AS rule_name,
               CASE c_custkey % 3 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'create' END AS operation FROM customer)
SELECT rule_id, rule_name FROM o WHERE rule_id NOT IN (SELECT rule_id FROM inc WHERE operation <> 'create')
UNION ALL SELECT rule_id, rule_name FROM inc WHERE operation = 'update'
UNION ALL SELECT rule_id, rule_name FROM inc WHERE operation = 'create' AND rule_id NOT IN (SELECT rule_id FROM o)
""")
def ru1_rule_changes(spark: SparkSession, sf: str) -> DataFrame:
    """RU1: change documents (customers) applied to a rule table (orders): delete, update, create."""
    op = F.when(F.col("c_custkey") % 3 == 0, "delete").when(F.col("c_custkey") % 3 == 1, "update").otherwise("create")
    existing = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rule_id"), F.col("o_orderpriority").alias("rule_name"))
    inc = table(spark, sf, "customer").select(F.col("c_custkey").alias("rule_id"), F.col("c_name").alias("rule_name"),
                                              op.alias("operation"), F.lit("f1").alias("file_name"))
    return lifecycle.apply_rule_changes(existing, inc)


@register("wn11_combination_ids", """
SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS INTEGER) AS combination_id
FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def wn11_combination_ids(spark: SparkSession, sf: str) -> DataFrame:
    """WN11: stable ids of the distinct (brand, type) combinations."""
    from .operators import windows as wn
    return wn.combination_ids(table(spark, sf, "part").select("p_brand", "p_type").distinct(), ["p_brand", "p_type"])


@register("go4_two_measures", f"""
WITH a AS (SELECT l_suppkey, CAST(floor(epoch(l_shipdate)) AS BIGINT) - CAST(floor(epoch(l_shipdate)) AS BIGINT) % {30 * DAY} AS bucket_start,
                  CAST(floor(epoch(l_shipdate)) AS BIGINT) AS t, l_quantity AS q, l_extendedprice AS p FROM lineitem),
g AS (SELECT l_suppkey, bucket_start, min({{'v': q, 't': t}}) AS qlo, max({{'v': q, 't': t}}) AS qhi, sum(q) AS qs, count(q) AS qc,
             min({{'v': p, 't': t}}) AS plo, max({{'v': p, 't': t}}) AS phi, sum(p) AS ps, count(p) AS pc FROM a GROUP BY l_suppkey, bucket_start)
SELECT l_suppkey, bucket_start, 'l_quantity_min' AS parameter, qlo.t AS timestamp, round(qlo.v, 2) AS value FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_quantity_max', qhi.t, round(qhi.v, 2) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_quantity_sum', bucket_start, round(qs, 2) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_quantity_count', bucket_start, CAST(qc AS DOUBLE) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_extendedprice_min', plo.t, round(plo.v, 2) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_extendedprice_max', phi.t, round(phi.v, 2) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_extendedprice_sum', bucket_start, round(ps, 2) FROM g
UNION ALL SELECT l_suppkey, bucket_start, 'l_extendedprice_count', bucket_start, CAST(pc AS DOUBLE) FROM g
""")
def go4_two_measures(spark: SparkSession, sf: str) -> DataFrame:
    """GO4: gold of two measures of wide rows in one pass."""
    from .functions.scalars import epoch_seconds
    li = table(spark, sf, "lineitem")
    rows = li.select("l_suppkey", epoch_seconds("l_shipdate", li.schema["l_shipdate"].dataType).alias("t"), "l_quantity", "l_extendedprice")
    g = resample.summarize(rows, ["l_suppkey"], "t", ["l_quantity", "l_extendedprice"], 30 * DAY)
    return g.select("l_suppkey", "bucket_start", "parameter", "timestamp", F.round("value", 2).alias("value"))
