"""Registered queries: aggregations, joins, set operators and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import DAY, _r6, register
from .operators import aggregates as ag
from .operators import joins as jn
from .operators import windows as wn
from .session import local_frame
from .tables import FIBRE_SQL, READINGS_SQL, fibre, readings, table

HOUR = 3600

# ---------------------------------------------------------------- AG1 + AG2 + PJ4

AG2_TAGS = ("click", "view", "purchase")

AG2_SQL = f"""
WITH r AS ({READINGS_SQL}),
f AS (SELECT * FROM r WHERE parameter IN ('click', 'view', 'purchase') AND NOT isnan(value)),
d AS (SELECT parameter, value, epoch - epoch % {HOUR} AS batch, max(epoch) AS epoch FROM f GROUP BY ALL),
p AS (SELECT batch, max(CASE WHEN parameter = 'click' THEN value END) AS tag_click,
             max(CASE WHEN parameter = 'view' THEN value END) AS tag_view,
             max(CASE WHEN parameter = 'purchase' THEN value END) AS tag_purchase, max(epoch) AS timestamp
      FROM d GROUP BY batch)
SELECT batch, 'derived_inerts' AS tag_id, round(100.0 - tag_click - tag_view - tag_purchase, 6) AS value,
       timestamp, 'Good' AS quality FROM p
"""


@register("ag2_pivot_soft_tag", AG2_SQL)
def ag2_pivot_soft_tag(spark: SparkSession, sf: str) -> DataFrame:
    """PJ4/AG1/AG2: whitelist + NaN drop, dedup-aggregate, pivot three tags per hourly batch,
    derived tag = 100 - a - b - c (null when a tag is absent)."""
    r = readings(spark, sf)
    f = r.filter(F.col("parameter").isin(*AG2_TAGS) & ~F.isnan("value")).withColumn("batch", F.col("epoch") - F.col("epoch") % HOUR)
    d = f.groupBy("parameter", "value", "batch").agg(F.max("epoch").alias("epoch"))
    last = ag.dedup_aggregate(f, "parameter", "value", "batch", "epoch").withColumnRenamed("epoch", "timestamp")
    p = ag.pivot_tags(d, ["batch"], "parameter", "value", AG2_TAGS, {t: f"tag_{t}" for t in AG2_TAGS})
    out = p.join(last, "batch")
    return out.select("batch", F.lit("derived_inerts").alias("tag_id"),
                      F.round(100.0 - F.col("tag_click") - F.col("tag_view") - F.col("tag_purchase"), 6).alias("value"),
                      "timestamp", F.lit("Good").alias("quality"))


# ---------------------------------------------------------------- AG3 soft tags

AG3_MAP = [("engagement_avg", "click", "average"), ("engagement_avg", "view", "average"),
           ("order_peak", "purchase", "maximum"), ("order_peak", "signup", "maximum"),
           ("error_median", "error", "median"),
           ("conversion_rate", "purchase", "sum"), ("conversion_rate", "signup", "sum")]

AG3_SQL = f"""
WITH r AS ({READINGS_SQL}),
m AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in AG3_MAP)}) AS t(output_tag, input_tag, function)),
j AS (SELECT r.asset_id, r.epoch - r.epoch % {6 * HOUR} AS window_start, r.epoch, r.value, m.output_tag, m.function
      FROM r JOIN m ON r.parameter = m.input_tag),
a AS (SELECT asset_id, window_start, output_tag, any_value(function) AS fn, avg(value) AS av, max(value) AS mx,
             median(value) AS md, sum(value) AS sm, max(epoch) AS epoch FROM j GROUP BY ALL)
SELECT asset_id, window_start, output_tag AS tag_id,
       round(CASE fn WHEN 'average' THEN av WHEN 'maximum' THEN mx WHEN 'median' THEN md ELSE sm END, 6) AS value,
       epoch, 'Good' AS quality FROM a
"""


@register("ag3_soft_tags", AG3_SQL)
def ag3_soft_tags(spark: SparkSession, sf: str) -> DataFrame:
    """AG3: average / maximum / median / sum-rate soft tags per asset and 6-hour window, one aggregate."""
    r = readings(spark, sf).withColumn("window_start", F.col("epoch") - F.col("epoch") % (6 * HOUR))
    m = local_frame(spark, AG3_MAP, "output_tag string, input_tag string, function string")
    st = ag.soft_tags(r, m, ["asset_id", "window_start"], "parameter", "value", "epoch")
    return st.select("asset_id", "window_start", "tag_id", _r6(), "epoch", "quality")


# ---------------------------------------------------------------- AG4 linear soft sensor

AG4_COEF = [("click", 0.5), ("view", -0.25), ("purchase", 1.5)]

AG4_SQL = f"""
WITH r AS ({READINGS_SQL}),
c AS (SELECT * FROM (VALUES {", ".join(f"('{t}', {k})" for t, k in AG4_COEF)}) AS t(tag, coef)),
a AS (SELECT r.asset_id, r.epoch - r.epoch % {DAY} AS day, sum(c.coef * r.value) AS s, count(DISTINCT r.parameter) AS k
      FROM r JOIN c ON r.parameter = c.tag GROUP BY ALL)
SELECT asset_id, day, round(CASE WHEN k = 3 THEN (s + 5.0) / (1.0 + abs(s + 5.0)) END, 6) AS value FROM a
"""


@register("ag4_linear_soft_sensor", AG4_SQL)
def ag4_linear_soft_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """AG4: sum(coef * tag) + 5 per asset and day, then a ratio transform x / (1 + |x|)."""
    r = readings(spark, sf).withColumn("day", F.col("epoch") - F.col("epoch") % DAY)
    coef = local_frame(spark, AG4_COEF, "tag string, coef double")
    out = ag.linear_soft_sensor(r, coef, ["asset_id", "day"], "parameter", "value", 5.0,
                                transform=lambda v: v / (1.0 + F.abs(v)))
    return out.select("asset_id", "day", _r6())


# ---------------------------------------------------------------- AG9 fibre group having

AG9_SQL = f"""
WITH f AS ({FIBRE_SQL})
SELECT asset_id, timestamp, round(avg(value), 6) AS agg_value FROM f
WHERE depth BETWEEN 10 AND 60 GROUP BY asset_id, timestamp HAVING avg(value) > 40
"""


@register("ag9_depth_range_having", AG9_SQL)
def ag9_depth_range_having(spark: SparkSession, sf: str) -> DataFrame:
    """AG9/RU9: fibre profile per (asset, timestamp): avg over depth 10..60 having avg > 40."""
    f = fibre(spark, sf)
    g = ag.group_having(f, ["asset_id", "timestamp"], "value", "avg", ">", 40.0,
                        where=F.col("depth").between(10, 60))
    return g.select("asset_id", "timestamp", _r6("agg_value"))


# ---------------------------------------------------------------- AG10 / AG11 arrays

AG10_SQL = """
WITH e AS (SELECT label, vec_id - vec_id % 100 AS day, vec_id AS time, v, pos - 1 AS d
           FROM (SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
           WHERE v IS NOT NULL),
a AS (SELECT label, day, min({'v': v, 't': time, 'd': d}) AS lo, max({'v': v, 't': time, 'd': d}) AS hi,
             sum(v) AS s, count(v) AS c FROM e GROUP BY label, day)
SELECT label, day, CAST(lo.v AS DOUBLE) AS min_value, lo.t AS min_time, CAST(lo.d AS INTEGER) AS min_depth,
       CAST(hi.v AS DOUBLE) AS max_value, hi.t AS max_time, CAST(hi.d AS INTEGER) AS max_depth,
       round(s, 4) AS sum_value, c AS count_value FROM a
"""


@register("ag10_array_extremes", AG10_SQL)
def ag10_array_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """AG10/WN10: explode value arrays; per (label, bucket of 100 ids): min/max with where (position)
    and when (id), sum and count."""
    e = table(spark, sf, "embeddings").withColumn("day", F.col("vec_id") - F.col("vec_id") % 100)
    a = ag.array_extremes(e, ["label", "day"], "vec_id", "embedding", None)
    return a.select("label", "day", F.col("min_value").cast("double").alias("min_value"),
                    F.col("min_time").alias("min_time"), F.col("min_depth").cast("int").alias("min_depth"),
                    F.col("max_value").cast("double").alias("max_value"), "max_time",
                    F.col("max_depth").cast("int").alias("max_depth"),
                    F.round("sum_value", 4).alias("sum_value"), "count_value")


AG11_SQL = """
WITH e AS (SELECT label, vec_id - vec_id % 50 AS minute, unnest(embedding) AS v,
                  generate_subscripts(embedding, 1) AS pos FROM embeddings),
a AS (SELECT label, minute, pos, avg(v) AS av FROM e GROUP BY ALL)
SELECT label, minute, list(round(av, 6) ORDER BY pos) AS data FROM a GROUP BY label, minute
"""


@register("ag11_array_average", AG11_SQL)
def ag11_array_average(spark: SparkSession, sf: str) -> DataFrame:
    """AG11: element-wise average of vectors per (label, bucket of 50 ids)."""
    e = table(spark, sf, "embeddings").withColumn("minute", F.col("vec_id") - F.col("vec_id") % 50)
    a = ag.array_average(e, ["label", "minute"], "embedding")
    return a.select("label", "minute", F.transform("data", lambda x: F.round(x, 6)).alias("data"))


# ---------------------------------------------------------------- AG12 / AG13 / AG14 / AG15 / AG16 / AG17

AG12_SQL = """
SELECT o.o_custkey, list_sort(list_distinct(list(l.l_returnflag))) AS return_flags,
       list_sort(list_distinct(list(o.o_orderstatus))) AS statuses
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey
"""


@register("ag12_distinct_lists", AG12_SQL)
def ag12_distinct_lists(spark: SparkSession, sf: str) -> DataFrame:
    """AG12: sorted distinct lists per customer (bounded domains)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    a = j.groupBy("o_custkey").agg(F.sort_array(F.collect_set("l_returnflag")).alias("return_flags"),
                                   F.sort_array(F.collect_set("o_orderstatus")).alias("statuses"))
    return a


AG13_SQL = """
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, n.n, CASE WHEN n.n = 1 THEN 'single' ELSE 'multi' END AS kind
FROM orders o JOIN n ON n.l_orderkey = o.o_orderkey
"""


@register("ag13_single_multi", AG13_SQL)
def ag13_single_multi(spark: SparkSession, sf: str) -> DataFrame:
    """AG13: orders with one line vs several (HAVING = 1 / > 1) joined back by key."""
    li = table(spark, sf, "lineitem").select("l_orderkey")
    m = ag.multiplicity(li, ["l_orderkey"])
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(m, o.o_orderkey == m.l_orderkey).select("o_orderkey", "n", "kind")


AG14_SQL = f"""
WITH r AS ({READINGS_SQL}), p AS (SELECT parameter, max(epoch) AS max_time FROM r GROUP BY parameter)
SELECT parameter, max_time, (SELECT min(max_time) FROM p) AS min_of_max FROM p
"""


@register("ag14_min_of_max_time", AG14_SQL)
def ag14_min_of_max_time(spark: SparkSession, sf: str) -> DataFrame:
    """AG14: latest time per sensor type and the earliest of those (run watermark)."""
    return ag.min_of_max(readings(spark, sf), "parameter", "epoch")


AG15_SQL = """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10
"""


@register("ag15_top10", AG15_SQL)
def ag15_top10(spark: SparkSession, sf: str) -> DataFrame:
    """AG15: top 10 parts by line count (ties by key)."""
    return ag.top_n(table(spark, sf, "lineitem"), "l_partkey", 10)


AG16_SQL = """
SELECT sha256(text) AS text_sha, count(*) AS n_copies, min(doc_id) AS min_doc_id
FROM documents GROUP BY text HAVING count(*) > 1
"""


@register("ag16_duplicate_texts", AG16_SQL)
def ag16_duplicate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """AG16: exact duplicate documents (whole text, by SHA-256), copy count and first id."""
    # group on the 256-bit digest: whole texts are hashed where they are read and never shuffled
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"))
    return ag.duplicates(d, ["text_sha"], "doc_id").select("text_sha", "n_copies", "min_doc_id")


AG17_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT DISTINCT asset_id, parameter, epoch - epoch % {DAY} AS day FROM r
"""


@register("ag17_drop_duplicates", AG17_SQL)
def ag17_drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """AG17: dropDuplicates on (asset, tag, day)."""
    r = readings(spark, sf).withColumn("day", F.col("epoch") - F.col("epoch") % DAY)
    return r.dropDuplicates(["asset_id", "parameter", "day"]).select("asset_id", "parameter", "day")


# ---------------------------------------------------------------- ST2 / ST3

ST3_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT asset_id, epoch - epoch % {DAY} AS start_time, CAST(NULL AS BIGINT) AS end_time FROM r WHERE parameter = 'click'
INTERSECT
SELECT asset_id, epoch - epoch % {DAY}, CAST(NULL AS BIGINT) FROM r WHERE parameter = 'view'
"""


@register("st3_intersect_typed_null", ST3_SQL)
def st3_intersect_typed_null(spark: SparkSession, sf: str) -> DataFrame:
    """ST3/S5: INTERSECT of (asset, day) interval sets with a typed null end (nulls compare equal)."""
    r = readings(spark, sf)

    def side(tag):
        return r.filter(F.col("parameter") == tag).select(
            "asset_id", (F.col("epoch") - F.col("epoch") % DAY).alias("start_time"),
            F.lit(None).cast("long").alias("end_time"))
    return side("click").intersect(side("view"))


ST2_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT DISTINCT asset_id, start_time FROM (
  SELECT asset_id, epoch - epoch % {DAY} AS start_time FROM r WHERE parameter = 'error' AND value > 30
  UNION ALL
  SELECT asset_id, epoch - epoch % {DAY} FROM r WHERE parameter = 'signup' AND value > 30)
"""


@register("st2_union_distinct", ST2_SQL)
def st2_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """ST2: OR of two conditions as UNION ALL then DISTINCT (group form)."""
    r = readings(spark, sf)

    def side(tag):
        return r.filter((F.col("parameter") == tag) & (F.col("value") > 30)).select(
            "asset_id", (F.col("epoch") - F.col("epoch") % DAY).alias("start_time"))
    return side("error").unionByName(side("signup")).distinct()


# ---------------------------------------------------------------- joins

JN2_SQL = """
SELECT c_custkey, c_nationkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
"""


@register("jn2_left_anti", JN2_SQL)
def jn2_left_anti(spark: SparkSession, sf: str) -> DataFrame:
    """JN2/JN3/SK6: customers without orders (left anti)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return jn.exclude(c, o, "c_custkey")


JN1_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, n.n_name
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
"""


@register("jn1_dimension_enrich", JN1_SQL)
def jn1_dimension_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """JN1: facts enriched with two small dimensions (size-checked broadcast)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return jn.enrich(jn.enrich(li, s, "l_suppkey"), n, "s_nationkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "n_name")


JN10_SQL = """
SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
"""


@register("jn10_missing_ids", JN10_SQL)
def jn10_missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    """JN10/RC1: ids in documents not in labels (distinct)."""
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select("doc_id")
    return jn.exclude(d, lab, "doc_id", distinct=True)


JN11_SQL = """
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
"""


@register("jn11_semi_join", JN11_SQL)
def jn11_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """JN11: documents whose id appears among good-quality labels (left semi)."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels").filter(F.col("quality") == 1).select("doc_id")
    return jn.present_in(d, lab, "doc_id")


JN9_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT asset_id, epoch - epoch % {DAY} AS day FROM r
WHERE parameter IN ('click', 'view', 'purchase') AND value > 10
GROUP BY asset_id, epoch - epoch % {DAY} HAVING count(DISTINCT parameter) = 3
"""


@register("jn9_all_members_present", JN9_SQL)
def jn9_all_members_present(spark: SparkSession, sf: str) -> DataFrame:
    """JN9: (asset, day) cells where all three conditions have a hit (count distinct = n)."""
    from .operators.intervals import all_present
    r = readings(spark, sf).filter(F.col("parameter").isin("click", "view", "purchase") & (F.col("value") > 10))
    r = r.withColumn("day", F.col("epoch") - F.col("epoch") % DAY).withColumn("_n", F.lit(3))
    return all_present(r, ["asset_id"], "day", "parameter", "_n")


# ---------------------------------------------------------------- windows

WN2_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
"""


@register("wn2_latest_per_key", WN2_SQL)
def wn2_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """WN2: latest order per customer (max struct aggregate, ties by key)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return wn.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


WN5_CUT = 1705622400  # 2024-01-19 00:00:00 UTC: history before, evaluation after
WN5_SQL = f"""
WITH r AS ({READINGS_SQL}),
s AS (SELECT asset_id, parameter, avg(value) AS mu, stddev_pop(value) AS sigma FROM r WHERE epoch < {WN5_CUT} GROUP BY ALL)
SELECT r.asset_id, r.parameter, r.epoch,
       round(CASE WHEN s.sigma = 0 THEN 0.0 ELSE (r.value - s.mu) / s.sigma END, 6) AS zscore
FROM r JOIN s USING (asset_id, parameter) WHERE r.epoch >= {WN5_CUT}
"""


@register("wn5_fixed_history_zscore", WN5_SQL)
def wn5_fixed_history_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """WN5: z-score of recent readings vs a fixed history (population std, 0 when std = 0)."""
    r = readings(spark, sf)
    z = wn.fixed_history_zscore(r.filter(F.col("epoch") < WN5_CUT), r.filter(F.col("epoch") >= WN5_CUT),
                                ["asset_id", "parameter"], "value")
    return z.select("asset_id", "parameter", "epoch", _r6("zscore"))


WN6_SQL = f"""
WITH r AS ({READINGS_SQL}),
w AS (SELECT asset_id, parameter, epoch, value,
             value BETWEEN 5 AND 60 AS good,
             last(CASE WHEN value BETWEEN 5 AND 60 THEN {{'t': epoch, 'v': value}} END IGNORE NULLS)
               OVER (PARTITION BY asset_id, parameter ORDER BY epoch ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS lg
      FROM r)
SELECT asset_id, parameter, epoch, value, good AS in_range,
       CASE WHEN good THEN value WHEN epoch - lg.t <= {2 * DAY} THEN lg.v END AS modified
FROM w
"""


@register("wn6_hold_last_good", WN6_SQL)
def wn6_hold_last_good(spark: SparkSession, sf: str) -> DataFrame:
    """WN6: out-of-range [5, 60] values take the last in-range value among the previous 30 rows
    if it is at most 2 days old (row halo per day chunk)."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    h = wn.hold_last_good(r, ["asset_id", "parameter"], "epoch", "value", 5.0, 60.0, rows=30, max_lag=2 * DAY)
    return h.select("asset_id", "parameter", "epoch", "value", "in_range", "modified")


WN7_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT asset_id, parameter, epoch,
       round(avg(value) OVER (PARTITION BY asset_id, parameter ORDER BY epoch ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM r
"""


@register("wn7_moving_average", WN7_SQL)
def wn7_moving_average(spark: SparkSession, sf: str) -> DataFrame:
    """WN7: moving average of the current and 4 previous rows per asset and tag."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    m = wn.moving_average(r, ["asset_id", "parameter"], "epoch", "value", 4)
    return m.select("asset_id", "parameter", "epoch", _r6("moving_avg"))


WN8_ALPHA = 0.3
WN8_SQL = f"""
WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY asset_id, parameter ORDER BY epoch) AS i
                     FROM ({READINGS_SQL})),
s AS (SELECT asset_id, parameter, i, epoch, value AS smoothed FROM r WHERE i = 1
      UNION ALL
      SELECT r.asset_id, r.parameter, r.i, r.epoch, {WN8_ALPHA} * r.value + {1 - WN8_ALPHA} * s.smoothed
      FROM s JOIN r ON r.asset_id = s.asset_id AND r.parameter = s.parameter AND r.i = s.i + 1)
SELECT asset_id, parameter, epoch, floor(smoothed * 10000 + 0.3712345678) / 10000 AS smoothed FROM s
"""


@register("wn8_exponential_smoothing", WN8_SQL)
def wn8_exponential_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    """WN8: y1 = x1, y = 0.3 x + 0.7 y' per asset and tag (running sums in blocks, entering state by lag)."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    s = wn.exp_smooth(r, ["asset_id", "parameter"], "epoch", "value", WN8_ALPHA)
    # 4 decimals, cut in both engines off the exact halves that the recursion yields
    return s.select("asset_id", "parameter", "epoch",
                    (F.floor(F.col("smoothed") * 10000 + 0.3712345678) / 10000).alias("smoothed"))


WN9_SQL = f"""
WITH f AS ({FIBRE_SQL}),
t AS (SELECT DISTINCT asset_id, timestamp FROM f),
b AS (SELECT asset_id, timestamp, CAST(ntile(24) OVER (PARTITION BY asset_id ORDER BY timestamp) AS INTEGER) AS bucket FROM t)
SELECT asset_id, timestamp, bucket, min(timestamp) OVER (PARTITION BY asset_id, bucket) AS bucket_time FROM b
"""


@register("wn9_equal_count_buckets", WN9_SQL)
def wn9_equal_count_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """WN9: ntile(24) over the distinct profile times of each asset, with bucket start time."""
    f = fibre(spark, sf)
    return wn.equal_count_buckets(f, ["asset_id"], "timestamp", 24).select("asset_id", "timestamp", "bucket", "bucket_time")


# ---------------------------------------------------------------- PJ scalar functions

PJ_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(CASE l_returnflag WHEN 'R' THEN l_extendedprice * 0.001 WHEN 'A' THEN l_extendedprice * 0.66
            ELSE l_extendedprice END, 6) AS scaled_price,
       CAST(floor(epoch(l_shipdate)) AS BIGINT) - CAST(floor(epoch(l_shipdate)) AS BIGINT) % 86400 AS ship_day,
       CASE WHEN length(CAST(l_partkey AS VARCHAR)) >= 18 THEN CAST(l_partkey AS VARCHAR)
            ELSE lpad(CAST(l_partkey AS VARCHAR), 18, '0') END AS part_code,
       round(abs((l_extendedprice * (1 - l_discount) - l_extendedprice) / nullif(l_extendedprice, 0)) * 100, 6) AS discount_pct,
       coalesce(CASE lower(trim(l_linestatus)) WHEN 'o' THEN 'open' WHEN 'f' THEN 'filled' END, l_linestatus) AS status_name,
       l_quantity > 25 AS big_line
FROM lineitem
WHERE coalesce(l_discount, 0) <> 0 OR coalesce(l_tax, 0) <> 0
"""


@register("pj_scalar_functions", PJ_SQL)
def pj_scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    """PJ5/PJ7/PJ9/PJ10/PJ11/PJ14/PJ15: unit scaling per flag, day floor, zero-padded codes,
    percentage change, name normalisation, operator compare, non-zero filter."""
    from .functions import scalars as sc
    li = table(spark, sf, "lineitem")
    ep = sc.epoch_seconds("l_shipdate", li.schema["l_shipdate"].dataType)
    li = li.filter(sc.nonzero_traffic("l_discount", "l_tax"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(sc.scale_units("l_extendedprice", "l_returnflag", {"R": 0.001, "A": 0.66}), 6).alias("scaled_price"),
        sc.bucket_floor(ep, DAY).alias("ship_day"),
        sc.zfill("l_partkey", 18).alias("part_code"),
        F.round(sc.pct_change(F.col("l_extendedprice") * (1 - F.col("l_discount")), "l_extendedprice"), 6).alias("discount_pct"),
        sc.normalise("l_linestatus", {"o": "open", "f": "filled"}).alias("status_name"),
        sc.compare("l_quantity", ">", 25.0).alias("big_line"))


SO1_SQL = """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1
"""


@register("so1_first_order", SO1_SQL)
def so1_first_order(spark: SparkSession, sf: str) -> DataFrame:
    """SO1: the earliest order (sort key then id), a top-1 report: one row kept per task before the merge."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return wn.first_by(o, ["o_orderdate", "o_orderkey"])


AG12W_SQL = """
SELECT conv_id, w AS words FROM (
  SELECT conv_id, list_sort(list_distinct(flatten(list(
           list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> ''))))) AS w
  FROM conversations GROUP BY conv_id)
WHERE len(w) > 0
"""


@register("ag12_flatten_words", AG12W_SQL)
def ag12_flatten_words(spark: SparkSession, sf: str) -> DataFrame:
    """AG12: per conversation the sorted distinct words of all its turns (whole texts split,
    lists flattened through an exploded set, so no conversation's lists are held at once)."""
    c = table(spark, sf, "conversations").select(
        "conv_id", F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "").alias("words"))
    return ag.flatten_lists(c, ["conv_id"], "words", "words")
