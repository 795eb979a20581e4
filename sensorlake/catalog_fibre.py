"""Registered queries: fibre silver, publish windows and matrix products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import DAY, register
from .operators import fibre as fb
from .tables import FIBRE_SQL, READINGS_SQL, fibre, readings, table

# ---------------------------------------------------------------- PB1 / PB2

PB1_SQL = """
WITH o AS (SELECT o_orderkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS t, o_orderdate FROM orders)
SELECT o_orderkey, t,
       t - t % 3600 AS hour_start, t - t % 3600 + 3599 AS hour_end,
       t - t % 86400 - 86400 AS prev_day_start,
       CAST(epoch(date_trunc('week', o_orderdate)) AS BIGINT) AS week_start,
       CAST(epoch(date_trunc('week', o_orderdate)) AS BIGINT) + 604799 AS week_end,
       CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) AS month_start,
       CAST(epoch(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS BIGINT) - 1 AS month_end,
       t - t % 21600 AS das_week_start, t - t % 86400 + 86399 AS das_month_end
FROM o
"""


@register("pb1_publish_windows", PB1_SQL)
def pb1_publish_windows(spark: SparkSession, sf: str) -> DataFrame:
    """PB1/PB2: window bounds of every order time: hour, previous day, Monday week,
    calendar month (temperature) and 6-hour / day runs (acoustic)."""
    from .functions.scalars import epoch_seconds
    o = table(spark, sf, "orders")
    t = epoch_seconds("o_orderdate", o.schema["o_orderdate"].dataType)
    o = o.select("o_orderkey", t.alias("t"))
    hs, he = fb.window_bounds(F.col("t"), 3600)
    ws, we = fb.window_bounds(F.col("t"), fb.WINDOWS["1week"], "dts")
    ms, me = fb.window_bounds(F.col("t"), fb.WINDOWS["1month"], "dts")
    dws, _ = fb.window_bounds(F.col("t"), fb.WINDOWS["1week"], "das")
    _, dme = fb.window_bounds(F.col("t"), fb.WINDOWS["1month"], "das")
    return o.select("o_orderkey", "t", hs.alias("hour_start"), he.alias("hour_end"),
                    fb.window_start(F.col("t"), 86400, previous=True).alias("prev_day_start"),
                    ws.alias("week_start"), we.alias("week_end"), ms.alias("month_start"), me.alias("month_end"),
                    dws.alias("das_week_start"), dme.alias("das_month_end"))


# ---------------------------------------------------------------- PB3 / PB4 matrices

PB3_N = 24


def _matrix_sql(where: str, n: int) -> str:
    """DuckDB text of the depth-by-time matrix product over the fibre rows matching ``where``."""
    return f"""
WITH f AS (SELECT * FROM ({FIBRE_SQL}) WHERE {where}),
t AS (SELECT DISTINCT asset_id, timestamp FROM f),
b AS (SELECT asset_id, timestamp, ntile({n}) OVER (PARTITION BY asset_id ORDER BY timestamp) AS bucket FROM t),
bt AS (SELECT asset_id, bucket, min(timestamp) AS bucket_time FROM b GROUP BY ALL),
cell AS (SELECT f.asset_id, b.bucket, f.depth, avg(f.value) AS v FROM f JOIN b USING (asset_id, timestamp) GROUP BY ALL),
d AS (SELECT DISTINCT asset_id, depth FROM cell),
g AS (SELECT d.asset_id, d.depth, bt.bucket FROM d JOIN bt USING (asset_id)),
s AS (SELECT g.asset_id, g.depth, list(round(c.v, 6) ORDER BY g.bucket) AS s
      FROM g LEFT JOIN cell c ON c.asset_id = g.asset_id AND c.depth = g.depth AND c.bucket = g.bucket GROUP BY ALL),
tm AS (SELECT asset_id, list(bucket_time ORDER BY bucket) AS time FROM bt GROUP BY ALL)
SELECT s.asset_id, any_value(tm.time) AS time, list(s.depth ORDER BY s.depth) AS depth, list(s.s ORDER BY s.depth) AS data
FROM s JOIN tm USING (asset_id) GROUP BY s.asset_id"""


PB3_SQL = _matrix_sql("TRUE", PB3_N)


def _round_matrix(df: DataFrame) -> DataFrame:
    return df.withColumn("data", F.transform("data", lambda s: F.transform(s, lambda x: F.round(x, 6))))


@register("pb3_dts_matrix_product", PB3_SQL)
def pb3_dts_matrix_product(spark: SparkSession, sf: str) -> DataFrame:
    """PB3/WN9: per asset time[] of 24 equal-count buckets, depth[], depth-major mean matrix."""
    f = fibre(spark, sf)
    m = fb.matrix_product(f, ["asset_id"], "timestamp", "depth", "value", PB3_N)
    return _round_matrix(m).select("asset_id", "time", "depth", "data")


PB4_N = 10
PB4_SQL = f"""
WITH e AS (SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
t AS (SELECT DISTINCT label, vec_id FROM e),
b AS (SELECT label, vec_id, ntile({PB4_N}) OVER (PARTITION BY label ORDER BY vec_id) AS bucket FROM t),
bt AS (SELECT label, bucket, min(vec_id) AS bucket_time FROM b GROUP BY ALL),
cell AS (SELECT e.label, b.bucket, e.pos, avg(e.v) AS v FROM e JOIN b USING (label, vec_id) GROUP BY ALL),
d AS (SELECT DISTINCT label, pos FROM cell),
g AS (SELECT d.label, d.pos, bt.bucket FROM d JOIN bt USING (label)),
s AS (SELECT g.label, g.pos, list(round(c.v, 6) ORDER BY g.bucket) AS s
      FROM g LEFT JOIN cell c ON c.label = g.label AND c.pos = g.pos AND c.bucket = g.bucket GROUP BY ALL),
tm AS (SELECT label, list(bucket_time ORDER BY bucket) AS time FROM bt GROUP BY ALL)
SELECT s.label, any_value(tm.time) AS time, CAST(list(s.pos ORDER BY s.pos) AS INTEGER[]) AS position,
       list(s.s ORDER BY s.pos) AS data
FROM s JOIN tm USING (label) GROUP BY s.label
"""


@register("pb4_das_matrix_product", PB4_SQL)
def pb4_das_matrix_product(spark: SparkSession, sf: str) -> DataFrame:
    """PB4: array rows (vectors as acoustic spectra) -> 10 equal-count time buckets,
    element-wise means, position-major matrix per label."""
    e = table(spark, sf, "embeddings")
    m = fb.array_matrix_product(e, ["label"], "vec_id", "embedding", PB4_N)
    return _round_matrix(m).select("label", "time", "position", "data")


PB5_CUT = 1705276800  # 2024-01-15 00:00:00 UTC
PB5_SQL = f"""
WITH o AS ({_matrix_sql(f"timestamp < {PB5_CUT}", 12)}),
n AS ({_matrix_sql(f"timestamp >= {PB5_CUT}", 12)}),
ox AS (SELECT asset_id, unnest(depth) AS depth, unnest(data) AS os FROM o),
nx AS (SELECT asset_id, unnest(depth) AS depth, unnest(data) AS ns FROM n),
tm AS (SELECT coalesce(o.asset_id, n.asset_id) AS asset_id, o.time AS ot, n.time AS nt FROM o FULL JOIN n USING (asset_id)),
dd AS (SELECT asset_id, depth FROM ox UNION SELECT asset_id, depth FROM nx),
j AS (SELECT dd.asset_id, dd.depth,
             list_concat(coalesce(ox.os, list_transform(coalesce(tm.ot, []), lambda t: CAST(NULL AS DOUBLE))),
                         coalesce(nx.ns, list_transform(coalesce(tm.nt, []), lambda t: CAST(NULL AS DOUBLE)))) AS s
      FROM dd JOIN tm USING (asset_id)
      LEFT JOIN ox ON ox.asset_id = dd.asset_id AND ox.depth = dd.depth
      LEFT JOIN nx ON nx.asset_id = dd.asset_id AND nx.depth = dd.depth)
SELECT j.asset_id, list_concat(coalesce(any_value(tm.ot), []), coalesce(any_value(tm.nt), [])) AS time,
       list(j.depth ORDER BY j.depth) AS depth, list(j.s ORDER BY j.depth) AS data
FROM j JOIN tm USING (asset_id) GROUP BY j.asset_id
"""


@register("pb5_append_product", PB5_SQL)
def pb5_append_product(spark: SparkSession, sf: str) -> DataFrame:
    """PB5: month product = first-half product appended with the second-half product."""
    f = fibre(spark, sf)
    cut = PB5_CUT
    old = fb.matrix_product(f.filter(F.col("timestamp") < cut), ["asset_id"], "timestamp", "depth", "value", 12)
    new = fb.matrix_product(f.filter(F.col("timestamp") >= cut), ["asset_id"], "timestamp", "depth", "value", 12)
    return _round_matrix(fb.append_product(old, new, ["asset_id"]))


PB7_CUT = 1705276800
PB7_SQL = f"""
WITH f AS ({FIBRE_SQL}) SELECT asset_id, depth, timestamp, value FROM f WHERE timestamp >= {PB7_CUT}
"""


@register("pb7_retention", PB7_SQL)
def pb7_retention(spark: SparkSession, sf: str) -> DataFrame:
    """PB7: keep rows at or after the cutoff (day start)."""
    return fb.retain(fibre(spark, sf), "timestamp", PB7_CUT).select("asset_id", "depth", "timestamp", "value")


PB8_ASOF = 1706616000  # 2024-01-30 12:00:00 UTC
PB8_SQL = f"""
WITH r AS ({READINGS_SQL}),
t AS (SELECT asset_id, parameter, epoch, value,
             CASE WHEN epoch >= {PB8_ASOF - PB8_ASOF % DAY} THEN 0 ELSE 1 END AS window_id
      FROM r WHERE epoch >= {PB8_ASOF - PB8_ASOF % DAY - DAY} AND epoch < {PB8_ASOF - PB8_ASOF % DAY + DAY}),
p AS (SELECT asset_id, min(window_id) AS window_id FROM t GROUP BY asset_id)
SELECT t.asset_id, t.parameter, t.epoch, t.value, t.window_id,
       CASE WHEN t.window_id = 0 THEN {PB8_ASOF - PB8_ASOF % DAY} ELSE {PB8_ASOF - PB8_ASOF % DAY - DAY} END AS window_start
FROM t JOIN p USING (asset_id, window_id)
"""


@register("pb8_publish_with_backfill", PB8_SQL)
def pb8_publish_with_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """PB8: per asset, the current day window if it has data, else the previous day."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    out = fb.publish_with_backfill(r, ["asset_id"], "epoch", F.lit(PB8_ASOF).cast("long"), DAY)
    return out.select("asset_id", "parameter", "epoch", "value", "window_id", F.col("window_start").cast("long"))


# ---------------------------------------------------------------- DA1 / DA2 / SR7

def _das_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Acoustic bronze rows derived from the vectors: one file per vector, a single
    time sample (vector id x 20 s, in microseconds) of one spectrum row, shaped by
    SR7: band label from a band table (band = label, range label*100 .. +100), asset
    from a device table, depth positions from the spectrum width."""
    e = table(spark, sf, "embeddings")
    decoded = e.select(F.concat(F.lit("dev-"), F.col("label").cast("string")).alias("device_id"),
                       F.col("label").alias("band_id"), F.size("embedding").alias("n_depth"),
                       F.array((F.col("vec_id") * 20_000_000).cast("long")).alias("time"),
                       F.array(F.col("embedding").cast("array<double>")).alias("source_data"))
    labels = e.select("label").distinct()
    bands = labels.select(F.col("label").alias("band_id"), (F.col("label") * 100).alias("start"),
                          (F.col("label") * 100 + 100).alias("end"))
    assets = labels.select(F.concat(F.lit("dev-"), F.col("label").cast("string")).alias("device_id"),
                           F.col("label").cast("string").alias("asset_id"))
    return fb.shape_das_bronze(decoded, bands, assets)


DA1_SQL = """
WITH e AS (SELECT 'dev-' || CAST(label AS VARCHAR) AS device_id, CAST(label AS VARCHAR) AS asset_id,
                  CAST(label * 100 AS VARCHAR) || '-' || CAST(label * 100 + 100 AS VARCHAR) AS freq_band,
                  CAST(floor(vec_id * 20000000 / 1000000 / 60) * 60 AS BIGINT) AS time,
                  unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos, len(embedding) AS n FROM embeddings),
a AS (SELECT device_id, asset_id, freq_band, time, pos, any_value(n) AS n, avg(v) AS av FROM e GROUP BY ALL)
SELECT device_id, asset_id, freq_band, time, list(round(av, 6) ORDER BY pos) AS data,
       CAST(range(0, any_value(n)) AS INTEGER[]) AS depth
FROM a GROUP BY device_id, asset_id, freq_band, time
"""


@register("da1_das_silver", DA1_SQL)
def da1_das_silver(spark: SparkSession, sf: str) -> DataFrame:
    """DA1/SR7/AG11: acoustic bronze -> per-minute element-wise mean spectra with depth."""
    s = fb.das_silver(_das_bronze(spark, sf))
    return s.select("device_id", "asset_id", "freq_band", "time",
                    F.transform("data", lambda x: F.round(x, 6)).alias("data"), "depth")


DA2_SQL = """
SELECT CAST(label AS VARCHAR) AS asset_id,
       CAST(label * 100 AS VARCHAR) || '-' || CAST(label * 100 + 100 AS VARCHAR) AS freq_band,
       max(CAST(floor(vec_id * 20000000 / 1000000 / 60) * 60 AS BIGINT)) AS latest_epoch
FROM embeddings GROUP BY label
"""


@register("da2_band_registry", DA2_SQL)
def da2_band_registry(spark: SparkSession, sf: str) -> DataFrame:
    """DA2: latest epoch per (asset, frequency band) from the acoustic silver rows."""
    return fb.band_registry(fb.das_silver(_das_bronze(spark, sf)))


# ---------------------------------------------------------------- RU9 fibre rules

RU9_BASE = 1704067200  # baseline profile: the first hour of the month
RU9_SQL = f"""
WITH f AS ({FIBRE_SQL}),
raw AS (SELECT DISTINCT asset_id, timestamp, 'raw' AS kind FROM f
        WHERE depth BETWEEN 20 AND 40 AND value > 150),
b AS (SELECT asset_id, depth, avg(value) AS base FROM f WHERE timestamp = {RU9_BASE} GROUP BY ALL),
c AS (SELECT asset_id, depth, timestamp, avg(value) AS cur FROM f WHERE timestamp > {RU9_BASE} GROUP BY ALL),
d AS (SELECT DISTINCT c.asset_id, c.timestamp, 'differential' AS kind FROM c JOIN b USING (asset_id, depth)
      WHERE (c.cur - b.base) / nullif(b.base, 0) * 100 > 500)
SELECT * FROM raw UNION ALL SELECT * FROM d
"""


@register("ru9_fibre_rules", RU9_SQL)
def ru9_fibre_rules(spark: SparkSession, sf: str) -> DataFrame:
    """RU9: fibre rules per profile time: raw (any reading over depth 20..40 above 150, distinct
    times) and signed percent differential vs the baseline profile, joined by depth."""
    from .functions.scalars import pct_change
    f = fibre(spark, sf)
    raw = (f.filter(F.col("depth").between(20, 40) & (F.col("value") > 150))
            .select("asset_id", "timestamp").distinct().withColumn("kind", F.lit("raw")))
    base = f.filter(F.col("timestamp") == RU9_BASE).groupBy("asset_id", "depth").agg(F.avg("value").alias("base"))
    cur = f.filter(F.col("timestamp") > RU9_BASE).groupBy("asset_id", "depth", "timestamp").agg(F.avg("value").alias("cur"))
    d = (cur.join(base, ["asset_id", "depth"]).filter(pct_change("cur", "base", absolute=False) > 500)
            .select("asset_id", "timestamp").distinct().withColumn("kind", F.lit("differential")))
    return raw.unionByName(d)
