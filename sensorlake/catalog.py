"""Registered queries: one per operator of the inventory, each with the
DuckDB text of the same computation (the oracle) where SQL can state it.

Every query reads the given parquet tables (or frames Spark derives from
them) in full; rule configurations are small literal frames joined to them.
Floating results that are sums or means are rounded to 6 decimals on both
sides so that summation order does not change the compared values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import resample
from .session import configure, ensure_checkpoint_dir, local_frame
from .tables import READINGS_SQL, readings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; the registered callable first pins the session settings
    results depend on (UTC time zone) and makes sure a checkpoint folder exists."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            configure(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _r6(c: str = "value"):
    return F.round(F.col(c), 6).alias(c)


DAY = 86400

# ---------------------------------------------------------------- GO3 (flagship)

GO3_SQL = f"""
WITH r AS ({READINGS_SQL}),
a AS (
  SELECT asset_id, parameter AS tag, epoch - epoch % {DAY} AS bucket_start,
         min({{'v': value, 't': epoch}}) AS mn, max({{'v': value, 't': epoch}}) AS mx,
         sum(value) AS s, count(value) AS c
  FROM r GROUP BY asset_id, parameter, epoch - epoch % {DAY})
SELECT asset_id, tag, bucket_start, tag || '_min' AS parameter, mn.t AS timestamp, round(mn.v, 6) AS value FROM a
UNION ALL SELECT asset_id, tag, bucket_start, tag || '_max', mx.t, round(mx.v, 6) FROM a
UNION ALL SELECT asset_id, tag, bucket_start, tag || '_sum', bucket_start, round(s, 6) FROM a
UNION ALL SELECT asset_id, tag, bucket_start, tag || '_count', bucket_start, CAST(c AS DOUBLE) FROM a
"""


@register("go3_daily_summary", GO3_SQL)
def go3_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    """GO3/AG5/AG6/ST1: per asset, tag and day: min/max with time of extreme, sum, count, long form."""
    r = readings(spark, sf).withColumnRenamed("parameter", "tag")
    out = resample.summarize(r, ["asset_id", "tag"], "epoch", ["value"], DAY, name_col="tag")
    return out.select("asset_id", "tag", "bucket_start", "parameter", "timestamp", _r6())


# ---------------------------------------------------------------- rules (RU4-RU11)

from .operators import intervals as iv  # noqa: E402
from .operators import windows as wn  # noqa: E402
from .plans import rules as ru  # noqa: E402

# Run window of the registered rule queries: from the first day of the data to its last reading
# (SQL text over the readings ``r`` of each oracle).
RUN_START = f"(SELECT min(epoch) - min(epoch) % {DAY} FROM r)"
RUN_END = "(SELECT max(epoch) FROM r)"


def _conditions(spark: SparkSession, spec, cols: str | None = None) -> DataFrame:
    """Rule conditions from a rule spec; ``asset_id`` left null = every asset
    (per-asset evaluation), so the table stays as small as the spec."""
    c = spec if isinstance(spec, DataFrame) else local_frame(spark, spec, cols)
    for name in ru.CONDITION_SCHEMA.names:
        if name not in c.columns:
            c = c.withColumn(name, F.lit(None).cast(ru.CONDITION_SCHEMA[name].dataType))
    return c.select(*[F.col(f.name).cast(f.dataType) for f in ru.CONDITION_SCHEMA.fields])


SPEC_COLS = ("rule_id int, condition_id int, parameter string, function string, operator string, "
             "threshold double, duration long, data_frequency long, join_condition string")


def _islands_sql(hits: str, keys: str) -> str:
    """DuckDB gaps-and-islands over a hits CTE with columns keys, epoch, lim, dur, lo, hi."""
    return f"""
    SELECT {keys}, min(epoch) AS start_time, max(epoch) AS end_time,
           any_value(lim) AS lim, any_value(dur) AS dur, any_value(lo) AS lo, any_value(hi) AS hi
    FROM (SELECT *, sum(CASE WHEN prev IS NULL OR epoch - prev > lim THEN 1 ELSE 0 END)
                      OVER (PARTITION BY {keys} ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS isl
          FROM (SELECT *, lag(epoch) OVER (PARTITION BY {keys} ORDER BY epoch) AS prev FROM {hits}))
    GROUP BY {keys}, isl"""


RU4_SPEC = [
    (1, 1, "purchase", "raw", ">", 50.0, 3 * 3600, 43200, "or"),
    (2, 1, "view", "raw", "<", 5.0, 0, 21600, "or"),
    (3, 1, "error", "raw", ">=", 20.0, 86400, 86400, "or"),
]


def _spec_sql(spec) -> str:
    rows = ", ".join(
        f"({r[0]}, {r[1]}, '{r[2]}', '{r[3]}', '{r[4]}', {float(r[5])}, {r[6]}, {r[7]}, '{r[8]}')" for r in spec)
    return (f"SELECT * FROM (VALUES {rows}) AS t(rule_id, condition_id, parameter, function, operator, "
            "threshold, duration, data_frequency, join_condition)")


def _cmp_sql(lhs: str) -> str:
    return (f"CASE operator WHEN '>' THEN {lhs} > threshold WHEN '<' THEN {lhs} < threshold "
            f"WHEN '>=' THEN {lhs} >= threshold WHEN '<=' THEN {lhs} <= threshold "
            f"WHEN '==' THEN {lhs} = threshold WHEN '!=' THEN {lhs} <> threshold END")


RU4_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS ({_spec_sql(RU4_SPEC)}),
c AS (SELECT spec.*, a.asset_id, 2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM spec CROSS JOIN (SELECT DISTINCT asset_id FROM r) a),
h AS (SELECT c.rule_id, c.condition_id, c.asset_id, r.epoch, lim, dur, lo, hi
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      WHERE r.epoch BETWEEN lo AND hi AND {_cmp_sql('r.value')}),
i AS ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
SELECT rule_id, condition_id, asset_id, start_time, end_time FROM i
WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi
"""


def _run_window(c: DataFrame, r: DataFrame) -> DataFrame:
    """The data's own run window on every condition, as one scalar subquery (no job of its own)."""
    span = r.select(F.struct(F.min("epoch").alias("lo"), F.max("epoch").alias("hi"))).scalar()
    return (c.withColumn("_span", span).withColumn("start_time", F.col("_span.lo") - F.pmod(F.col("_span.lo"), F.lit(DAY)))
             .withColumn("end_time", F.col("_span.hi")).drop("_span"))


@register("ru4_threshold_islands", RU4_SQL)
def ru4_threshold_islands(spark: SparkSession, sf: str) -> DataFrame:
    """RU4/WN1/PJ10: raw threshold hits -> islands per rule member (gap limit, duration, edges)."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU4_SPEC, SPEC_COLS), r)
    mi = ru.member_intervals(r, c)
    return mi.select("rule_id", "condition_id", "asset_id", "start_time", "end_time")


RU5_SPEC = [
    (11, 1, "click", "avg", ">", 30.0, 2 * 86400, 43200, "or"),
    (12, 1, "signup", "avg", "<=", 8.0, 86400, 43200, "or"),
]
RU5_DURATIONS = sorted({s[6] for s in RU5_SPEC})

RU5_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS ({_spec_sql(RU5_SPEC)}),
c AS (SELECT spec.*, a.asset_id, 2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM spec CROSS JOIN (SELECT DISTINCT asset_id FROM r) a),
b AS (SELECT c.rule_id, c.condition_id, c.asset_id, r.epoch, r.value, c.operator, c.threshold, lim, dur, lo, hi
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      WHERE r.epoch BETWEEN {RUN_START} AND {RUN_END}),
fa AS (SELECT DISTINCT rule_id, condition_id, asset_id, epoch, operator, threshold, lim, dur, lo, hi,
              CASE dur {' '.join(f"WHEN {d} THEN avg(value) OVER (PARTITION BY rule_id, condition_id, asset_id ORDER BY epoch RANGE BETWEEN CURRENT ROW AND {d - 1} FOLLOWING)" for d in RU5_DURATIONS)} END AS avg_value
       FROM b),
h AS (SELECT * FROM fa WHERE {_cmp_sql('avg_value')}),
i AS ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
SELECT rule_id, condition_id, asset_id, start_time, end_time FROM i
WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi
"""


@register("ru5_sliding_avg_islands", RU5_SQL)
def ru5_sliding_avg_islands(spark: SparkSession, sf: str) -> DataFrame:
    """RU5/WN3: forward sliding mean over [t, t+d-1] passes the operator -> islands."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU5_SPEC, SPEC_COLS), r)
    mi = ru.member_intervals(r, c)
    return mi.select("rule_id", "condition_id", "asset_id", "start_time", "end_time")


WN3_D = 2 * 86400
WN3_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT DISTINCT asset_id, parameter, epoch,
       round(avg(value) OVER (PARTITION BY asset_id, parameter ORDER BY epoch
                              RANGE BETWEEN CURRENT ROW AND {WN3_D - 1} FOLLOWING), 6) AS avg_value
FROM r
"""


@register("wn3_forward_average", WN3_SQL)
def wn3_forward_average(spark: SparkSession, sf: str) -> DataFrame:
    """WN3: forward sliding mean over [t, t + 2 days - 1] per asset and tag (day chunks + halo)."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    fa = wn.forward_average(r, ["asset_id", "parameter"], "epoch", "value", WN3_D)
    return fa.select("asset_id", "parameter", "epoch", _r6("avg_value"))


WN4_D, WN4_T = 3 * 86400, 1.5
WN4_SQL = f"""
WITH r AS ({READINGS_SQL}),
s AS (SELECT asset_id, parameter, epoch, value,
             avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
      FROM r WINDOW w AS (PARTITION BY asset_id, parameter ORDER BY epoch
                          RANGE BETWEEN {WN4_D} PRECEDING AND 1 PRECEDING))
SELECT asset_id, parameter, epoch, value, round((value - m) / sd, 4) AS zscore
FROM s WHERE sd IS NOT NULL AND sd <> 0 AND abs((value - m) / sd) > {WN4_T}
"""


@register("wn4_trailing_zscore", WN4_SQL)
def wn4_trailing_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """WN4: z-score against the previous 3 days (current row excluded, sample std), |z| > 1.5."""
    r = readings(spark, sf).select("asset_id", "parameter", "epoch", "value")
    # running totals: one shuffle, no copies; they agree to about 1e-9 relative where four decimals are compared
    z = wn.trailing_zscore(r, ["asset_id", "parameter"], "epoch", "value", WN4_D, ">", WN4_T, method="running")
    return z.filter("flag").select("asset_id", "parameter", "epoch", "value", F.round("zscore", 4).alias("zscore"))


RU6_SPEC = [
    (21, 1, "purchase", "differential", ">", 200.0, 0, 43200, "or"),
    (22, 1, "view", "differential", "<", -20.0, 0, 43200, "or"),
]
RU6_UNITS = {21: "%", 22: "absolute"}

RU6_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS ({_spec_sql(RU6_SPEC)}),
u AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{v}')" for k, v in RU6_UNITS.items())}) AS t(rule_id, unit)),
bt AS (SELECT asset_id, parameter, min(epoch) AS baseline_time FROM r GROUP BY asset_id, parameter),
c AS (SELECT spec.*, u.unit, bt.asset_id, bt.baseline_time, 2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM spec JOIN u USING (rule_id) JOIN bt ON bt.parameter = spec.parameter),
b AS (SELECT c.rule_id, c.condition_id, c.asset_id, max(r.value) AS baseline_value
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter AND r.epoch = c.baseline_time
      GROUP BY ALL),
d AS (SELECT c.rule_id, c.condition_id, c.asset_id, r.epoch, c.operator, c.threshold, lim, dur, lo, hi,
             CASE WHEN c.unit = '%' THEN abs((r.value - b.baseline_value) / nullif(b.baseline_value, 0)) * 100
                  ELSE r.value - b.baseline_value END AS value_difference
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      JOIN b ON b.rule_id = c.rule_id AND b.condition_id = c.condition_id AND b.asset_id = c.asset_id
      WHERE r.epoch BETWEEN {RUN_START} AND {RUN_END}),
h AS (SELECT * FROM d WHERE {_cmp_sql('value_difference')}),
i AS ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
SELECT rule_id, condition_id, asset_id, start_time, end_time FROM i
WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi
"""


@register("ru6_differential_islands", RU6_SQL)
def ru6_differential_islands(spark: SparkSession, sf: str) -> DataFrame:
    """RU6/JN7/PJ14: change vs each asset's baseline reading (% absolute or plain) -> islands."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU6_SPEC, SPEC_COLS), r).drop("asset_id", "baseline_time")
    units = F.create_map(*[F.lit(x) for kv in RU6_UNITS.items() for x in kv])
    # explicit conditions: each asset's own baseline time (its first reading of the tag)
    base = r.groupBy("asset_id", "parameter").agg(F.min("epoch").alias("baseline_time"))
    c = (c.join(base, "parameter").withColumn("threshold_unit", units[F.col("rule_id")])
          .select(*ru.CONDITION_SCHEMA.names))
    mi = ru.member_intervals(r, c)
    return mi.select("rule_id", "condition_id", "asset_id", "start_time", "end_time")


RU7_SPEC = [
    (31, 1, "click", "count", ">=", 3.0, 86400, 43200, "or"),
    (32, 1, "error", "count", ">=", 2.0, 3 * 86400, 43200, "or"),
    (33, 1, "view", "count", ">=", 1.0, 7 * 86400, 43200, "or"),
]
RU7_CLASS = {33: 7}

RU7_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS ({_spec_sql(RU7_SPEC)}),
cl AS (SELECT * FROM (VALUES {", ".join(f"({k}, {v})" for k, v in RU7_CLASS.items())}) AS t(rule_id, cls)),
c AS (SELECT spec.*, cl.cls, a.asset_id FROM spec LEFT JOIN cl USING (rule_id)
      CROSS JOIN (SELECT DISTINCT asset_id FROM r) a),
g AS (SELECT c.rule_id, c.condition_id, c.asset_id, c.operator, c.threshold, c.duration,
             CAST(floor((r.epoch - {RUN_START}) / c.duration) AS BIGINT) AS grp, count(*) AS n_events
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      WHERE r.epoch BETWEEN {RUN_START} AND {RUN_END} AND (c.cls IS NULL OR r.k = c.cls)
      GROUP BY ALL)
SELECT rule_id, condition_id, asset_id, {RUN_START} + duration * grp AS start_time,
       {RUN_START} + duration * grp + duration AS end_time, n_events
FROM g WHERE {_cmp_sql('n_events')}
"""


@register("ru7_event_count", RU7_SQL)
def ru7_event_count(spark: SparkSession, sf: str) -> DataFrame:
    """RU7/AG8: tumbling event count on a grid anchored at the run start, optional class, HAVING count op n."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU7_SPEC, SPEC_COLS), r)
    cls = F.create_map(*[F.lit(x) for kv in RU7_CLASS.items() for x in kv])
    c = c.withColumn("class", cls[F.col("rule_id")].cast("int"))
    cells = ru.count_cells(r, ru.prepare(c))
    return cells.select("rule_id", "condition_id", "asset_id", "start_time", "end_time", "n_events")


RU8_SPEC = [(41, 1, "error", "magnitude", ">", 100.0, 0, 43200, "or")]

RU8_SQL = f"""
WITH r AS ({READINGS_SQL})
SELECT 41 AS rule_id, 1 AS condition_id, asset_id, epoch AS start_time, epoch AS end_time
FROM r WHERE parameter = 'error' AND value > 100.0 AND epoch BETWEEN {RUN_START} AND {RUN_END}
"""


@register("ru8_magnitude", RU8_SQL)
def ru8_magnitude(spark: SparkSession, sf: str) -> DataFrame:
    """RU8: single readings passing the operator within the run window."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU8_SPEC, SPEC_COLS), r)
    mi = ru.member_intervals(r, c)
    return mi.select("rule_id", "condition_id", "asset_id", "start_time", "end_time")


def _hundred_rules(spark: SparkSession) -> DataFrame:
    """100 threshold rules from one rule: tag cycles through the five types,
    threshold steps 10, 20, ... 200."""
    types = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    return spark.range(1, 101).select(
        F.col("id").cast("int").alias("rule_id"), F.lit(1).alias("condition_id"),
        F.element_at(types, (F.pmod(F.col("id") - 1, 5) + 1).cast("int")).alias("parameter"),
        F.lit("raw").alias("function"), F.lit(">").alias("operator"),
        (F.floor((F.col("id") - 1) / 5) * 10 + 10).cast("double").alias("threshold"),
        F.lit(3600).cast("long").alias("duration"), F.lit(43200).cast("long").alias("data_frequency"),
        F.lit("or").alias("join_condition"))


RU10_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS (SELECT CAST(id AS INTEGER) AS rule_id, 1 AS condition_id,
                ['click', 'error', 'purchase', 'signup', 'view'][CAST((id - 1) % 5 AS INTEGER) + 1] AS parameter,
                '>' AS operator, CAST(((id - 1) // 5) * 10 + 10 AS DOUBLE) AS threshold,
                3600 AS duration, 43200 AS data_frequency FROM range(1, 101) t(id)),
c AS (SELECT spec.*, a.asset_id, 2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM spec CROSS JOIN (SELECT DISTINCT asset_id FROM r) a),
h AS (SELECT c.rule_id, c.condition_id, c.asset_id, r.epoch, lim, dur, lo, hi
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      WHERE r.epoch BETWEEN lo AND hi AND r.value > c.threshold),
i AS ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
SELECT rule_id, asset_id, start_time, end_time FROM i
WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi
"""


@register("ru10_hundred_rules_one_plan", RU10_SQL)
def ru10_hundred_rules_one_plan(spark: SparkSession, sf: str) -> DataFrame:
    """RU10: 100 rules x every asset evaluated in one plan (broadcast rule join, one shuffle)."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, _hundred_rules(spark)), r)
    return ru.evaluate(r, c)


RU11_SPEC = [
    (51, 1, "click", "raw", ">", 20.0, 0, 86400, "and"),
    (51, 2, "view", "raw", ">", 20.0, 0, 86400, "and"),
]

RU11_SQL = f"""
WITH r AS ({READINGS_SQL}),
spec AS ({_spec_sql(RU11_SPEC)}),
c AS (SELECT spec.*, a.asset_id,
             2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM spec CROSS JOIN (SELECT DISTINCT asset_id FROM r) a),
h AS (SELECT c.rule_id, c.condition_id, c.asset_id, r.epoch, lim, dur, lo, hi
      FROM r JOIN c ON r.asset_id = c.asset_id AND r.parameter = c.parameter
      WHERE r.epoch BETWEEN lo AND hi AND {_cmp_sql('r.value')}),
i AS (SELECT * FROM ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
      WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi)
SELECT a.rule_id, a.asset_id, greatest(a.start_time, b.start_time) AS start_time, least(a.end_time, b.end_time) AS end_time
FROM i a JOIN i b ON a.rule_id = b.rule_id AND a.asset_id = b.asset_id AND a.condition_id = 1 AND b.condition_id = 2
 AND a.start_time <= b.end_time AND b.start_time <= a.end_time
"""


@register("ru11_and_rules", RU11_SQL)
def ru11_and_rules(spark: SparkSession, sf: str) -> DataFrame:
    """RU11/ST3/JN6: per-asset AND rule of two conditions -> spans where both hold (sweep line)."""
    r = readings(spark, sf)
    c = _run_window(_conditions(spark, RU11_SPEC, SPEC_COLS), r)
    return ru.evaluate(r, c)


_RU10_CTES = RU10_SQL.split("SELECT rule_id, asset_id, start_time, end_time FROM i")[0].rstrip()
RU14_SQL = _RU10_CTES + f""",
an AS (SELECT rule_id, asset_id, start_time, end_time FROM i
       WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi),
p AS (SELECT *, CAST((row_number() OVER (PARTITION BY rule_id ORDER BY start_time, end_time, asset_id) - 1) // 1000 AS INTEGER) AS page
      FROM an),
m AS (SELECT rule_id, page, list({{'start_time': start_time, 'end_time': end_time, 'asset_id': asset_id}}
                                 ORDER BY start_time, end_time, asset_id) AS anomalies FROM p GROUP BY rule_id, page)
SELECT m.rule_id, m.page, to_json({{'anomalies': m.anomalies,
                            'time_range': {{'start': {RUN_START} - (2 * s.data_frequency - 1), 'end': {RUN_END}}},
                            'rule': {{'rule_id': s.rule_id, 'parameter': s.parameter, 'operator': s.operator,
                                      'threshold': s.threshold}}}}) AS message
FROM m JOIN spec s USING (rule_id)
"""


@register("ru14_rule_messages", RU14_SQL)
def ru14_rule_messages(spark: SparkSession, sf: str) -> DataFrame:
    """RU14: one JSON message per rule with anomalies {anomalies, time_range, rule}."""
    r = readings(spark, sf)
    rules = _run_window(_conditions(spark, _hundred_rules(spark)), r)
    an = ru.evaluate(r, rules)
    header = rules.groupBy("rule_id").agg(
        F.first("parameter").alias("parameter"), F.first("operator").alias("operator"),
        F.first("threshold").alias("threshold"), F.first("start_time").alias("start_time"),
        F.first("end_time").alias("end_time"), F.max(ru.gap_limit(F.col("data_frequency"))).alias("max_limit"))
    return ru.messages(an, header)


JN6_SQL = f"""
WITH r AS ({READINGS_SQL}),
l AS (SELECT asset_id, epoch AS l_start, epoch + k * 3600 AS l_end FROM r WHERE parameter = 'click'),
g AS (SELECT asset_id, epoch AS r_start, epoch + k * 3600 AS r_end FROM r WHERE parameter = 'view')
SELECT l.asset_id, l_start, l_end, r_start, r_end,
       greatest(l_start, r_start) AS start_time, least(l_end, r_end) AS end_time
FROM l JOIN g ON l.asset_id = g.asset_id AND l_start <= r_end AND r_start <= l_end
"""


@register("jn6_interval_overlap_join", JN6_SQL)
def jn6_interval_overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    """JN6: overlap join of intervals [epoch, epoch + k hours] of two tags per asset (multi-level bins)."""
    r = readings(spark, sf)
    left = r.filter(F.col("parameter") == "click").select(
        "asset_id", F.col("epoch").alias("l_start"), (F.col("epoch") + F.col("k") * 3600).alias("l_end"))
    right = r.filter(F.col("parameter") == "view").select(
        "asset_id", F.col("epoch").alias("r_start"), (F.col("epoch") + F.col("k") * 3600).alias("r_end"))
    return iv.overlap_join(left, right, ["asset_id"], "l_start", "l_end", "r_start", "r_end", base=3600)


from . import catalog_aggs  # noqa: E402,F401  (registers its queries)
from . import catalog_fibre  # noqa: E402,F401
from . import catalog_misc  # noqa: E402,F401
from . import catalog_rules  # noqa: E402,F401
from . import catalog_sources  # noqa: E402,F401
from . import catalog_streams  # noqa: E402,F401
