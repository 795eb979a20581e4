"""Registered rule queries: AND rules whose conditions are of different kinds, rules of every operator on one
series, and script rules that come from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import DAY, RUN_END, RUN_START, SPEC_COLS, _cmp_sql, _conditions, _islands_sql, _run_window, _spec_sql, register
from .plans import rules as ru
from .tables import READINGS_SQL, readings

HOUR = 3600

# ---------------------------------------------------------------- AND across kinds (RU10, RU11)

#: Four assets whose readings stand at whole hours, so that intervals of different kinds can be equal.
HOURLY_SQL = f"SELECT k % 4 AS asset_id, parameter, epoch - epoch % {HOUR} AS epoch, value, k FROM ({READINGS_SQL})"


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    r = readings(spark, sf)
    return r.withColumn("asset_id", F.pmod("k", F.lit(4)).cast("long")).withColumn("epoch", F.col("epoch") - F.pmod("epoch", F.lit(HOUR)))


MIXED_SPEC = [
    (61, 1, "click", "raw", ">", 15.0, 0, HOUR, "and"), (61, 2, "view", "count", ">=", 2.0, 6 * HOUR, HOUR, "and"),
    (62, 1, "error", "magnitude", ">", 20.0, 0, HOUR, "and"), (62, 2, "purchase", "count", ">", 1.0, 12 * HOUR, HOUR, "and"),
    (63, 1, "click", "raw", "<", 30.0, HOUR, HOUR, "and"), (63, 2, "view", "magnitude", ">", 5.0, 0, HOUR, "and"),
    (63, 3, "error", "count", ">=", 1.0, 4 * HOUR, HOUR, "and"),
    (64, 1, "click", "raw", ">", 10.0, 0, HOUR, "and"), (64, 2, "view", "count", ">=", 1.0, HOUR, HOUR, "and"),
    (65, 1, "click", "raw", ">", 15.0, 0, HOUR, "and"), (65, 2, "error", "magnitude", ">", 5.0, 0, HOUR, "and"),
]


def _members_sql(spec: list[tuple]) -> str:
    """CTEs ``m`` (rule_id, condition_id, asset_id, s, e: islands, points and single grid cells) and ``t`` (the
    same with a member's touching cells as one)."""
    at = f"{RUN_START} + duration * ((r.epoch - {RUN_START}) // duration)"
    return f"""
WITH r AS ({HOURLY_SQL}),
spec AS ({_spec_sql(spec)}),
h AS (SELECT DISTINCT rule_id, condition_id, asset_id, epoch, 2 * data_frequency - 1 AS lim, duration AS dur,
             {RUN_START} - (2 * data_frequency - 1) AS lo, {RUN_END} AS hi
      FROM r JOIN spec USING (parameter) WHERE function = 'raw' AND {_cmp_sql('r.value')}),
i AS (SELECT rule_id, condition_id, asset_id, start_time AS s, end_time AS e FROM ({_islands_sql('h', 'rule_id, condition_id, asset_id')})
      WHERE end_time - start_time >= dur OR start_time = lo OR end_time = hi),
p AS (SELECT DISTINCT rule_id, condition_id, asset_id, epoch AS s, epoch AS e
      FROM r JOIN spec USING (parameter) WHERE function = 'magnitude' AND {_cmp_sql('r.value')}),
n AS (SELECT rule_id, condition_id, asset_id, {at} AS s, any_value(duration) AS d, any_value(operator) AS operator,
             any_value(threshold) AS threshold, count(*) AS n
      FROM r JOIN spec USING (parameter) WHERE function = 'count' GROUP BY ALL),
c AS (SELECT rule_id, condition_id, asset_id, s, s + d AS e, d FROM n WHERE {_cmp_sql('n')}),
cc AS (SELECT rule_id, condition_id, asset_id, min(s) AS s, max(e) AS e
       FROM (SELECT *, sum(CASE WHEN before = s THEN 0 ELSE 1 END) OVER (PARTITION BY rule_id, condition_id, asset_id ORDER BY s) AS g
             FROM (SELECT *, lag(e) OVER (PARTITION BY rule_id, condition_id, asset_id ORDER BY s) AS before FROM c))
       GROUP BY rule_id, condition_id, asset_id, g),
m AS (SELECT * FROM i UNION ALL SELECT * FROM p UNION ALL SELECT rule_id, condition_id, asset_id, s, e FROM c),
t AS (SELECT * FROM i UNION ALL SELECT * FROM p UNION ALL SELECT * FROM cc),
size AS (SELECT rule_id, count(*) AS n FROM spec GROUP BY rule_id)"""


def _overlap_sql(spec: list[tuple]) -> str:
    return _members_sql(spec) + """,
two AS (SELECT a.rule_id, a.asset_id, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e
        FROM t a JOIN t b ON a.rule_id = b.rule_id AND a.asset_id = b.asset_id AND a.condition_id = 1 AND b.condition_id = 2
         AND a.s <= b.e AND b.s <= a.e),
three AS (SELECT a.rule_id, a.asset_id, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e
          FROM two a JOIN t b ON a.rule_id = b.rule_id AND a.asset_id = b.asset_id AND b.condition_id = 3 AND a.s <= b.e AND b.s <= a.e)
SELECT rule_id, asset_id, s AS start_time, e AS end_time FROM two JOIN size USING (rule_id) WHERE n = 2
UNION ALL SELECT rule_id, asset_id, s, e FROM three
"""


def _exact_sql(spec: list[tuple]) -> str:
    return _members_sql(spec) + """
SELECT rule_id, asset_id, s AS start_time, e AS end_time FROM m JOIN size USING (rule_id)
GROUP BY rule_id, asset_id, s, e, n HAVING count(DISTINCT condition_id) = n
"""


def _mixed(spark: SparkSession, sf: str, rule_ids: tuple[int, ...], mode: str) -> DataFrame:
    r = hourly(spark, sf)
    return ru.evaluate(r, _run_window(_conditions(spark, _rows(rule_ids), SPEC_COLS), r), mode)


def _rows(rule_ids: tuple[int, ...]) -> list[tuple]:
    return [s for s in MIXED_SPEC if s[0] in rule_ids]


@register("ru11_raw_and_count", _overlap_sql(_rows((61, 64))))
def ru11_raw_and_count(spark: SparkSession, sf: str) -> DataFrame:
    """RU10/RU11: islands of a threshold AND event counts: spans inside both, touching cells as one."""
    return _mixed(spark, sf, (61, 64), "overlap")


@register("ru11_raw_and_count_exact", _exact_sql(_rows((61, 64))))
def ru11_raw_and_count_exact(spark: SparkSession, sf: str) -> DataFrame:
    """RU11 exact: islands that are equal to a grid cell."""
    return _mixed(spark, sf, (61, 64), "exact")


@register("ru11_magnitude_and_count", _overlap_sql(_rows((62,))))
def ru11_magnitude_and_count(spark: SparkSession, sf: str) -> DataFrame:
    """RU10/RU11: single events of a magnitude AND an event count: the events' times inside the cells."""
    return _mixed(spark, sf, (62,), "overlap")


@register("ru11_three_kinds", _overlap_sql(_rows((63, 65))))
def ru11_three_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """RU10: a threshold, a magnitude and an event count in one AND rule, beside a rule of two kinds."""
    return _mixed(spark, sf, (63, 65), "overlap")


@register("ru11_magnitude_and_count_exact", _exact_sql(_rows((62, 63, 65))))
def ru11_magnitude_and_count_exact(spark: SparkSession, sf: str) -> DataFrame:
    """RU11 exact: a magnitude's time is equal to an island of one reading, never to a grid cell (which lasts)."""
    return _mixed(spark, sf, (62, 63, 65), "exact")


# ---------------------------------------------------------------- thresholds of all operators on one series

def _ladder_spec() -> list[tuple]:
    """Rules of every operator with the thresholds 5, 10, ... 60 on three tags, some of them equal."""
    rows, rule = [], 700
    for tag in ("click", "view", "error"):
        for op in (">", ">=", "<", "<=", "==", "!="):
            for t in range(5, 65, 5 if op in (">", "<") else 20):
                for copy in range(1 + (t == 25)):
                    rows.append((rule, 1, tag, "magnitude", op, float(t) + (0.31 if op in ("==", "!=") else 0.0), 0, HOUR, "or"))
                    rule += 1
    return rows


LADDER_SPEC = _ladder_spec()
RU5_LADDER_SQL = f"""
WITH r AS ({READINGS_SQL}), spec AS ({_spec_sql(LADDER_SPEC)})
SELECT rule_id, count(*) AS n_hits, min(epoch) AS first_time, max(epoch) AS last_time, count(DISTINCT asset_id) AS n_assets
FROM r JOIN spec USING (parameter) WHERE epoch BETWEEN {RUN_START} AND {RUN_END} AND {_cmp_sql('value')} GROUP BY rule_id
"""


@register("ru5_threshold_ladder", RU5_LADDER_SQL)
def ru5_threshold_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """RU8/RU10: rules of all six operators on three tags; each reading meets the rules it passes only."""
    r = readings(spark, sf)
    hits = ru.evaluate(r, _run_window(_conditions(spark, LADDER_SPEC, SPEC_COLS), r))
    return hits.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_hits"), F.min("start_time").alias("first_time"),
                                       F.max("end_time").alias("last_time"), F.count_distinct("asset_id").alias("n_assets"))


# ---------------------------------------------------------------- script rules from documents (RU15, RU16)

#: (offset of the rule id, type, script, [(parameter, operator, threshold, duration)]) of each asset's documents.
SCRIPT_TEXTS = [(1, "script", "above_history", [("click", ">", 3.0, 5 * DAY)]),
                (2, "Script", "spread", [("click", ">", 10.0, 2 * DAY), ("view", ">", 0.0, 2 * DAY)]),
                (3, None, None, [("error", ">", 50.0, 0)]),
                (4, "script", "no_such_script", [("click", ">", 1.0, 0)])]
SCRIPT_PERIOD = 10 * DAY


def _script_documents(spark: SparkSession, sf: str):
    """Four rule documents for each of the assets, three of them of type script, and a run over all data."""
    from .plans import engine
    from .session import cut_lineage
    r = readings(spark, sf).withColumn("asset_id", F.col("asset_id").cast("string")).withColumn("sensor_type", F.lit("events"))
    assets = cut_lineage(r.select("asset_id").distinct().withColumn("data_frequency", F.lit(HOUR)))

    def condition(i, script, p, op, t, d):
        return F.struct(F.lit(i).alias("condition_id"), F.array("asset_id").alias("asset_id"), F.lit(p).alias("parameter"),
                        F.lit(op).alias("operator"), F.lit(None).cast("int").alias("class"), F.lit(t).alias("threshold"),
                        F.lit(d).alias("duration"), F.lit(None).cast("string").alias("wire"),
                        F.lit(None if script else "raw").cast("string").alias("function"),
                        F.lit(None).cast("string").alias("wire_length_from"), F.lit(None).cast("string").alias("wire_length_to"),
                        F.lit(SCRIPT_PERIOD).alias("rule_run_frequency"), F.lit("events").alias("sensor_type"),
                        F.lit(None).cast("int").alias("baseline_time"), F.lit("abs").alias("threshold_unit"),
                        F.lit(script).cast("string").alias("path"))

    texts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(kind).cast("string").alias("rule_type"),
                               F.array(*[condition(k + 1, script, *c) for k, c in enumerate(conditions)]).alias("conditions"))
                      for i, kind, script, conditions in SCRIPT_TEXTS])
    docs = assets.select("asset_id", F.inline(texts)).select(
        (F.col("asset_id").cast("int") * 10 + F.col("i")).alias("rule_id"), F.lit("rule").alias("rule_name"), F.lit("t").alias("tenant_id"),
        F.lit("or").alias("join_condition"), F.lit("low").alias("severity"), F.array().cast("array<int>").alias("risk_register_controls"),
        F.lit("create").alias("operation"), "rule_type", "conditions")
    state = r.agg((F.max("epoch") - F.pmod(F.max("epoch"), F.lit(SCRIPT_PERIOD)) + 100).alias("last_run_time")).select(
        F.lit("wf").alias("workflow_id"), F.lit("events").alias("sensor_type"), "last_run_time", F.lit(None).cast("timestamp").alias("last_updated_date"))
    families = {"click": "series", "view": "series", "error": "magnitude"}
    return engine.run_rules(cut_lineage(docs), assets, r, cut_lineage(state), "wf", engine_period=1800, downtime=SCRIPT_PERIOD, now=0, families=families)


RU16_SQL = f"""
WITH r AS ({READINGS_SQL}),
t AS (SELECT max(epoch) AS mx, max(epoch) - max(epoch) % {SCRIPT_PERIOD} + 100 AS lr FROM r),
win AS (SELECT CAST(trunc(CAST(lr AS DOUBLE) - 100.0 - {SCRIPT_PERIOD}.0) AS BIGINT) AS lo,
               CAST(trunc(CAST(lr AS DOUBLE) - 100.0 + 1800.0 * ((mx - lr) / 1800.0)) AS BIGINT) AS hi FROM t),
c AS (SELECT asset_id, epoch, value FROM r, win WHERE parameter = 'click' AND epoch BETWEEN lo - {5 * DAY} AND hi),
h AS (SELECT asset_id, epoch, value, avg(value) OVER (PARTITION BY asset_id ORDER BY epoch
             RANGE BETWEEN {5 * DAY} PRECEDING AND 1 PRECEDING) AS m FROM c),
one AS (SELECT asset_id, epoch, max(value) AS value FROM r WHERE parameter = 'click' GROUP BY ALL),
two AS (SELECT asset_id, epoch, max(value) AS value FROM r WHERE parameter = 'view' GROUP BY ALL),
s AS (SELECT one.asset_id, one.epoch, one.value - two.value AS d, one.epoch - two.epoch AS age
      FROM one ASOF JOIN two ON one.asset_id = two.asset_id AND one.epoch >= two.epoch)
SELECT DISTINCT CAST(asset_id * 10 + 1 AS INTEGER) AS rule_id, CAST(asset_id AS VARCHAR) AS asset_id, epoch AS start_time, epoch AS end_time
FROM h, win WHERE epoch BETWEEN lo AND hi AND value > 3.0 * m
UNION ALL SELECT CAST(asset_id * 10 + 2 AS INTEGER), CAST(asset_id AS VARCHAR), epoch, epoch
FROM s, win WHERE epoch BETWEEN lo AND hi AND age <= {2 * DAY} AND d > 10.0
UNION ALL SELECT CAST(asset_id * 10 + 3 AS INTEGER), CAST(asset_id AS VARCHAR), epoch, epoch
FROM r, win WHERE parameter = 'error' AND value > 50.0 AND epoch BETWEEN lo AND hi
"""


@register("ru16_script_documents", RU16_SQL)
def ru16_script_documents(spark: SparkSession, sf: str) -> DataFrame:
    """RU15/RU16: documents of type script reach their functions of one asset's frame, beside standard ones."""
    return _script_documents(spark, sf).anomalies


RU16_ERRORS_SQL = f"""
SELECT DISTINCT CAST(asset_id * 10 + 4 AS INTEGER) AS rule_id, 'unknown script' AS error, 'no_such_script' AS detail FROM ({READINGS_SQL})
"""


@register("ru16_script_errors", RU16_ERRORS_SQL)
def ru16_script_errors(spark: SparkSession, sf: str) -> DataFrame:
    """RU16/RU3: documents whose script is not registered give error rows."""
    return _script_documents(spark, sf).errors
