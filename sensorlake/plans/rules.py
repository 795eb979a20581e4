"""Alert rules as data, evaluated for all rules in one Spark plan (RU4-RU10, RU14).

A *condition* frame has one row per rule x condition x asset (asset null =
every asset, evaluated per asset), see ``CONDITION_SCHEMA``:

    rule_id, condition_id, asset_id, parameter, sensor_type (null = any)
    function        a kind of ``KINDS``; ``dispatch`` derives it from a document's names
    operator        > < >= <= == !=
    threshold, duration, data_frequency
    join_condition  'and' | 'or'; threshold_unit '%' | other
    baseline_time   (differential kinds), class (count / magnitude, optional)
    wire, depth_from, depth_to (fibre kinds)
    start_time, end_time (run window of the rule)

Readings are the long table ``asset_id, parameter, epoch, value, k``
(``k`` = event class), with ``sensor_type``, ``arrival`` (epoch seconds at which
a row came in), ``wire`` and ``depth`` where rules need them. Rules are never
turned into SQL text: every kind becomes series -> hit times -> islands -> AND/OR. A series (readings, sliding
means, z-scores, changes, event counts) is computed once per (asset, parameter, run window and what else it
depends on) and meets the thresholds of all its rules in one sorted ladder (``plans.ladder``). The work
therefore grows with the readings and the distinct series; only the hits grow with the rules. There is no per-rule job.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.scalars import OPERATORS, pct_change
from ..operators.intervals import all_present, intersect_members
from ..operators.islands import islands
from ..operators.windows import forward_average, trailing_stats
from ..session import estimated_bytes, local_frame
from . import ladder

CONDITION_SCHEMA = StructType([
    StructField("rule_id", IntegerType()), StructField("condition_id", IntegerType()),
    StructField("asset_id", LongType()), StructField("parameter", StringType()),
    StructField("function", StringType()), StructField("operator", StringType()),
    StructField("threshold", DoubleType()), StructField("duration", LongType()),
    StructField("data_frequency", LongType()), StructField("join_condition", StringType()),
    StructField("threshold_unit", StringType()), StructField("baseline_time", LongType()),
    StructField("class", IntegerType()), StructField("start_time", LongType()), StructField("end_time", LongType()),
    StructField("sensor_type", StringType()), StructField("wire", StringType()),
    StructField("depth_from", LongType()), StructField("depth_to", LongType()),
])

#: Rule kinds that ``evaluate`` knows. Points hit single times, intervals hit islands, cells a grid.
INTERVAL_KINDS = ("raw", "avg", "zscore", "differential", "fibre_differential")
POINT_KINDS = ("magnitude", "fibre_raw", "fibre_avg", "fibre_min", "fibre_max")
KINDS = (*INTERVAL_KINDS, *POINT_KINDS, "count")

# Function names of rule documents and the function each one means.
FUNCTION_NAMES = {
    "raw": "raw", "average": "avg", "avg": "avg", "minimum": "min", "maximum": "max", "zscore": "zscore",
    "differential": "differential", "differential_over_a_baseline_value": "differential",
    "differential over a baseline value": "differential",
}
# Parameters of rule documents and the family of sensors each one belongs to.
PARAMETER_FAMILIES = {
    "pressure": "series", "temperature": "series", "surface_flow_rate": "series", "well_head_pressure": "series",
    "dts": "fibre", "axial_strain": "fibre", "bend_magnitude": "fibre", "distributed_temperature": "fibre",
    "magnitude": "magnitude", "no_of_events": "count", "number_of_seismic_events": "count",
}
# Fibre parameters that are stored under another column name.
FIBRE_COLUMNS = {"axial_strain": "axial_strain_thermal", "bend_magnitude": "bend_mag", "dts": "curr_temp"}
# Functions each family can evaluate, and the kind that does it.
FAMILY_KINDS = {
    "series": {"raw": "raw", "avg": "avg", "zscore": "zscore", "differential": "differential"},
    "fibre": {"raw": "fibre_raw", "avg": "fibre_avg", "min": "fibre_min", "max": "fibre_max",
              "differential": "fibre_differential"},
}

MEMBER = ["rule_id", "condition_id", "asset_id"]


@dataclass
class KindFacts:
    """What the conditions of one kind need from the readings."""
    lo: int | None = None
    hi: int | None = None
    base_lo: int | None = None
    base_hi: int | None = None
    durations: set[int] = field(default_factory=set)
    wildcard: bool = False
    explicit: bool = False


@dataclass
class RulePlan:
    """Prepared conditions and the plan-time facts of each kind; ``mixed_counts``: some AND rule joins an event
    count with another kind."""
    conditions: DataFrame
    kinds: dict[str, KindFacts]
    has_and: bool
    has_or: bool
    mixed_counts: bool = False


def gap_limit(data_frequency) -> Column:
    """Island gap limit ``2 * data_frequency - 1`` (S1)."""
    f = data_frequency if isinstance(data_frequency, Column) else F.lit(data_frequency)
    return 2 * f.cast("long") - 1


def _lookup(names: Mapping[str, str], value: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[value]


def dispatch(conditions: DataFrame, families: Mapping[str, str] = PARAMETER_FAMILIES,
             columns: Mapping[str, str] = FIBRE_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(conditions whose ``function`` is a kind, error rows) from document names (RU10, PJ9).

    The parameter's family decides: events are counted or filtered by magnitude
    whatever the function says, series and fibre parameters evaluate the named
    function. Names match without regard to case or outer blanks; a missing
    function means raw. An unknown function, parameter or operator, or a
    function its family does not have, gives an error row (rule_id, error,
    detail) and no anomalies.
    """
    name = F.lower(F.trim(F.coalesce("function", F.lit("raw"))))
    function, family = _lookup(FUNCTION_NAMES, name), _lookup(families, F.col("parameter"))
    of_family = None
    for fam, kinds in FAMILY_KINDS.items():
        known = _lookup(kinds, function)
        of_family = F.when(family == fam, known) if of_family is None else of_family.when(family == fam, known)
    kind = F.when(family.isin("count", "magnitude"), family).otherwise(of_family)
    operator = F.col("operator").isin(*OPERATORS)
    c = conditions.withColumn("_kind", kind).withColumn("_error", F.when(
        family.isNull(), F.lit("unknown parameter")).when(function.isNull(), F.lit("unknown function")).when(
        kind.isNull(), F.lit("function not available for parameter")).when(
        ~F.coalesce(operator, F.lit(False)), F.lit("unknown operator")))
    detail = F.concat_ws(" ", F.coalesce("parameter", F.lit("-")), F.coalesce("function", F.lit("-")), F.coalesce("operator", F.lit("-")))
    errors = c.filter(F.col("_error").isNotNull()).select("rule_id", F.col("_error").alias("error"), detail.alias("detail")).distinct()
    parameter = F.when(family == "fibre", F.coalesce(_lookup(columns, F.col("parameter")), F.col("parameter"))).otherwise(F.col("parameter"))
    good = c.filter(F.col("_error").isNull()).withColumn("parameter", parameter).withColumn("function", F.col("_kind"))
    return good.drop("_kind", "_error"), errors


def prepare(conditions: DataFrame) -> RulePlan:
    """Add ``kind``, ``limit`` and ``n_members`` and read the plan-time facts.

    ``asset_id`` null means "every asset, evaluated per asset": the condition
    is joined to the readings on ``parameter`` only, and AND combines the
    rule's conditions per asset. Otherwise members are (condition, asset)
    pairs of the rule. Conditions that the plan estimates at no more than ``SMALL_BYTES`` are read once and go on
    as local rows, so that no step over rules shuffles or runs again; of more, only the facts are read,
    one row per kind, duration and scope. A kind outside ``KINDS``
    raises; ``dispatch`` turns documents' names into kinds and errors.
    """
    spark = conditions.sparkSession
    missing = [f for f in CONDITION_SCHEMA.fields if f.name not in conditions.columns]
    c = conditions.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    small = estimated_bytes(c) <= SMALL_BYTES
    if small:
        c = c.coalesce(1)
    points = ", ".join(f"'{k}'" for k in POINT_KINDS)
    c = c.withColumns({"kind": F.lower("function"), "limit": gap_limit(F.col("data_frequency")),
                       "join_condition": F.lower(F.coalesce(F.col("join_condition"), F.lit("or")))})
    c = c.selectExpr("*", "count(1) OVER (PARTITION BY rule_id) AS n_members",
                     f"count(CASE WHEN kind IN ({points}) THEN 1 END) OVER (PARTITION BY rule_id) AS n_points",
                     "count(CASE WHEN kind = 'count' THEN 1 END) OVER (PARTITION BY rule_id) AS n_counts")
    facts = ["start_time - greatest(coalesce(limit, 0), coalesce(duration, 0)) AS lo", "end_time AS hi", "baseline_time AS base_lo",
             "baseline_time AS base_hi", "asset_id IS NULL AS wild", "join_condition = 'and' AND n_members > 1 AS is_and"]
    if small:  # read once; from here on the rules are local rows of the plan
        rows = [{**r.asDict(), "mixed": r["is_and"] and 0 < r["n_counts"] < r["n_members"]} for r in c.selectExpr("*", *facts).collect()]
        c = local_frame(spark, [tuple(r[n] for n in c.columns) for r in rows], c.schema).coalesce(1)
    else:
        mixed = "is_and AND n_counts > 0 AND n_counts < n_members"
        rows = (c.selectExpr("kind", "duration", "n_counts", "n_members", *facts).selectExpr("*", f"{mixed} AS mixed")
                 .groupBy("kind", "duration", "wild", "is_and").agg(
                     F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("base_lo").alias("base_lo"),
                     F.max("base_hi").alias("base_hi"), F.max("mixed").alias("mixed")).collect())
    kinds: dict[str, KindFacts] = {}
    for r in rows:
        if r["kind"] not in KINDS:
            raise ValueError(f"unknown rule kind {r['kind']!r}; expected one of {KINDS}")
        k = kinds.setdefault(r["kind"], KindFacts())
        for name, pick in (("lo", min), ("hi", max), ("base_lo", min), ("base_hi", max)):
            known = [x for x in (getattr(k, name), r[name]) if x is not None]
            setattr(k, name, pick(known) if known else None)
        if r["duration"] is not None:
            k.durations.add(int(r["duration"]))
        k.wildcard |= r["wild"]
        k.explicit |= not r["wild"]
    return RulePlan(c, kinds, any(r["is_and"] for r in rows), any(not r["is_and"] for r in rows), any(r["mixed"] for r in rows))


#: Conditions that the plan estimates at no more than this are local rows of the plan.
SMALL_BYTES = 4 << 20

#: What the series of a kind depends on, besides asset, parameter and sensor type.
SERIES = {
    "raw": ("limit", "start_time", "end_time"), "avg": ("duration", "start_time", "end_time"),
    "zscore": ("duration", "start_time", "end_time"),
    "differential": ("baseline_time", "threshold_unit", "start_time", "end_time"),
    "magnitude": ("class", "start_time", "end_time"), "count": ("class", "duration", "start_time", "end_time"),
    **{k: ("wire", "depth_from", "depth_to", "start_time", "end_time") for k in ("fibre_raw", "fibre_avg", "fibre_min", "fibre_max")},
    "fibre_differential": ("wire", "depth_from", "depth_to", "baseline_time", "threshold_unit", "start_time", "end_time"),
}


def _series(plan: RulePlan, kind: str) -> tuple[DataFrame, DataFrame]:
    """(distinct series of a kind, its conditions), both with ``_spec``: the text of everything that the
    series' values depend on. Rules that differ in operator or threshold only share a series."""
    names = ("asset_id", "parameter", "sensor_type", *SERIES[kind])
    spec = ", ".join(f"coalesce(cast({x} AS string), '*')" for x in names)
    c = plan.conditions.where(f"kind = '{kind}'").selectExpr("*", f"concat_ws('|', {spec}) AS _spec")
    return c.select("_spec", *names).distinct(), c


def _scoped(readings: DataFrame, specs: DataFrame, facts: KindFacts, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Readings x series: explicit assets by (asset, parameter), wildcard ones by parameter.
    A series' sensor type, where both sides have one, must agree."""
    c = specs.withColumnRenamed("sensor_type", "_sensor").withColumnRenamed("wire", "_wire").withColumnRenamed("class", "_class")
    parts = []
    if facts.explicit:
        parts.append(readings.join(c.filter(F.col("asset_id").isNotNull()), ["asset_id", "parameter", *extra_keys], "inner"))
    if facts.wildcard:
        every = c.filter(F.col("asset_id").isNull()).drop("asset_id")
        parts.append(readings.join(every, ["parameter", *extra_keys], "inner"))
    j = _union(parts)
    if "sensor_type" in readings.columns:
        j = j.filter(F.col("_sensor").isNull() | (F.col("_sensor") == F.col("sensor_type")))
    if "_class" in j.columns:
        j = j.filter(F.col("_class").isNull() | (F.col("k") == F.col("_class")))
    if "_wire" in j.columns:
        inside = F.col("depth_from").isNull() | F.col("depth_to").isNull() | F.col("depth").between(F.col("depth_from"), F.col("depth_to"))
        wire = F.col("wire").cast("string") if "wire" in readings.columns else F.lit(None).cast("string")
        j = j.filter(inside & (F.col("_wire").isNull() | (wire == F.col("_wire"))))
    return j


def _in_window(readings: DataFrame, plan: RulePlan, kind: str, lo: Column, hi: Column, at: str = "epoch") -> tuple[DataFrame, DataFrame]:
    """(readings of one kind's series with ``at`` inside ``[lo, hi]``, the kind's conditions); the kind's own
    bounds filter the readings ahead of the join."""
    facts = plan.kinds[kind]
    specs, c = _series(plan, kind)
    r = readings
    if facts.lo is not None and facts.hi is not None:
        r = r.filter(F.col(at).between(facts.lo, facts.hi))
    return _scoped(r, specs, facts).filter((F.col(at) >= lo) & (F.col(at) <= hi)), c


def _passing(series: DataFrame, c: DataFrame, value: str = "value", keep: tuple[str, ...] = ("epoch",)) -> DataFrame:
    """Rows of the series x the rules they pass (``ladder``): ``MEMBER``, what the rule's members combine by, and ``keep``."""
    own = ("rule_id", "condition_id", "limit", "n_members", "join_condition", "n_points", "n_counts")
    rules = c.selectExpr("_spec", "operator", "threshold", *own, "asset_id IS NULL AS _wild")
    rows = series.select("_spec", "asset_id", value, *[k for k in keep if k != value])
    j = ladder.passing(rows, rules, "_spec", value, (*own, "_wild"))
    return j.selectExpr("rule_id", "condition_id", "asset_id", *own[2:], "if(_wild, cast(asset_id AS string), '*') AS _scope", *keep)


def raw_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU4: readings whose value passes the operator, in ``[start - limit, end]``."""
    return _passing(*_in_window(readings, plan, "raw", F.col("start_time") - F.col("limit"), F.col("end_time")))


def avg_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU5: forward sliding mean over ``[t, t + duration - 1]`` passes the operator."""
    j, c = _in_window(readings, plan, "avg", F.col("start_time"), F.col("end_time"))
    fa = forward_average(j.select("_spec", "asset_id", "epoch", "value", "duration"), ["_spec", "asset_id"], "epoch", "value",
                         F.col("duration"), durations=sorted(plan.kinds["avg"].durations))
    return _passing(fa, c, "avg_value")


def zscore_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """z-score rule (S9): history ``[start - d, end)``, flags in ``[start, end)``."""
    j, c = _in_window(readings, plan, "zscore", F.col("start_time") - F.col("duration"), F.col("end_time") - 1)
    st = trailing_stats(j.select("_spec", "asset_id", "epoch", "value", "duration", "start_time"), ["_spec", "asset_id"], "epoch",
                        "value", F.col("duration"), durations=sorted(plan.kinds["zscore"].durations))
    z = F.when(F.col("hist_std") != 0, F.abs((F.col("value") - F.col("hist_mean")) / F.col("hist_std")))
    st = st.filter(F.col("epoch") >= F.col("start_time")).select("_spec", "asset_id", "epoch", z.alias("_z"))
    return _passing(st, c, "_z")


def _change(j: DataFrame, absolute: bool) -> DataFrame:
    """``_change`` against the baseline: percent where the unit is ``%`` (S4: a zero baseline gives no hit), else
    the plain difference."""
    percent = pct_change("value", "baseline_value", absolute=absolute)
    return j.withColumn("_change", F.when(F.col("threshold_unit") == "%", percent).otherwise(F.col("value") - F.col("baseline_value")))


def _baseline(readings: DataFrame, plan: RulePlan, kind: str, keys: list[str]) -> DataFrame:
    """Readings at the series' baseline times: an equi join on the time, inside the baselines' own bounds."""
    facts = plan.kinds[kind]
    r = readings.filter(F.col("epoch").between(facts.base_lo, facts.base_hi)).withColumnRenamed("epoch", "baseline_time")
    b = _scoped(r, _series(plan, kind)[0], facts, ("baseline_time",))
    return b.groupBy(*keys).agg(F.max("value").alias("baseline_value"))


def differential_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU6: change vs the reading at ``baseline_time``."""
    keys = ["_spec", "asset_id"]
    j, c = _in_window(readings, plan, "differential", F.col("start_time"), F.col("end_time"))
    j = j.join(_baseline(readings, plan, "differential", keys), keys, "inner")
    return _passing(_change(j, absolute=True), c, "_change")


def fibre_hits(readings: DataFrame, plan: RulePlan, kind: str) -> DataFrame:
    """RU9: times at which any value (raw) or the average, least or largest value
    over the depth range passes the operator."""
    j, c = _in_window(readings, plan, kind, F.col("start_time"), F.col("end_time"))
    if kind == "fibre_raw":
        return _passing(j, c).distinct()
    of = {"fibre_avg": F.avg, "fibre_min": F.min, "fibre_max": F.max}[kind]
    return _passing(j.groupBy("_spec", "asset_id", "epoch").agg(of("value").alias("_v")), c, "_v")


def fibre_differential_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU9: signed change vs the profile at ``baseline_time``, depth by depth; times with any hit."""
    keys = ["_spec", "asset_id", "depth"]
    j, c = _in_window(readings, plan, "fibre_differential", F.col("start_time"), F.col("end_time"))
    j = j.join(_baseline(readings, plan, "fibre_differential", keys), keys, "inner")
    return _passing(_change(j, absolute=False), c, "_change").distinct()


def count_cells(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU7 / AG8: tumbling event count on a grid anchored at the window start;
    cells whose count passes the operator -> ``[start + d*g, start + d*g + d]``."""
    j, c = _in_window(readings, plan, "count", F.col("start_time"), F.col("end_time"))
    g = F.floor((F.col("epoch") - F.col("start_time")) / F.col("duration")).cast("long")
    counted = (j.groupBy("_spec", "asset_id", (F.col("start_time") + F.col("duration") * g).alias("_start"), "duration")
                .agg(F.count(F.lit(1)).alias("n_events")))
    cells = _passing(counted, c, "n_events", ("n_events", "_start", "duration"))
    return cells.withColumn("start_time", F.col("_start")).withColumn("end_time", F.col("_start") + F.col("duration")).drop("_start")


def magnitude_hits(readings: DataFrame, plan: RulePlan) -> DataFrame:
    """RU8: readings passing the operator (optionally of one class) that came in
    during the run window: by ``arrival`` where the readings have it, so that
    late events are not missed, else by ``epoch``."""
    at = "arrival" if "arrival" in readings.columns else "epoch"
    return _passing(*_in_window(readings, plan, "magnitude", F.col("start_time"), F.col("end_time"), at))


def _islands_of(hits: DataFrame, plan: RulePlan) -> DataFrame:
    """Islands per member; only (member, time, limit) travel through the shuffle.
    Rule parameters come back afterwards from the condition table (one row per
    rule x condition) for the duration / window-edge test (S2)."""
    isl = (islands(hits.select(*MEMBER, "epoch", "limit"), MEMBER, "epoch", "limit", extra=["limit"])
           .withColumnRenamed("start_time", "_is").withColumnRenamed("end_time", "_ie"))
    params = (plan.conditions.select("rule_id", "condition_id", "duration", "start_time", "end_time", "n_members", "n_points",
                                     "n_counts", "join_condition", F.col("asset_id").isNull().alias("_wild"))
                             .dropDuplicates(["rule_id", "condition_id"]))
    j = isl.join(params, ["rule_id", "condition_id"])
    keep = ((F.col("_ie") - F.col("_is") >= F.coalesce("duration", F.lit(0)))
            | (F.col("_is") == F.col("start_time") - F.col("limit"))
            | (F.col("_ie") == F.col("end_time")))
    scope = F.when(F.col("_wild"), F.col("asset_id").cast("string")).otherwise(F.lit("*"))
    return j.filter(keep).select(*MEMBER, "n_members", "join_condition", scope.alias("_scope"), "n_points", "n_counts",
                                 F.col("_is").alias("start_time"), F.col("_ie").alias("end_time"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_MEMBER_ROW = [*MEMBER, "n_members", "join_condition", "_scope", "n_points", "n_counts", "start_time", "end_time"]


def member_intervals(readings: DataFrame, conditions: DataFrame | RulePlan, counts: bool = False) -> DataFrame:
    """Per member (rule, condition, asset) anomaly intervals for all rule kinds, event counts only with
    ``counts``: ``rule_id, condition_id, asset_id, n_members, join_condition, _scope, n_points, n_counts,
    start_time, end_time``; a point kind's interval is its time, a count's the grid cell."""
    plan = conditions if isinstance(conditions, RulePlan) else prepare(conditions)
    hits = {"raw": raw_hits, "avg": avg_hits, "zscore": zscore_hits, "differential": differential_hits,
            "fibre_differential": fibre_differential_hits}
    parts = [_islands_of(hits[k](readings, plan), plan).select(*_MEMBER_ROW) for k in INTERVAL_KINDS if k in plan.kinds]
    for k in POINT_KINDS:
        if k in plan.kinds:
            h = magnitude_hits(readings, plan) if k == "magnitude" else fibre_hits(readings, plan, k)
            parts.append(h.withColumn("start_time", F.col("epoch")).withColumn("end_time", F.col("epoch")).select(*_MEMBER_ROW))
    if counts and "count" in plan.kinds:
        parts.append(count_cells(readings, plan).select(*_MEMBER_ROW))
    if not parts:
        return readings.sparkSession.createDataFrame(
            [], f"rule_id int, condition_id int, asset_id {readings.schema['asset_id'].dataType.simpleString()}, n_members long, join_condition string, _scope string, "
                "n_points long, n_counts long, start_time long, end_time long")
    return _union(parts)


def touching_cells(cells: DataFrame) -> DataFrame:
    """Grid cells that hold an anomaly, each member's touching ones as one interval: a cell ends where the next
    begins, and a sweep over members needs every member's intervals apart."""
    carried = ["n_members", "join_condition", "_scope", "n_points", "n_counts", "duration"]
    runs = islands(cells.select(*MEMBER, *carried, F.col("start_time").alias("_at")), MEMBER, "_at", "duration", extra=carried)
    return runs.withColumn("end_time", F.col("end_time") + F.col("duration")).select(*_MEMBER_ROW)


def _scope_asset(readings: DataFrame) -> Column:
    t = readings.schema["asset_id"].dataType
    return F.when(F.col("_scope") == "*", F.lit(None)).otherwise(F.col("_scope")).cast(t).alias("asset_id")


_ANOMALY = ["rule_id", "asset_id", "start_time", "end_time"]


def evaluate(readings: DataFrame, conditions: DataFrame | RulePlan, mode: str = "overlap") -> DataFrame:
    """Anomalies ``rule_id, asset_id, start_time, end_time`` of every rule (RU10).

    OR rules (and single-member rules) keep every member interval (UNION ALL;
    ``asset_id`` = the member's asset). AND rules keep, in ``exact`` mode (RU11), the
    intervals that every member holds with the same start and end; in
    ``overlap`` mode the spans where all members hold an interval. There a member is an island, a point or
    the touching grid cells of an event count, and one sweep line counts members of all kinds. AND rules of
    point kinds alone need every member at the same time, and those of event counts alone every member
    in the same grid cell (S13). ``asset_id`` is the asset of a per-asset rule, null for a multi-asset rule.
    """
    if mode not in ("overlap", "exact"):
        raise ValueError(f"unknown mode {mode!r}")
    plan = conditions if isinstance(conditions, RulePlan) else prepare(conditions)
    is_and = (F.col("join_condition") == "and") & (F.col("n_members") > 1)
    alike = (F.col("n_points") == F.col("n_members")) | (F.col("n_counts") == F.col("n_members"))
    member = F.concat_ws(":", "condition_id", "asset_id")
    group = ["rule_id", "_scope"]
    out = ["rule_id", _scope_asset(readings), "start_time", "end_time"]
    every = member_intervals(readings, plan, counts=True)
    parts = []
    if plan.has_or:
        parts.append(every.filter(~is_and).select(*_ANOMALY))
    same = is_and if mode == "exact" else is_and & alike
    if plan.has_and and (mode == "exact" or set(plan.kinds) & {*POINT_KINDS, "count"}):
        held = every.filter(same).withColumn("member", member)
        parts.append(all_present(held, [*group, "start_time"], "end_time", "member", "n_members").select(*out))
    if plan.has_and and mode == "overlap":
        mixed = is_and & ~alike
        spans = []
        if set(plan.kinds) - {"count"}:
            spans.append(member_intervals(readings, plan).filter(mixed))
        if plan.mixed_counts:
            spans.append(touching_cells(count_cells(readings, plan).filter(mixed)))
        if spans:
            held = _union(spans).withColumn("member", member)
            held = held.select(*group, "member", "n_members", "start_time", "end_time").distinct()
            parts.append(intersect_members(held, group, "member", "n_members").select(*out))
    return _union(parts) if parts else every.select(*_ANOMALY)


def messages(anomalies: DataFrame, rules: DataFrame, page: int = 1000, cell: int = 60) -> DataFrame:
    """JSON messages of the rules with anomalies (RU14):
    ``{"anomalies": [{start_time, end_time, asset_id}...], "time_range": {"start", "end"},
    "rule": {...}}``, one row ``rule_id, page, message`` per rule and ``page`` anomalies.

    ``rules`` holds one row per rule: ``rule_id``, ``start_time``, ``end_time``,
    optionally ``max_limit`` (the largest gap limit of its members; the reported
    range starts that much earlier, as the hits were read from there), and any
    rule fields, which form the ``rule`` object. A rule's anomalies are ordered
    by (start, end, asset) and numbered in cells of ``cell`` seconds: only the cells' counts are summed over a
    rule, so a wildcard rule's day over all assets is many tasks.
    """
    a = anomalies.select(*_ANOMALY).withColumn("_cell", F.floor(F.col("start_time") / cell))
    cells = a.groupBy("rule_id", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("rule_id").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("rule_id", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("rule_id", "_cell").orderBy("start_time", "end_time", F.col("asset_id").asc_nulls_first())
    a = a.withColumn("_r", F.row_number().over(inside)).join(cells, ["rule_id", "_cell"], "inner")
    a = a.withColumn("page", F.floor((F.col("_before") + F.col("_r") - 1) / page).cast("int"))
    per = (a.groupBy("rule_id", "page")
            .agg(F.sort_array(F.collect_list(F.struct("start_time", "end_time", "asset_id"))).alias("anomalies")))
    window_cols = {"start_time", "end_time", "max_limit"}
    fields = [c for c in rules.columns if c not in window_cols]
    lead = F.coalesce(F.col("max_limit"), F.lit(0)) if "max_limit" in rules.columns else F.lit(0)
    r = rules.select("rule_id", F.struct(*fields).alias("rule"),
                     F.struct((F.col("start_time") - lead).alias("start"), F.col("end_time").alias("end")).alias("time_range"))
    j = per.join(r, "rule_id")
    return j.select("rule_id", "page", F.to_json(F.struct("anomalies", "time_range", "rule")).alias("message"))
