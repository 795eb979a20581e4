"""Script rules (RU15, RU16): user rule functions registered by name.

A script rule is a Python function ``fn(data: DataFrame, params: dict) ->
DataFrame``. ``data`` holds the readings of all rules that share the script and
its parameters, once per rule, for ``[start - history, end]``, with ``rule_id``,
``start_time`` and ``end_time`` of the rule; it returns ``rule_id, asset_id,
start_time, end_time``. Rules reference functions by name; nothing is executed
from text. Rules are a table joined to the readings, so the plan has a branch
per distinct (script, parameters), not per rule.

A *frame rule* is a function of one asset's data: ``fn(data, time_range, rule)`` gets a pandas frame
(parameter, epoch, value), the range in which anomalies are sought, and the rule as its document says, and
returns anomalies (start_time, end_time, optionally graphs). All frame rules of a run are one grouped job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import local_frame

SCRIPTS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}


def script_rule(name: str):
    def deco(fn):
        SCRIPTS[name] = fn
        return fn
    return deco


def run_script_rules(rules: list[dict], readings: DataFrame, ts: str = "epoch") -> DataFrame | None:
    """RU15/RU16: ``rules`` are script rule rows (rule_id, script, asset_ids (None =
    every asset), start_time, end_time, history, params), a configuration list. Returns
    ``rule_id, asset_id, start_time, end_time`` for all of them as one plan."""
    kind = readings.schema["asset_id"].dataType.simpleString()
    groups: dict[tuple, list[dict]] = {}
    for r in rules:
        groups.setdefault((r["script"], repr(sorted(dict(r.get("params", {})).items()))), []).append(r)
    out = None
    for (script, _), same in groups.items():
        rows = [(int(r["rule_id"]), a, int(r["start_time"]), int(r["end_time"]), int(r.get("history", 0)))
                for r in same for a in (r["asset_ids"] if r.get("asset_ids") is not None else [None])]
        table = local_frame(readings.sparkSession, rows, f"rule_id int, _asset {kind}, start_time long, end_time long, history long")
        lo, hi = min(x[2] - x[4] for x in rows), max(x[3] for x in rows)
        every = [x for x in rows if x[1] is None]
        data = readings.filter(F.col(ts).between(lo, hi))
        parts = []
        if len(every) < len(rows):
            parts.append(data.join(table.filter("_asset is not null"), F.col("asset_id") == F.col("_asset"), "inner"))
        if every:  # rules over every asset: a constant list on each reading
            spec = F.array(*[F.struct(F.lit(i).alias("rule_id"), F.lit(s).cast("long").alias("start_time"),
                                      F.lit(e).cast("long").alias("end_time"), F.lit(h).cast("long").alias("history"))
                             for i, _, s, e, h in every])
            parts.append(data.select("*", F.inline(spec)).withColumn("_asset", F.lit(None).cast(kind)))
        data = parts[0]
        for p in parts[1:]:
            data = data.unionByName(p)
        data = data.filter(F.col(ts).between(F.col("start_time") - F.col("history"), F.col("end_time"))).drop("_asset")
        res = SCRIPTS[script](data, dict(same[0].get("params", {}))).select("rule_id", "asset_id", "start_time", "end_time")
        out = res if out is None else out.unionByName(res)
    return out


def chart(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Graph output of a script rule: per key the time-sorted ``x[]`` and ``y[]`` arrays."""
    s = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(ts, value))).alias("_p"))
    return s.select(*keys, F.transform("_p", lambda p: p[ts]).alias("x"), F.transform("_p", lambda p: p[value]).alias("y"))


@script_rule("zscore_spike")
def zscore_spike(data: DataFrame, params: dict) -> DataFrame:
    """Example registered rule: trailing z-score spikes (WN4) as single-point anomalies."""
    from ..operators.windows import trailing_zscore
    keys = ["rule_id", "asset_id", *params.get("keys", [])]
    z = trailing_zscore(data, keys, "epoch", params.get("value", "value"), int(params.get("d", 3600)),
                        params.get("operator", ">"), float(params.get("threshold", 3.0)))
    z = z.filter(F.col("flag") & F.col("epoch").between(F.col("start_time"), F.col("end_time")))
    return z.select("rule_id", "asset_id", F.col("epoch").alias("start_time"), F.col("epoch").alias("end_time"))


def route_rule_types(rules: DataFrame, type_col: str = "rule_type") -> tuple[DataFrame, DataFrame]:
    """RU16: split a rule table into standard rules and script rules
    (``rule_type = 'script'``); missing type means standard."""
    is_script = F.lower(F.coalesce(F.col(type_col), F.lit("standard"))) == "script"
    return rules.filter(~is_script), rules.filter(is_script)


# ---------------------------------------------------------------- frame rules

FrameRule = Callable[[pd.DataFrame, dict, dict], Iterable[dict]]
FRAME_SCRIPTS: dict[str, FrameRule] = {}
#: Condition fields that a frame rule sees.
RULE_FIELDS = ("condition_id", "parameter", "operator", "threshold", "threshold_unit", "duration", "function")


def frame_rule(name: str):
    def deco(fn: FrameRule) -> FrameRule:
        FRAME_SCRIPTS[name] = fn
        return fn
    return deco


def unknown_scripts(conditions: DataFrame, registry: Mapping[str, FrameRule] = FRAME_SCRIPTS) -> DataFrame:
    """Error rows (rule_id, error, detail) of script rules whose ``path`` names no registered function."""
    known = F.coalesce(F.col("path").isin(*registry), F.lit(False)) if registry else F.lit(False)
    return conditions.filter(~known).select("rule_id", F.lit("unknown script").alias("error"), F.coalesce("path", F.lit("-")).alias("detail")).distinct()


def run_frame_rules(conditions: DataFrame, readings: DataFrame, cell: int = 6 * 3600,
                    registry: Mapping[str, FrameRule] | None = None) -> DataFrame:
    """RU15/RU16: ``rule_id, asset_id, start_time, end_time, graphs`` of all frame rules.

    ``conditions`` has one row per rule x condition x asset: rule_id, condition_id, asset_id, parameter, ``path``
    (the function's name), ``duration`` (seconds of history the function needs), start_time, end_time and
    the other ``RULE_FIELDS``; a rule's function gets the data of all its parameters. The run window is
    cut into cells of at least ``cell`` seconds and four histories; a group is (rule, asset, cell) and
    holds the cell's readings and, before them, the history's copies, so neither a hot asset nor a long window is
    one task. A cell without readings calls the function too (it may look for silence). What a function
    returns is kept as it is: an anomaly that goes on beyond a cell is one per cell.
    """
    registry = dict(FRAME_SCRIPTS if registry is None else registry)
    have = [f for f in RULE_FIELDS if f in conditions.columns]
    rules = conditions.groupBy("rule_id", "asset_id").agg(
        F.first("path").alias("_script"), F.max(F.coalesce("duration", F.lit(0))).cast("long").alias("_history"),
        F.min("start_time").cast("long").alias("_from"), F.max("end_time").cast("long").alias("_to"),
        F.to_json(F.sort_array(F.collect_list(F.struct(*have)))).alias("_rule"))
    rules = rules.filter(F.col("_script").isin(*registry)).withColumn("_len", F.greatest(F.lit(cell).cast("long"), 4 * F.col("_history")))

    def cell_of(t):
        return F.floor(t / F.col("_len")).cast("long")

    first, last = cell_of(F.col("_from")), cell_of(F.col("_to"))
    spec = rules.select("rule_id", "asset_id", F.explode(F.sequence(first, last)).alias("_cell"), "_script", "_rule",
                        "_from", "_to", "_len")
    members = conditions.select("rule_id", "asset_id", "parameter").distinct().join(
        rules.select("rule_id", "asset_id", "_history", "_from", "_to", "_len"), ["rule_id", "asset_id"])
    data = readings.select("asset_id", "parameter", "epoch", F.col("value").cast("double").alias("value")).join(
        members, ["asset_id", "parameter"]).filter(F.col("epoch").between(F.col("_from") - F.col("_history"), F.col("_to")))
    cells = F.sequence(F.greatest(cell_of(F.col("epoch")), first), F.least(cell_of(F.col("epoch") + F.col("_history")), last))
    data = data.select("rule_id", "asset_id", F.explode(cells).alias("_cell"), "parameter", F.col("epoch").cast("long").alias("epoch"), "value")
    both = data.unionByName(spec, allowMissingColumns=True)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        known = group["_script"].notna()
        spec = group[known].iloc[0]
        length, at = int(spec["_len"]), int(spec["_cell"])
        frame = group.loc[~known, ["parameter", "epoch", "value"]].sort_values(["epoch", "parameter", "value"], ignore_index=True)
        frame["epoch"] = frame["epoch"].astype("int64")
        own = json.loads(spec["_rule"])
        window = {"start_time": max(int(spec["_from"]), at * length), "end_time": min(int(spec["_to"]), (at + 1) * length - 1)}
        rule = {"rule_id": int(spec["rule_id"]), "asset_id": spec["asset_id"], "conditions": own, **{
            k: v for k, v in own[0].items() if k != "condition_id"}}
        found = [(spec["rule_id"], spec["asset_id"], int(x["start_time"]), int(x["end_time"]),
                  json.dumps(x["graphs"]) if x.get("graphs") is not None else None) for x in registry[spec["_script"]](frame, window, rule)]
        return pd.DataFrame(found, columns=["rule_id", "asset_id", "start_time", "end_time", "graphs"])

    kinds = {c: conditions.schema[c].dataType.simpleString() for c in ("rule_id", "asset_id")}
    return both.groupBy("rule_id", "asset_id", "_cell").applyInPandas(
        run, f"rule_id {kinds['rule_id']}, asset_id {kinds['asset_id']}, start_time long, end_time long, graphs string")


def line_chart(frame: pd.DataFrame, label: str) -> dict:
    """A graph of an anomaly: times and values."""
    return {"type": "line-chart", "xaxis": {"label": "timestamp", "data": frame["epoch"].tolist()},
            "yaxis": {"label": label, "data": frame["value"].tolist()}}


@frame_rule("above_history")
def above_history(data: pd.DataFrame, time_range: dict, rule: dict) -> Iterable[dict]:
    """Readings above ``threshold`` times the mean of the ``duration`` seconds before them."""
    t, v = data["epoch"].to_numpy(), data["value"].to_numpy()
    begin, end = np.searchsorted(t, t - rule["duration"]), np.searchsorted(t, t)
    upto = np.append(0.0, np.cumsum(v))
    known = end > begin
    mean = np.divide(upto[end] - upto[begin], end - begin, out=np.full(len(t), np.inf), where=known)
    hit = known & (v > rule["threshold"] * mean) & (t >= time_range["start_time"]) & (t <= time_range["end_time"])
    for at in np.unique(t[hit]).tolist():
        yield {"start_time": at, "end_time": at, "graphs": [line_chart(data[data["epoch"] == at], rule["parameter"])]}


@frame_rule("spread")
def spread(data: pd.DataFrame, time_range: dict, rule: dict) -> Iterable[dict]:
    """Times at which the first parameter's largest value exceeds the second one's latest largest value, no older
    than ``duration``, by ``threshold``."""
    one, two = (data[data["parameter"] == c["parameter"]].groupby("epoch")["value"].max() for c in rule["conditions"][:2])
    one = one[(one.index >= time_range["start_time"]) & (one.index <= time_range["end_time"])]
    at = np.searchsorted(two.index.to_numpy(), one.index.to_numpy(), side="right") - 1
    for i, t in enumerate(one.index.tolist()):
        if at[i] >= 0 and t - two.index[at[i]] <= rule["duration"] and one.iloc[i] - two.iloc[at[i]] > rule["threshold"]:
            yield {"start_time": t, "end_time": t}
