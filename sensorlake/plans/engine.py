"""One rule-engine run (section 3.2 of the blueprint) as one Spark plan per step:

rule documents -> flattened conditions (RU2) -> kinds, data frequencies and
error rows (RU10, JN4, RU3) -> run window per rule and sensor from the stored
watermark and the newest data (RU13, CH1, AG14) -> due rules only -> anomalies
of all rules together (RU10, RU11) and of script rules (RU15, RU16) -> messages
(RU14) -> advanced watermark (CH1).

Nothing loops over rules on the driver. The due rules (rules x conditions x assets) are written once as a
table of their own. Driver reads are configuration facts:
the condition table or its summary (``rules.prepare``) and one row per sensor
type with its newest data time, which is read once and only from the stored
watermark on.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, local_frame
from . import lifecycle, scripts
from . import rules as ru


SCRIPT = "script"


@dataclass
class RunResult:
    messages: DataFrame
    anomalies: DataFrame
    errors: DataFrame
    state: DataFrame
    windows: DataFrame
    graphs: DataFrame | None = None


def newest_data(readings: DataFrame, sensors: DataFrame, state: DataFrame) -> DataFrame:
    """(sensor_type, last_run_time, max_bronze_time), one row per sensor type in use.

    A sensor's newest data matters only beyond its stored watermark, so where
    every sensor has one the readings are read from the oldest of these on; a
    sensor without newer data keeps its watermark as its newest time.
    """
    spark = readings.sparkSession
    known = sensors.join(state, "sensor_type", "left").groupBy("sensor_type").agg(F.max("last_run_time").alias("t")).collect()
    last = {r["sensor_type"]: r["t"] for r in known}
    r = readings
    if last and all(t is not None for t in last.values()):
        r = r.filter(F.col("epoch") >= min(last.values()))
    top = {x["sensor_type"]: x["t"] for x in r.groupBy("sensor_type").agg(F.max("epoch").alias("t")).collect()}
    rows = [(s, t, top.get(s) if top.get(s) is not None else t) for s, t in last.items()]
    return local_frame(spark, rows, "sensor_type string, last_run_time long, max_bronze_time long")


def run_rules(docs: DataFrame, assets: DataFrame, readings: DataFrame, state: DataFrame, workflow_id: str,
              engine_period: int, downtime: int, now: int, delay: int = 0,
              families: Mapping[str, str] = ru.PARAMETER_FAMILIES, mode: str = "overlap",
              script_rules: list[dict] | None = None) -> RunResult:
    """``docs``: rule documents (``sources.files.RULE_DOC``); ``assets``: (asset_id,
    data_frequency); ``readings``: (asset_id, parameter, epoch, value, k, sensor_type
    and, where rules need them, arrival, wire, depth); ``state``: run-time watermark
    table (workflow_id, sensor_type, last_run_time, last_updated_date).

    ``delay`` shifts the run windows back by so many seconds (late data);
    ``families`` maps document parameters to sensor families; ``mode`` is how AND
    rules combine (``rules.evaluate``); ``script_rules`` are run beside the
    documents' rules (``scripts.run_script_rules``). Documents of type ``script`` go to the frame rule
    that their conditions' ``path`` names (RU16, ``scripts.run_frame_rules``); their anomalies' graphs are in
    ``graphs``. Rules naming an unknown function, parameter, operator, script or asset give error rows
    and nothing else.
    """
    flat = lifecycle.flatten_rules(docs)
    routed = "rule_type" in flat.columns and "path" in flat.columns
    standard, script = scripts.route_rule_types(flat) if routed else (flat, None)
    known, name_errors = ru.dispatch(standard, families)
    if routed:
        known = known.unionByName(script.withColumn("function", F.lit(SCRIPT)))
        name_errors = name_errors.unionByName(scripts.unknown_scripts(script))
    per_rule = known.select("rule_id", "condition_id", F.col("asset_ids").alias("asset_id")).dropDuplicates(
        ["rule_id", "condition_id"])
    ok, frequency_errors = lifecycle.rules_with_frequency(per_rule, assets)
    errors = frequency_errors.unionByName(name_errors)
    wrong = errors.select("rule_id").distinct()
    valid = (known.join(ok.select("rule_id", "condition_id"), ["rule_id", "condition_id"], "left_semi")
                  .join(wrong, "rule_id", "left_anti"))
    cond = valid.join(assets.select("asset_id", "data_frequency"), "asset_id", "inner")

    # run window per rule and sensor: the sensor's newest data time and stored watermark
    st = state.filter(F.col("workflow_id") == workflow_id).select("sensor_type", "last_run_time")
    facts = newest_data(readings, cond.select("sensor_type").distinct(), st)
    per = (cond.groupBy("rule_id", "sensor_type").agg(F.min("rule_run_frequency").alias("rule_run_frequency"))
               .join(facts, "sensor_type", "left").withColumn("delay", F.lit(int(delay))))
    windows = lifecycle.execution_window(per, engine_period, downtime, now)
    due = windows.filter(F.col("start_time").isNotNull() & F.col("end_time").isNotNull())

    # the due rules as a table of their own: every kind's plan reads it several times
    run = cut_lineage(cond.join(due.select("rule_id", "sensor_type", "start_time", "end_time"), ["rule_id", "sensor_type"], "inner"))
    conditions = (run.filter(F.col("function") != SCRIPT)
                     .select("rule_id", "condition_id", "asset_id", "parameter", "function", "operator",
                             "threshold", F.col("duration").cast("long").alias("duration"),
                             F.col("data_frequency").cast("long").alias("data_frequency"), "join_condition",
                             "threshold_unit", F.col("baseline_time").cast("long").alias("baseline_time"),
                             "class", "start_time", "end_time", "sensor_type", "wire",
                             F.col("wire_length_from").cast("long").alias("depth_from"),
                             F.col("wire_length_to").cast("long").alias("depth_to")))
    anomalies = ru.evaluate(readings, conditions, mode)
    graphs = None
    if routed:
        graphs = scripts.run_frame_rules(run.filter(F.col("function") == SCRIPT), readings)
        anomalies = anomalies.unionByName(graphs.select(*anomalies.columns))
    if script_rules:
        anomalies = anomalies.unionByName(scripts.run_script_rules(script_rules, readings).select(*anomalies.columns))
    # message header: the rule as documented (name, tenant, severity, join condition,
    # controls, conditions) plus its run window, reported from start - largest gap limit
    header = (run.groupBy("rule_id")
                 .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
                      F.max(ru.gap_limit(F.col("data_frequency"))).alias("max_limit"))
                 .join(docs.select("rule_id", "rule_name", "tenant_id", "severity", "join_condition",
                                   "risk_register_controls", "conditions"), "rule_id"))
    messages = ru.messages(anomalies, header)
    runs = (windows.groupBy("sensor_type").agg(F.max("next_run_time").alias("next_run_time"))
                   .select(F.lit(workflow_id).alias("workflow_id"), "sensor_type", "next_run_time"))
    new_state = lifecycle.advance_watermark(state, runs)
    return RunResult(messages, anomalies, errors, new_state, windows, graphs)
