"""Rule life cycle and run scheduling (RU1-RU3, RU12, RU13, CH1, CH2).

Rule documents are small configuration tables, but every step is still a
DataFrame transformation (no driver loops over rules): changes are applied
with latest-per-key + anti joins, run windows are columns of the rule table,
and the run-time watermark is an upserted state table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import asset_frequency
from ..operators.windows import latest_per_key
from ..sources.sinks import upsert


def flatten_rules(docs: DataFrame) -> DataFrame:
    """PJ8/RU2: rule documents -> one row per rule x condition x asset, with the
    rule's join condition (empty is treated as "or", S6) and the asset list kept
    as ``asset_ids`` (AND rules use the whole list) and, where documents have one, their ``rule_type``."""
    c = docs.select("rule_id", "rule_name", "tenant_id", "severity", *[c for c in ("rule_type",) if c in docs.columns],
                    F.lower(F.coalesce(F.nullif(F.trim("join_condition"), F.lit("")), F.lit("or"))).alias("join_condition"),
                    F.inline("conditions"))
    return c.withColumn("asset_ids", F.col("asset_id")).withColumn("asset_id", F.explode("asset_id"))


def apply_rule_changes(existing: DataFrame, incoming: DataFrame, order: str = "file_name") -> DataFrame:
    """RU1: rule CDC. Per rule id only the newest incoming document counts
    (``order``); ``delete`` removes the rule, ``update`` replaces it (delete +
    insert), ``create`` of an id that already exists is ignored."""
    cols = existing.columns
    latest = latest_per_key(incoming, ["rule_id"], [order])
    op = F.lower(F.col("operation"))
    gone = latest.filter(op.isin("delete", "update")).select("rule_id")
    kept = existing.join(gone, "rule_id", "left_anti")
    updates = latest.filter(op == "update").select(*cols)
    creates = latest.filter(op == "create").join(existing.select("rule_id"), "rule_id", "left_anti").select(*cols)
    return kept.unionByName(updates).unionByName(creates)


def rules_with_frequency(rules: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN4/RU3: attach data frequencies (``2f - 1`` per listed asset, list order);
    returns (valid rules, error rows for rules naming an asset without a frequency)."""
    f = asset_frequency(rules, assets)
    bad = F.size("missing_assets") > 0
    errors = f.filter(bad).select("rule_id", F.lit("asset without data frequency").alias("error"),
                                  F.concat_ws(",", "missing_assets").alias("detail"))
    return f.filter(~bad), errors


def rule_headers(conditions: DataFrame, rules: DataFrame) -> DataFrame:
    """RU12: per rule the payload header: severity, controls and the conditions
    as JSON (collected per rule, bounded by its condition count)."""
    cond = conditions.groupBy("rule_id").agg(
        F.sort_array(F.collect_list(F.struct("condition_id", "parameter", "operator", "threshold", "duration",
                                             "function"))).alias("_c"),
        F.sort_array(F.collect_set("condition_id")).alias("condition_ids"))
    return rules.select("rule_id", "severity", "risk_register_controls").join(cond, "rule_id").select(
        "rule_id", "severity", "risk_register_controls", "condition_ids", F.to_json("_c").alias("conditions_json"))


def execution_window(rules: DataFrame, engine_period: int, downtime: int, now: int,
                     last_run: str = "last_run_time", max_data: str = "max_bronze_time",
                     run_frequency: str = "rule_run_frequency", delay: str = "delay") -> DataFrame:
    """RU13 / S10: run bounds per rule as columns; rules not due get null bounds.

    ``last = max(last_run, max_data - downtime)``; catch-up
    ``g = max(0, (max_data - last) / ef)``; ``t = last - delay``; ``m = t mod rf``.
    If ``rf <= ef``: ``end = t - m + ef*g``, ``start = t - ef - ((t - ef) mod rf)``;
    else if ``m < ef``: ``end = t - m + ef*g``, ``start = t - m - rf``; else not due.
    A missing or zero data time means ``now``. ``next_run_time = last + ef*g + ef``.
    """
    ef = F.lit(int(engine_period)).cast("double")
    mx = F.when(F.coalesce(F.col(max_data), F.lit(0)) == 0, F.lit(now)).otherwise(F.col(max_data)).cast("double")
    last = F.greatest(F.coalesce(F.col(last_run).cast("double"), mx - downtime), mx - downtime)
    r = rules.withColumn("_mx", mx).withColumn("_last", last)
    g = F.greatest(F.lit(0.0), (F.col("_mx") - F.col("_last")) / ef)
    t = F.col("_last") - F.coalesce(F.col(delay), F.lit(0)).cast("double")
    rf = F.coalesce(F.col(run_frequency), F.lit(1)).cast("double")
    m = F.pmod(t, rf)
    end_due = t - m + ef * g
    start_a = t - ef - F.pmod(t - ef, rf)
    start_b = t - m - rf
    start = F.when(rf <= ef, start_a).when(m < ef, start_b)
    end = F.when((rf <= ef) | (m < ef), end_due)
    return (r.withColumn("_g", g)
             .withColumn("start_time", start.cast("long")).withColumn("end_time", end.cast("long"))
             .withColumn("next_run_time", (F.col("_last") + ef * F.col("_g") + ef).cast("long"))
             .drop("_mx", "_last", "_g"))


def advance_watermark(state: DataFrame, runs: DataFrame, now_ts: Column | None = None) -> DataFrame:
    """CH1: run-time watermark per (workflow, sensor type) after a run: upsert of
    ``last_run_time`` from ``runs`` (workflow_id, sensor_type, next_run_time)."""
    fresh = runs.select("workflow_id", "sensor_type", F.col("next_run_time").alias("last_run_time"),
                        (now_ts if now_ts is not None else F.current_timestamp()).alias("last_updated_date"))
    return upsert(state, fresh, ["workflow_id", "sensor_type"])


def first_run_state(data: DataFrame, workflow_id: str, sensor: str, ts: str) -> DataFrame:
    """CH1 first run: no state yet -> start from the newest data time per sensor."""
    return data.groupBy(F.col(sensor).alias("sensor_type")).agg(F.max(ts).alias("last_run_time")).select(
        F.lit(workflow_id).alias("workflow_id"), "sensor_type", "last_run_time",
        F.current_timestamp().alias("last_updated_date"))


def has_data(df: DataFrame) -> bool:
    """CH2: data-presence gate: reads at most one row (``limit(1)``), not a count."""
    return len(df.limit(1).take(1)) > 0
