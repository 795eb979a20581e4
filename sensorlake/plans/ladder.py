"""Thresholds of many rules against one series: a reading meets only the rules it passes.

All rules on one series with one operator form a *ladder*: their thresholds sorted in an array. What a value
passes is a run of rungs that begins or ends at the ladder's own ends, so a count by binary search (thresholds
below the value, or below and equal) gives the rungs; only these are written out and joined to their
rules. The rows that leave are the hits, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import OPERATORS

#: Thresholds in one array; longer ladders are several.
RUNGS = 1024


def build(rules: DataFrame, key: str, rungs: int = RUNGS) -> tuple[DataFrame, DataFrame]:
    """(ladders, rules with their place): ``_ladder`` names a run of up to ``rungs`` thresholds of one
    ``key`` and operator, ``_rung`` a rule's place in it. Rules without threshold or known operator pass nothing."""
    known = ", ".join(f"'{op}'" for op in OPERATORS)
    at = f"row_number() OVER (PARTITION BY {key}, operator ORDER BY threshold, rule_id, condition_id) - 1"
    placed = rules.where(f"threshold IS NOT NULL AND operator IN ({known})").selectExpr("*", f"{at} AS _at").selectExpr(
        "*", f"concat_ws('|', {key}, operator, _at div {rungs}) AS _ladder", f"_at % {rungs} AS _rung")
    found = placed.groupBy(key, "operator", "_ladder").agg(F.expr("sort_array(collect_list(threshold)) AS _thresholds"))
    # powers of two, the largest no greater than the ladder's length: the steps of a binary search
    steps = "transform(sequence(length(bin(size(_thresholds))) - 1, 0, -1), k -> shiftleft(1, k)) AS _steps"
    return found.selectExpr(key, "operator AS _op", "_ladder", "_thresholds", "size(_thresholds) AS _n", steps), placed


def passing(series: DataFrame, rules: DataFrame, key: str, value: str, columns: Sequence[str], rungs: int = RUNGS) -> DataFrame:
    """Rows of ``series`` x the rules of their ``key`` that they pass, with the rules' ``columns``.

    ``rules`` has ``key``, operator, threshold, rule_id, condition_id. Null values pass nothing.
    """
    ladders, placed = build(rules, key, rungs)

    def count(op: str) -> str:
        return f"aggregate(_steps, 0, (n, w) -> if(get(_thresholds, n + w - 1) {op} {value}, n + w, n))"

    def rung(first: str, end: str) -> str:  # places first to end - 1, null for none
        return f"if({end} > {first}, sequence({first}, {end} - 1), null)"

    below, upto, none = count("<"), count("<="), "cast(array() AS array<int>)"
    hit = (f"CASE _op WHEN '>' THEN {rung('0', below)} WHEN '>=' THEN {rung('0', upto)} WHEN '<' THEN {rung(upto, '_n')} "
           f"WHEN '<=' THEN {rung(below, '_n')} WHEN '==' THEN {rung(below, upto)} "
           f"ELSE concat(coalesce({rung('0', below)}, {none}), coalesce({rung(upto, '_n')}, {none})) END")
    # readings that pass no rung of a ladder go before its rungs are searched
    some = (f"CASE _op WHEN '>' THEN {value} > get(_thresholds, 0) WHEN '>=' THEN {value} >= get(_thresholds, 0) "
            f"WHEN '<' THEN {value} < get(_thresholds, _n - 1) WHEN '<=' THEN {value} <= get(_thresholds, _n - 1) "
            f"ELSE {value} IS NOT NULL END")
    own = [c for c in series.columns if c != key]
    j = series.join(ladders, key, "inner").where(some).selectExpr(*own, "_ladder", f"explode({hit}) AS _rung")
    return j.join(placed.select("_ladder", "_rung", *columns), ["_ladder", "_rung"], "inner").select(*own, *columns)
