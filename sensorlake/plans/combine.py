"""Combined rules (ST4, RU11) without enumerating combinations.

The reference builds every combination of per-condition queries (a product
over the conditions, one asset choice each) and intersects their intervals
exactly. The same result follows from one aggregate: an interval of a rule is
produced when every condition has at least one member with exactly that
interval; the number of combinations that produce it is the product of those
member counts (kept as ``combinations``), so no product is materialised.
Overlap semantics (JN6) use ``intervals.intersect_members`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_exact(member_intervals: DataFrame, n_conditions: DataFrame, group=("rule_id",)) -> DataFrame:
    """ST4/ST3/RU11 ``mode="exact"``: ``member_intervals`` holds (rule_id,
    condition_id, asset_id, start_time, end_time); ``n_conditions`` holds
    (rule_id, n_conditions); ``group`` is the rule scope (add ``asset_id`` for
    per-asset rules). Returns (group..., start_time, end_time, combinations)."""
    g = list(group)
    per = (member_intervals.groupBy(*g, "start_time", "end_time", "condition_id")
                           .agg(F.count(F.lit(1)).alias("_members")))
    agg = per.groupBy(*g, "start_time", "end_time").agg(
        F.count(F.lit(1)).alias("_conds"),
        F.aggregate(F.collect_list("_members"), F.lit(1).cast("long"), lambda acc, x: acc * x).alias("combinations"))
    return (agg.join(n_conditions, "rule_id")
               .filter(F.col("_conds") == F.col("n_conditions"))
               .select(*g, "start_time", "end_time", "combinations"))


def combination_count(conditions: DataFrame) -> DataFrame:
    """ST4: number of combinations a rule has: AND (one query per condition) = 1
    when each condition has one member; OR (one query per asset) = product of
    member counts per condition (2 conditions x 2 assets -> 4)."""
    per = conditions.groupBy("rule_id", "condition_id").agg(F.count(F.lit(1)).alias("_m"))
    return per.groupBy("rule_id").agg(
        F.aggregate(F.collect_list("_m"), F.lit(1).cast("long"), lambda acc, x: acc * x).alias("combinations"),
        F.count(F.lit(1)).alias("n_conditions"))
