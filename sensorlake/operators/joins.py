"""Join operators (JN1-JN4, JN7, JN10-JN12).

Physical strategy is Catalyst's: nothing is hinted, AQE decides at run time
from real sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def enrich(facts: DataFrame, dim: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """JN1: inner join of facts (batch or stream) with a static dimension."""
    return facts.join(dim, on, "inner")


def exclude(facts: DataFrame, dim: DataFrame, on, distinct: bool = False) -> DataFrame:
    """JN2/JN3/JN10: rows of ``facts`` with no match in ``dim`` (left anti)."""
    out = facts.join(dim, on, "left_anti")
    return out.distinct() if distinct else out


def present_in(facts: DataFrame, dim: DataFrame, on) -> DataFrame:
    """JN11: rows of ``facts`` with a match in ``dim`` (left semi)."""
    return facts.join(dim, on, "left_semi")


def asset_frequency(rules: DataFrame, assets: DataFrame, asset_list: str = "asset_id",
                    freq: str = "data_frequency") -> DataFrame:
    """JN4: per rule row, the data frequency of each listed asset, in list order.

    The asset list is exploded with its position, left-joined to the asset
    table and regrouped: ``frequencies`` (``2f - 1`` per asset, list order),
    ``max_frequency`` and ``missing_assets`` (assets without a frequency; RU3).
    """
    key = [c for c in rules.columns if c != asset_list]
    ex = rules.select(*key, F.posexplode(asset_list).alias("_pos", "_asset"))
    a = assets.select(F.col("asset_id").alias("_asset"), F.col(freq).alias("_f"))
    j = ex.join(a, "_asset", "left")
    agg = j.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_asset", "_f"))).alias("_l"),
        F.max("_f").alias("max_frequency"))
    return agg.select(
        *key,
        F.transform("_l", lambda x: x["_asset"]).alias(asset_list),
        F.transform("_l", lambda x: 2 * x["_f"] - 1).alias("frequencies"),
        "max_frequency",
        F.transform(F.filter("_l", lambda x: x["_f"].isNull()), lambda x: x["_asset"]).alias("missing_assets"))


def baseline_join(current: DataFrame, readings: DataFrame, keys: Sequence[str], ts: str, value: str,
                  baseline_time) -> DataFrame:
    """JN7: each current reading with the reading of the same key at one baseline
    time (latest value if several); an equi join, no range predicate."""
    base = (readings.filter(F.col(ts) == F.lit(baseline_time))
                    .groupBy(*keys).agg(F.max(F.struct(ts, value))[value].alias("baseline_value")))
    return current.join(base, list(keys), "inner")


def with_parsed(rules: DataFrame, header: DataFrame, on: str, json_col: str, schema: DataType | str,
                out: str = "parsed") -> DataFrame:
    """JN12: rules x header equi join with a JSON column parsed by schema."""
    return rules.join(header, on, "inner").withColumn(out, F.from_json(F.col(json_col), schema))
