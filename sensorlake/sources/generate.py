"""Synthetic gauge data (SK11): one row per second per asset, uniform pressure
and temperature inside bounds, optional injected anomaly windows. Generated
on the executors (assets x blocks of seconds), deterministic by seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import even_tasks, local_frame

#: Seconds that one asset's row of the plan stands for before they are written out.
BLOCK = 3600
WINDOW_SCHEMA = "asset_id string, n long, start_time long, end_time long, column string, value double"


def _uniform(seed: int, *keys: str) -> Column:
    """A number in [0, 1) by seed and keys alone: the same in every partitioning and rerun."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def generate_gauge(spark: SparkSession, start: int, end: int, assets: DataFrame | Sequence[str],
                   bounds: dict[str, tuple[float, float]], seed: int = 42,
                   anomalies: DataFrame | Sequence[tuple[str, int, int, str, float]] = ()) -> DataFrame:
    """Rows ``epoch_timestamp, asset_id, pressure, temperature, ...`` for every
    second in ``[start, end)`` and asset. ``anomalies`` holds
    ``(asset_id, from, to, column, value)`` windows that override the value, later ones the earlier.

    Many assets come as a frame with ``asset_id``, their windows as one with ``WINDOW_SCHEMA``'s columns, where the
    greatest ``n`` counts. Windows are joined to their own asset, so the plan has the same size for any number of them.
    """
    if not isinstance(assets, DataFrame):
        assets = local_frame(spark, [(a,) for a in assets], "asset_id string")
    if not isinstance(anomalies, DataFrame):
        unknown = {c for _, _, _, c, _ in anomalies} - set(bounds)
        if unknown:
            raise ValueError(f"anomalies of unknown columns {sorted(unknown)}; expected some of {list(bounds)}")
        anomalies = local_frame(spark, [(a, n, frm, to, c, v) for n, (a, frm, to, c, v) in enumerate(anomalies)], WINDOW_SCHEMA)
    window = F.struct("n", "start_time", "end_time", "value")
    windows = anomalies.groupBy("asset_id").agg(*[
        F.collect_list(F.when(F.col("column") == name, window)).alias(f"_windows_{i}") for i, name in enumerate(bounds)])
    firsts = F.array(*[F.lit(t).cast("long") for t in range(start, end, BLOCK)]) if end - start <= BLOCK else F.sequence(
        F.lit(start).cast("long"), F.lit(end - 1).cast("long"), F.lit(BLOCK).cast("long"))
    df = assets.select("asset_id").join(windows, "asset_id", "left").withColumn("_from", F.explode(firsts.cast("array<bigint>")))
    for i in range(len(bounds)):  # a block keeps the windows that reach into it
        df = df.withColumn(f"_windows_{i}", F.filter(f"_windows_{i}", lambda w: (
            w["start_time"] < F.col("_from") + BLOCK) & (w["end_time"] >= F.col("_from"))))
    # a fixed number of tasks: the blocks are few bytes, and Spark would put them into one
    df = df.repartition(even_tasks(spark), "asset_id", "_from")
    last = F.least(F.col("_from") + BLOCK, F.lit(end)) - 1
    df = df.select(F.explode(F.sequence("_from", last)).alias("epoch_timestamp"), "asset_id",
                   *[f"_windows_{i}" for i in range(len(bounds))])
    for i, (name, (lo, hi)) in enumerate(bounds.items()):
        inside = F.array_max(F.filter(f"_windows_{i}", lambda w: F.col("epoch_timestamp").between(w["start_time"], w["end_time"])))
        df = df.withColumn(f"_window_{i}", F.when(F.size(f"_windows_{i}") > 0, inside))
        value = F.lit(lo) + _uniform(seed + i, "asset_id", "epoch_timestamp") * F.lit(hi - lo)
        df = df.withColumn(name, F.when(F.col(f"_window_{i}").isNotNull(), F.col(f"_window_{i}.value")).otherwise(value))
    return df.select("epoch_timestamp", "asset_id", *bounds, F.timestamp_seconds("epoch_timestamp").alias("last_updated_date"))
