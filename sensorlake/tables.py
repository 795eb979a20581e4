"""Readers for the parquet tables and their mapping onto the sensor data model.

The long reading table used by the rule and resampling operators is
``(asset_id, parameter, epoch, value, k)``; on the driver's test data it is
derived from ``events``: asset = user, parameter = event type, epoch = whole
seconds of ``ts`` (UTC), ``k`` = the ``$.k`` field of ``props`` (class / depth).
The fibre form ``(asset_id, depth, timestamp, value)`` groups those readings
into hourly profiles with depth = ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalars import bucket_floor, epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, since: int | None = None, until: int | None = None) -> DataFrame:
    """Long reading table from ``events`` (see module doc).

    ``since``/``until`` (epoch seconds, inclusive) filter the raw ``ts`` column,
    so the bound reaches the parquet scan as a pushed filter.
    """
    ev = table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType
    if since is not None:
        ev = ev.filter(F.col("ts") >= _ts_lit(since, ts_type))
    if until is not None:
        ev = ev.filter(F.col("ts") < _ts_lit(until + 1, ts_type))
    return ev.select(
        F.col("user_id").alias("asset_id"),
        F.col("event_type").alias("parameter"),
        epoch_seconds("ts", ts_type).alias("epoch"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _ts_lit(epoch: int, ts_type):
    import datetime as _dt
    v = _dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=int(epoch))
    return F.lit(v).cast(ts_type)


def fibre(spark: SparkSession, sf_dir: str, period: int = 3600) -> DataFrame:
    """Fibre-style profile rows ``(asset_id, depth, timestamp, value)``:
    asset = event type, depth = ``k``, timestamp = reading time floored to ``period``."""
    r = readings(spark, sf_dir)
    return r.select(
        F.col("parameter").alias("asset_id"),
        F.col("k").alias("depth"),
        bucket_floor("epoch", period).alias("timestamp"),
        F.col("value"),
    )


# DuckDB text of the same mappings, used by the oracle SQL of the registry.
READINGS_SQL = (
    "SELECT user_id AS asset_id, event_type AS parameter, "
    "CAST(floor(epoch(ts)) AS BIGINT) AS epoch, value, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
)

FIBRE_SQL = (
    "SELECT parameter AS asset_id, k AS depth, epoch - epoch % 3600 AS timestamp, value "
    f"FROM ({READINGS_SQL})"
)
