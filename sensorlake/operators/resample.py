"""Time-bucket resampling into gold summaries (GO1-GO9, AG5-AG7, JN8, ST1).

One ``groupBy(keys, bucket)`` computes every measure at once (sum, count and
min/max carried with the time of the extreme), so the input is scanned and
shuffled once; partial aggregation happens map-side. The long ("melted")
output is produced with ``inline`` in the same stage, not a union of scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import bucket_floor

# Gold bucket sizes (seconds) for the 30 min ... 1 month products (GO9).
GOLD_BUCKETS = (60, 120, 3600, 21600, 86400)

# Suffixes of the long-form gold parameters.
SUFFIXES = ("min", "max", "sum", "count")


def bucket_calendar(spark: SparkSession, start: int, end: int, n: int) -> DataFrame:
    """Bucket starts from ``floor(start)`` to ``floor(end)`` step ``n`` (GO1).

    Start and end are arguments (never ``now()``), so the same call is
    reproducible; the row count is ``(end - start) / n + 1``, known up front.
    """
    lo, hi = start - start % n, end - end % n
    return spark.range(lo, hi + 1, n).select(F.col("id").alias("bucket_start"))


def assign_bucket(df: DataFrame, ts: str, n: int, start: int | None = None, end: int | None = None,
                  required: Sequence[str] = ()) -> DataFrame:
    """Validity filter plus bucket column (GO2). Bounds are literals on the raw
    column, so they reach the parquet scan as pushed filters."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    if start is not None:
        cond = cond & (F.col(ts) >= start)
    if end is not None:
        cond = cond & (F.col(ts) <= end)
    return df.filter(cond).withColumn("bucket_start", bucket_floor(ts, n))


def _measure_aggs(metrics: Sequence[str], ts: str) -> list[Column]:
    out = []
    for m in metrics:
        live = F.col(m).isNotNull()
        out += [
            # struct order: value first, then time -> min keeps the earliest, max the latest tie
            F.min(F.when(live, F.struct(F.col(m).alias("v"), F.col(ts).alias("t")))).alias(f"_{m}_min"),
            F.max(F.when(live, F.struct(F.col(m).alias("v"), F.col(ts).alias("t")))).alias(f"_{m}_max"),
            F.sum(m).alias(f"_{m}_sum"),
            F.count(m).alias(f"_{m}_count"),
        ]
    return out


def _melt(agg: DataFrame, keys: Sequence[str], metrics: Sequence[str], name_col: str | None = None) -> DataFrame:
    def name(m, suffix):
        # long tables (tag_id, value) name the output after the tag: "<tag>_min"
        return (F.concat(F.col(name_col), F.lit(f"_{suffix}")) if name_col else F.lit(f"{m}_{suffix}")).alias("parameter")

    rows = []
    for m in metrics:
        rows += [
            F.struct(name(m, "min"), F.col(f"_{m}_min.t").cast("long").alias("timestamp"),
                     F.col(f"_{m}_min.v").cast("double").alias("value")),
            F.struct(name(m, "max"), F.col(f"_{m}_max.t").cast("long").alias("timestamp"),
                     F.col(f"_{m}_max.v").cast("double").alias("value")),
            F.struct(name(m, "sum"), F.col("bucket_start").cast("long").alias("timestamp"),
                     F.col(f"_{m}_sum").cast("double").alias("value")),
            F.struct(name(m, "count"), F.col("bucket_start").cast("long").alias("timestamp"),
                     F.coalesce(F.col(f"_{m}_count"), F.lit(0)).cast("double").alias("value")),
        ]
    return (agg.select(*keys, "bucket_start", F.inline(F.array(*rows)))
               .filter(F.col("value").isNotNull() & F.col("timestamp").isNotNull()))


def bucket_aggregate(df: DataFrame, keys: Sequence[str], ts: str, metrics: Sequence[str], n: int) -> DataFrame:
    """Wide per-bucket aggregate: sum, count, min/max with time (AG5+AG6)."""
    b = df if "bucket_start" in df.columns else df.withColumn("bucket_start", bucket_floor(ts, n))
    return b.groupBy(*keys, "bucket_start").agg(*_measure_aggs(metrics, ts))


def _fill_calendar(agg: DataFrame, keys: Sequence[str], metrics: Sequence[str], n: int,
                   calendar: tuple[int, int]) -> DataFrame:
    """Every key of ``agg`` gets every bucket of the calendar range (JN8), in one
    pass over the aggregate: the first bucket row of each key (a window over the
    small aggregate) is expanded into placeholder rows for the whole range with
    ``explode(sequence)`` and merged with the real rows by a second aggregate.
    No cross join, and the input is aggregated only once."""
    lo, hi = calendar[0] - calendar[0] % n, calendar[1] - calendar[1] % n
    w = Window.partitionBy(*keys)
    first = agg.withColumn("_first", F.min("bucket_start").over(w)).filter(F.col("bucket_start") == F.col("_first"))
    grid = first.select(*keys, F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"),
                                                     F.lit(n).cast("long"))).alias("bucket_start"))
    measures = [c for c in agg.columns if c not in (*keys, "bucket_start")]
    placeholders = grid.select(*keys, "bucket_start", *[F.lit(None).cast(agg.schema[c].dataType).alias(c)
                                                        for c in measures])
    merged = agg.unionByName(placeholders)
    re_aggs = []
    for m in metrics:
        re_aggs += [F.min(f"_{m}_min").alias(f"_{m}_min"), F.max(f"_{m}_max").alias(f"_{m}_max"),
                    F.sum(f"_{m}_sum").alias(f"_{m}_sum"), F.sum(f"_{m}_count").alias(f"_{m}_count")]
    return merged.groupBy(*keys, "bucket_start").agg(*re_aggs)


def summarize(df: DataFrame, keys: Sequence[str], ts: str, metrics: Sequence[str], n: int,
              calendar: tuple[int, int] | None = None, name_col: str | None = None) -> DataFrame:
    """Long gold rows ``keys, parameter, bucket_start, timestamp, value`` (GO3/GO4/GO6).

    Parameters are ``<metric>_{min,max,sum,count}``; min/max rows carry the time
    of the extreme, sum/count rows the bucket start. With ``calendar = (start,
    end)`` (GO1) every key seen in the input gets every bucket of the range; an
    empty bucket yields only a ``count = 0`` row (JN8). The grid is generated
    per key (``explode(sequence)``), not by a cross join (see ``_fill_calendar``).
    ``name_col`` (one of ``keys``) names the output after a tag column of a long
    table: ``<tag>_min`` etc.
    """
    agg = bucket_aggregate(df, keys, ts, metrics, n)
    if calendar is not None:
        agg = _fill_calendar(agg, keys, metrics, n, calendar)
    return _melt(agg, keys, metrics, name_col)


def summarize_wide(df: DataFrame, keys: Sequence[str], ts: str, metrics: Sequence[str],
                   unit: str = "hour") -> DataFrame:
    """Wide gold by calendar unit (GO5): ``epoch_timestamp`` = start of the
    ``date_trunc(unit)`` bucket, then ``min_<m>``, ``min_<m>_epoch_timestamp``,
    ``max_<m>``, ``max_<m>_epoch_timestamp`` per metric."""
    grp = F.unix_seconds(F.date_trunc(unit, F.timestamp_seconds(F.col(ts))))
    agg = df.withColumn("bucket_start", grp).groupBy(*keys, "bucket_start").agg(*_measure_aggs(metrics, ts))
    cols = [F.col("bucket_start").alias("epoch_timestamp"), *keys]
    for m in metrics:
        cols += [F.col(f"_{m}_min.t").alias(f"min_{m}_epoch_timestamp"), F.col(f"_{m}_min.v").alias(f"min_{m}"),
                 F.col(f"_{m}_max.t").alias(f"max_{m}_epoch_timestamp"), F.col(f"_{m}_max.v").alias(f"max_{m}")]
    return agg.select(*cols)


def dedupe_gold(gold: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """One row per (keys, parameter, bucket) of a long gold frame (GO8 core).

    ``*_min`` keeps the smallest value (earliest time on ties), ``*_max`` the
    largest (latest time); ``*_sum`` and ``*_count`` rows are added up.
    """
    g = gold.withColumn("bucket_start", bucket_floor("timestamp", n))
    kind = F.substring_index(F.col("parameter"), "_", -1)
    pair = F.struct(F.col("value").alias("v"), F.col("timestamp").alias("t"))
    agg = g.groupBy(*keys, "parameter", "bucket_start").agg(
        F.min(pair).alias("_lo"), F.max(pair).alias("_hi"),
        F.sum("value").alias("_sum"), F.min("timestamp").alias("_t0"), F.first(kind).alias("_kind"))
    return agg.select(
        *keys, "parameter", "bucket_start",
        F.when(F.col("_kind") == "min", F.col("_lo.t")).when(F.col("_kind") == "max", F.col("_hi.t"))
         .otherwise(F.col("_t0")).alias("timestamp"),
        F.when(F.col("_kind") == "min", F.col("_lo.v")).when(F.col("_kind") == "max", F.col("_hi.v"))
         .otherwise(F.col("_sum")).alias("value"))


def refresh_gold(gold: DataFrame, new: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """New gold table after replacing the buckets present in ``new`` (GO7, SK7).

    ``new`` is deduplicated per bucket; gold rows of the same
    (keys, parameter, bucket) are removed by a ``left_anti`` join (the
    delete-where-exists), then the fresh rows are appended. Replacing (not
    adding) makes the refresh idempotent: run twice = run once.
    """
    fresh = dedupe_gold(new, keys, n)
    old = gold.withColumn("bucket_start", bucket_floor("timestamp", n))
    kept = old.join(fresh.select(*keys, "parameter", "bucket_start"), [*keys, "parameter", "bucket_start"], "left_anti")
    return kept.unionByName(fresh.select(*old.columns))


def compact_gold(gold: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Compaction of an existing long gold table to one row per key and bucket (GO8)."""
    return dedupe_gold(gold, keys, n)


def resample_mean(df: DataFrame, keys: Sequence[str], ts: str, n: int, metrics: Sequence[str]) -> DataFrame:
    """Tumbling mean of every listed numeric column per bucket (SM6 batch form)."""
    return (df.withColumn("bucket_start", bucket_floor(ts, n))
              .groupBy(*keys, "bucket_start")
              .agg(*[F.avg(m).alias(m) for m in metrics]))


def _rollup(agg: DataFrame, keys: Sequence[str], metrics: Sequence[str], size: int) -> DataFrame:
    """Re-aggregate bucket aggregates into coarser buckets of ``size`` seconds:
    min/max structs keep their times, sums and counts add up."""
    aggs = []
    for m in metrics:
        aggs += [F.min(f"_{m}_min").alias(f"_{m}_min"), F.max(f"_{m}_max").alias(f"_{m}_max"),
                 F.sum(f"_{m}_sum").alias(f"_{m}_sum"), F.sum(f"_{m}_count").alias(f"_{m}_count")]
    coarse = agg.withColumn("bucket_start", bucket_floor("bucket_start", size))
    return coarse.groupBy(*keys, "bucket_start").agg(*aggs).withColumn("bucket_size", F.lit(int(size)))


def gold_products(df: DataFrame, keys: Sequence[str], ts: str, metrics: Sequence[str],
                  sizes: Sequence[int] = GOLD_BUCKETS, name_col: str | None = None) -> DataFrame:
    """GO9: gold rows for several bucket sizes from one pass over the readings.

    The readings are aggregated once at the finest size; every coarser size is
    a roll-up of that (much smaller) aggregate, since min/max-with-time, sum
    and count compose. Sizes that are not multiples of the finest one are
    computed from the readings directly (each row tagged with those sizes).
    """
    sizes = sorted({int(x) for x in sizes})
    base = sizes[0]
    fine = bucket_aggregate(df, keys, ts, metrics, base)
    parts = [fine.withColumn("bucket_size", F.lit(base))]
    nested = [x for x in sizes[1:] if x % base == 0]
    others = [x for x in sizes[1:] if x % base != 0]
    parts += [_rollup(fine, keys, metrics, x) for x in nested]
    if others:
        sized = df.withColumn("bucket_size", F.explode(F.array(*[F.lit(x) for x in others])))
        sized = sized.withColumn("bucket_start", bucket_floor(ts, F.col("bucket_size").cast("long")))
        parts.append(sized.groupBy("bucket_size", *keys, "bucket_start").agg(*_measure_aggs(metrics, ts)))
    cols = ["bucket_size", *keys, "bucket_start", *[c for c in fine.columns if c not in (*keys, "bucket_start")]]
    agg = parts[0].select(*cols)
    for p in parts[1:]:
        agg = agg.unionByName(p.select(*cols))
    return _melt(agg, ["bucket_size", *keys], metrics, name_col)


__all__ = ["bucket_calendar", "assign_bucket", "bucket_aggregate", "summarize", "summarize_wide",
           "dedupe_gold", "refresh_gold", "compact_gold", "resample_mean", "gold_products"]
