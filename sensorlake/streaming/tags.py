"""Streaming tag stages (SM1-SM6): bronze -> silver -> gold.

Every function takes a streaming (or batch) DataFrame and returns one; the
caller starts it with ``sources.sinks.write_stream`` / ``write_stream_batch``.
State is bounded by watermarks (30 s silver, 4 min gold by default).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as ag

# Watermark delays of the silver and gold streams.
SILVER_WATERMARK = "30 seconds"
GOLD_WATERMARK = "4 minutes"


def dedup_silver(df: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ("tag_id", "value", "timestamp"),
                 watermark: str = SILVER_WATERMARK, reset_date: str | None = None) -> DataFrame:
    """SM1/SM2: drop replays older than the reset date (ahead of state), then
    de-duplicate on keys within the watermark; later duplicates and rows behind
    the watermark are dropped, state is evicted by the watermark."""
    out = df
    if reset_date is not None:
        out = out.filter(F.col(ts) > F.lit(reset_date).cast("timestamp"))
    out = out.withWatermark(ts, watermark)
    if out.isStreaming:
        return out.dropDuplicatesWithinWatermark(list(keys))
    return out.dropDuplicates(list(keys))


def physical_tags(df: DataFrame, aggregation_tags: DataFrame, tag: str = "tag_id") -> DataFrame:
    """JN2/SM5: raw tags that are not aggregation tags (stream x static left anti)."""
    return df.join(aggregation_tags.select(tag), tag, "left_anti")


def enrich_gold(df: DataFrame, metadata: DataFrame, tag: str = "tag_id",
                source_tag: str = "source_tag_id") -> DataFrame:
    """JN1/SM5: silver x tag metadata (measurement set uuid), stream-static inner join."""
    m = metadata.withColumnRenamed(source_tag, tag)
    return df.join(m, tag, "inner")


def soft_tag_stream(df: DataFrame, mapping: DataFrame, window: str = "60 seconds",
                    watermark: str = SILVER_WATERMARK, ts: str = "timestamp") -> DataFrame:
    """SM3/AG3: all soft tags of a group in one stream: per (event-time window,
    output tag) aggregate over the listed input tags. One checkpoint per group
    instead of one query per soft tag."""
    w = df.withWatermark(ts, watermark).withColumn("_w", F.window(ts, window))
    # group by the window struct itself so the watermark applies (append mode)
    out = ag.soft_tags(w, mapping, ["_w"], "tag_id", "value", ts)
    return out.select("tag_id", "value", F.col(ts).alias("timestamp"), "quality",
                      F.col("_w.start").alias("window_start"))


def pivot_batch(tags: Sequence[str], expression, batch: str = "last_updated_date", out_tag: str = "derived",
                tag: str = "tag_id", value: str = "value", ts: str = "timestamp"):
    """SM4/AG1/AG2: a ``foreachBatch`` body: whitelist, dedup-aggregate, pivot of
    fixed tags, derived value = ``expression(pivoted_frame)`` (a Column)."""
    def fn(batch_df: DataFrame) -> DataFrame:
        f = batch_df.filter(F.col(tag).isin(*tags) & ~F.isnan(value))
        d = f.groupBy(tag, value, batch).agg(F.max(ts).alias(ts))
        last = ag.dedup_aggregate(f, tag, value, batch, ts)
        p = ag.pivot_tags(d, [batch], tag, value, tags)
        j = p.join(last, batch)
        return j.select(F.lit(out_tag).alias("tag_id"), expression(j).alias("value"), ts,
                        F.lit("Good").alias("quality"))
    return fn


def resample_stream(df: DataFrame, ts: str, columns: Sequence[str], window: str = "60 seconds",
                    watermark: str = SILVER_WATERMARK, keys: Sequence[str] = ()) -> DataFrame:
    """SM6: tumbling resample, mean of each listed numeric column per window
    (explicit ``avg`` per column; ``mean("*")`` is not valid)."""
    w = df.withWatermark(ts, watermark).groupBy(*keys, F.window(ts, window).alias("_w"))
    return w.agg(*[F.avg(c).alias(c) for c in columns]).select(
        *keys, F.col("_w.start").alias(ts), *columns)
