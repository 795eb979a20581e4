"""Broker-shaped streams (SR2, SR3, SK4): enqueued-time filter, body to text,
module filter, optional decompression, and rows back to a binary JSON body.

The broker connector itself is the caller's ``readStream.format(...)``; these
functions work on any stream or table with the columns (body, enqueuedTime,
properties)."""

from __future__ import annotations

import base64
import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape_broker(df: DataFrame, since: str | None, module_key: str, module: str | None = None) -> DataFrame:
    """SR2: rows enqueued after ``since``, body as text, module id from the
    ``properties`` map as ``source_module``; optionally one module only."""
    out = df
    if since is not None:
        out = out.filter(F.col("enqueuedTime") > F.lit(since).cast("timestamp"))
    out = out.select(F.col("properties")[module_key].alias("source_module"), F.col("body").cast("string").alias("body"))
    if module is not None:
        out = out.filter(F.col("source_module") == module)
    return out


def _gunzip_b64(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return gzip.decompress(base64.b64decode(text)).decode("utf-8")
    except Exception:  # noqa: BLE001 - undecodable payloads become null, not a failed batch
        return None


def decompress_body(df: DataFrame, col: str = "body", codec: str = "gzip+base64") -> DataFrame:
    """SR3: decompress a text column holding base64 gzip payloads (``mapInPandas``,
    one Arrow batch at a time). Undecodable payloads become null."""
    if codec != "gzip+base64":
        raise ValueError(f"unsupported codec {codec}")
    schema = df.schema

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[col] = pdf[col].map(_gunzip_b64)
            yield pdf
    return df.mapInPandas(fn, schema)


def to_broker_body(df: DataFrame, renames: dict[str, str] | None = None, cols=None, keep=()) -> DataFrame:
    """SK4: row -> JSON -> binary ``body`` (renames e.g. tag_id -> tagId); ``cols``
    picks the fields of the body (default all), ``keep`` columns travel alongside
    (e.g. an event time or properties for the sender)."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keep]
    fields = [F.col(c).alias((renames or {}).get(c, c)) for c in cols]
    return df.select(F.to_json(F.struct(*fields)).cast("binary").alias("body"), *keep)
