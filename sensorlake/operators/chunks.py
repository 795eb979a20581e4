"""Day-split helpers: ordered computations per key without one task per key.

Window functions partitioned only by (rule, asset) put a whole series in one
task; a hot asset holding a third of all rows would then be one task. These
helpers cut every series into time chunks (default one day) and restore the
exact result across chunk boundaries:

* ``halo_split`` copies the rows a frame needs from neighbouring chunks
  (bounded overlap), so a ``rangeBetween`` frame is exact for the chunk's own
  rows;
* ``carry`` turns a per-chunk summary into "value of all earlier chunks"
  with a window over one row per chunk (days, not readings);
* ``row_ranks`` numbers a series' rows that way, and ``row_halo`` cuts it into
  blocks of rows with the last rows of the block before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 86400


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def chunk_of(ts, chunk=DEFAULT_CHUNK) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(ts / _c(chunk)).cast("long")


def halo_split(df: DataFrame, ts: str, before=0, after=0, chunk=DEFAULT_CHUNK) -> DataFrame:
    """Rows tagged with ``_chunk`` and ``_primary``.

    A row is kept in its own chunk (``_primary``) and copied into every chunk
    holding a row whose frame ``[t - before, t + after]`` reaches it. Frames
    evaluated with ``partitionBy(keys, "_chunk")`` are then exact for primary
    rows; copies are dropped afterwards. Copy factor is about
    ``1 + (before + after) / chunk``. ``before``/``after``/``chunk`` may be
    per-row columns (e.g. one duration per rule).
    """
    t = F.col(ts)
    lo = chunk_of(t - _c(after), chunk)
    hi = chunk_of(t + _c(before), chunk)
    return (df.withColumn("_chunk", F.explode(F.sequence(lo, hi)))
              .withColumn("_primary", F.col("_chunk") == chunk_of(t, chunk)))


def carry(summary: DataFrame, keys: Sequence[str], out: dict[str, Column]) -> DataFrame:
    """Add columns computed over *earlier* chunks of the same key.

    ``summary`` holds one row per (keys, ``_chunk``); ``out`` maps new column
    names to aggregate expressions evaluated over all earlier chunks, e.g.
    ``{"_prev_last": F.max("_last")}``.
    """
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    for name, agg in out.items():
        summary = summary.withColumn(name, agg.over(w))
    return summary


def row_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, out: str = "_k",
              chunk=DEFAULT_CHUNK, counted: Column | None = None) -> DataFrame:
    """``df`` with ``out`` = number of rows (where ``counted``) of the key up to and
    including this one in ``order`` (which begins with ``ts``).

    Counted inside a time chunk, plus the count of earlier chunks (a window over
    one row per chunk), so no window spans a whole series.
    """
    keys = list(keys)
    one = F.lit(1) if counted is None else F.when(counted, F.lit(1))
    base = df.withColumn("_chunk", F.coalesce(chunk_of(ts, chunk), F.lit(0).cast("long")))
    upto = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("_r", F.count(one).over(upto))
    cnt = carry(base.groupBy(*keys, "_chunk").agg(F.max("_r").alias("_cnt")), keys, {"_before": F.sum("_cnt")})
    cnt = cnt.select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.col("_chunk").alias("_q_chunk"), "_before")
    same = F.col("_chunk") == F.col("_q_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_q_{k}"))
    ranked = base.join(cnt, same, "inner").withColumn(out, F.col("_r") + F.coalesce(F.col("_before"), F.lit(0)))
    return ranked.drop("_chunk", "_r", "_before", "_q_chunk", *[f"_q_{k}" for k in keys])


def row_halo(df: DataFrame, keys: Sequence[str], ts: str, n: int, chunk=DEFAULT_CHUNK) -> DataFrame:
    """Rows tagged ``_chunk``/``_primary``/``_k`` such that a ``rowsBetween(-n, 0)``
    frame over ``partitionBy(keys, "_chunk").orderBy("_k")`` is exact for primary rows.

    A block holds at least 50 n rows by their rank in the series, so copying the
    last n rows of each block into the next adds at most 2 %, however sparse the
    series is in time.
    """
    size = max(1000, 50 * int(n))
    ranked = row_ranks(df, keys, [ts], ts, "_k", chunk)
    block = F.floor((F.col("_k") - 1) / size).cast("long")
    at_end = F.pmod(F.col("_k") - 1, F.lit(size)) >= size - int(n)
    return (ranked.withColumn("_block", block)
                  .withColumn("_chunk", F.explode(F.when(at_end, F.array(F.col("_block"), F.col("_block") + 1))
                                                   .otherwise(F.array(F.col("_block")))))
                  .withColumn("_primary", F.col("_chunk") == F.col("_block")).drop("_block"))
