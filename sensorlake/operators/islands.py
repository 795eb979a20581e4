"""Gaps and islands (WN1): runs of hit times whose gaps stay within a limit.

A new island starts where the gap to the previous hit exceeds ``limit``
(S1: ``limit = 2 * data_frequency - 1`` for rules). An island is kept when
it lasts at least ``duration`` seconds, or touches the run window edges
``lo`` (= start - limit) or ``hi`` (= end) exactly (S2), so an anomaly split
across two runs is not lost.

Plan: two shuffles. Hits are grouped by (keys, time cell) and reduced to the
islands inside a cell; a cell's first and last island may go on in another
cell, so only these (at most two rows a cell) are grouped by the keys and
merged, while inner islands stay with their own cell. No window over a whole
series' hits exists, whatever the limit or the data frequency. Both shuffles
have a fixed number of tasks: hits compress thirtyfold and more, so merged
by their bytes a few tasks would sort them all in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import even_tasks
from .chunks import chunk_of

#: Seconds per cell: a task's unit is one series' hits of a cell, and the merge of a series sees at
#: most two islands a cell.
DEFAULT_CELL = 6 * 3600


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def islands(hits: DataFrame, keys: Sequence[str], ts: str, limit, duration=None, lo=None, hi=None,
            chunk=DEFAULT_CELL, extra: Sequence[str] = ()) -> DataFrame:
    """Islands ``keys..., start_time, end_time`` of hit times ``ts``.

    ``limit``, ``duration``, ``lo``, ``hi`` are ints or per-row columns (all rows
    of one key must agree, e.g. columns of a rule); ``limit`` may also name one of
    the ``extra`` columns. ``extra`` columns, constant per key, are carried to the
    output. With ``duration`` None every island is kept. Only the keys, the time,
    the limit and the extras travel through the shuffle. ``chunk`` is the cell
    length in seconds.
    """
    keys = list(keys)
    params = {} if isinstance(limit, str) else {"_limit": _lit(limit).cast("long")}
    lim = F.col(limit) if isinstance(limit, str) else F.col("_limit")
    for name, value in (("_dur", duration), ("_lo", lo), ("_hi", hi)):
        if value is not None:
            params[name] = _lit(value).cast("long")
    carried = [*extra, *params]
    h = hits.filter(F.col(ts).isNotNull()).select(
        *keys, *extra, F.col(ts).alias("_t"), chunk_of(ts, chunk).alias("_cell"), *[v.alias(k) for k, v in params.items()])

    # islands inside a cell
    tasks = even_tasks(hits.sparkSession)
    h = h.repartition(tasks, *keys, "_cell")
    cell = Window.partitionBy(*keys, "_cell")
    order = cell.orderBy("_t")
    h = h.withColumn("_p", F.lag("_t").over(order))
    h = h.withColumn("_new", (F.col("_p").isNull() | (F.col("_t") - F.col("_p") > lim)).cast("int"))
    h = h.withColumn("_isl", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    part = h.groupBy(*keys, "_cell", "_isl").agg(
        F.min("_t").alias("start_time"), F.max("_t").alias("end_time"), *[F.first(c).alias(c) for c in carried])
    part = part.withColumn("_last", F.max("_isl").over(cell))
    edge = (F.col("_isl") == 1) | (F.col("_isl") == F.col("_last"))

    # cells' first and last islands meet per key; inner ones are whole and keep a group of their own
    part = part.withColumn("_group", F.when(edge, F.lit(None)).otherwise(F.col("_cell"))).repartition(tasks, *keys, "_group")
    line = Window.partitionBy(*keys, "_group").orderBy("start_time")
    part = part.withColumn("_p", F.lag("end_time").over(line))
    part = part.withColumn("_new", (F.col("_group").isNotNull() | F.col("_p").isNull()
                                    | (F.col("start_time") - F.col("_p") > lim)).cast("int"))
    part = part.withColumn("_run", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    out = part.groupBy(*keys, "_group", "_run").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), *[F.first(c).alias(c) for c in carried])

    keep = F.lit(duration is None)
    if duration is not None:
        keep = keep | (F.col("end_time") - F.col("start_time") >= F.col("_dur"))
    if lo is not None:
        keep = keep | (F.col("start_time") == F.col("_lo"))
    if hi is not None:
        keep = keep | (F.col("end_time") == F.col("_hi"))
    return out.filter(keep).select(*keys, *extra, "start_time", "end_time")
