"""Aggregations and set operators (AG1-AG17, ST1-ST3).

All are single ``groupBy``/``pivot``/set operations with map-side partial
aggregation; element-wise array averages go through ``posexplode`` so a
hot key is spread over array positions before the shuffle; per-key lists are
only collected where their length is bounded (array width, small domains).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import compare

# Aggregate functions a soft tag may use (AG3).
SOFT_TAG_FUNCTIONS = ("average", "maximum", "median", "sum")


def dedup_aggregate(df: DataFrame, tag: str, value: str, batch: str, ts: str) -> DataFrame:
    """AG1: latest time per (tag, value, batch), then latest time per batch."""
    per = df.groupBy(tag, value, batch).agg(F.max(ts).alias(ts))
    return per.groupBy(batch).agg(F.max(ts).alias(ts))


def pivot_tags(df: DataFrame, keys: Sequence[str], tag: str, value: str, tags: Sequence[str],
               names: Mapping[str, str] | None = None) -> DataFrame:
    """AG2: tags to columns with a fixed value list (no extra distinct job),
    ``max(value)`` per cell; an absent tag gives null. ``names`` renames columns."""
    p = df.groupBy(*keys).pivot(tag, list(tags)).agg(F.max(value))
    for t, n in (names or {}).items():
        p = p.withColumnRenamed(t, n)
    return p


def median_bracket(df: DataFrame, keys: Sequence[str], value: str, accuracy: int = 1000) -> DataFrame:
    """Per key the values between which the median's ranks must lie, each once with its count (``_v``, ``_c``), one
    row for all rows below them (``_v`` null), and the key's number of rows (``_n``).

    The bracket's ends come from a quantile sketch (bounded, merged map-side): it holds some ``4 / accuracy`` of a
    key's rows, and equal values are one row after the map side.
    """
    x = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    reach = 2.0 / accuracy
    ends = F.percentile_approx("_x", [0.5 - reach, 0.5 + reach], accuracy)
    per = x.groupBy(*keys).agg(ends.alias("_b"), F.count(F.lit(1)).alias("_n"))
    per = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"), "_n")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    j = x.join(per, same, "inner") if keys else x.join(F.broadcast(per))  # without keys: one row
    inside = F.when(F.col("_x") >= F.col("_lo"), F.col("_x"))
    return j.filter(F.col("_x") <= F.col("_hi")).groupBy(*keys, inside.alias("_v"), "_n").agg(F.count(F.lit(1)).alias("_c"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", accuracy: int = 1000) -> DataFrame:
    """Exact median per key without holding a key's values: a sketch brackets the middle ranks, one more pass counts
    what lies below and inside the bracket (``median_bracket``), and only that is ordered to pick them.
    Nulls are left out (a key of nulls alone has no row), NaN is the largest value, as in Spark's own ``median``.
    """
    keys = list(keys)
    line = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())
    counted = median_bracket(df, keys, value, accuracy).withColumn("_upto", F.sum("_c").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    first, last = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1  # the middle ranks, from 1
    holds = [(F.col("_upto") >= r) & (F.col("_upto") - F.col("_c") < r) for r in (first, last)]
    return counted.groupBy(*keys).agg(((F.max(F.when(holds[0], F.col("_v"))) + F.max(F.when(holds[1], F.col("_v")))) / 2).alias(out))


def soft_tags(df: DataFrame, mapping: DataFrame, keys: Sequence[str], tag: str, value: str, ts: str) -> DataFrame:
    """AG3: derived tags from tag sets, all in one aggregate (medians by ``exact_median``).

    ``mapping`` rows ``(output_tag, input_tag, function)`` with function one of
    average / maximum / median / sum (sum = rate). Our definition of the absent
    helpers (S7): per (keys, output tag) aggregate over the listed input tags,
    timestamp = latest input time, quality ``Good``. In a stream a median is Spark's own, over one window's values.
    """
    m = mapping.withColumnRenamed("input_tag", tag)
    j = df.join(m, tag)
    fn = F.first("function")
    wanted = F.when(F.col("function") == "median", F.col(value))
    aggs = [fn.alias("_fn"), F.avg(value).alias("_avg"), F.max(value).alias("_max"), F.sum(value).alias("_sum"), F.max(ts).alias(ts)]
    agg = j.groupBy(*keys, "output_tag").agg(*aggs, *([F.median(wanted).alias("_med")] if df.isStreaming else []))
    if not df.isStreaming:
        own = [*keys, "output_tag"]
        med = exact_median(j.filter(F.col("function") == "median"), own, value, "_med")
        same = F.lit(True)
        for i, k in enumerate(own):
            med = med.withColumnRenamed(k, f"_m{i}")
            same = same & F.col(k).eqNullSafe(F.col(f"_m{i}"))
        agg = agg.join(med, same, "left").drop(*[f"_m{i}" for i in range(len(own))])
    v = (F.when(F.col("_fn") == "average", F.col("_avg")).when(F.col("_fn") == "maximum", F.col("_max"))
          .when(F.col("_fn") == "median", F.col("_med")).when(F.col("_fn") == "sum", F.col("_sum")))
    return agg.select(*keys, F.col("output_tag").alias("tag_id"), v.alias("value"), ts, F.lit("Good").alias("quality"))


def linear_soft_sensor(df: DataFrame, coefficients: DataFrame, keys: Sequence[str], tag: str, value: str,
                       intercept: float = 5.0, transform=None) -> DataFrame:
    """AG4: ``sum(coef * value) + intercept`` over a coefficient table, null when
    any listed tag is absent for the key; optional ``transform(Column)`` (the
    ratio step, caller supplied)."""
    coef = coefficients.withColumnRenamed("tag", tag)
    n_tags = coefficients.select("tag").distinct().count()  # model size, a handful of tags
    j = df.join(coef, tag)
    agg = j.groupBy(*keys).agg(F.sum(F.col("coef") * F.col(value)).alias("_s"),
                               F.count_distinct(tag).alias("_k"))
    v = F.when(F.col("_k") == F.lit(n_tags), F.col("_s") + F.lit(intercept))
    if transform is not None:
        v = transform(v)
    return agg.select(*keys, v.alias("value"))


def group_having(df: DataFrame, keys: Sequence[str], value: str, fn: str, op: str, threshold: float,
                 where: Column | None = None) -> DataFrame:
    """AG9: ``groupBy(keys)`` aggregate avg/min/max of ``value`` (optionally over a
    ``where`` range), kept when ``agg op threshold``."""
    f = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}[fn]
    d = df if where is None else df.filter(where)
    agg = d.groupBy(*keys).agg(f(value).alias("agg_value"))
    return agg.filter(compare("agg_value", op, threshold))


def array_extremes(df: DataFrame, keys: Sequence[str], time: str, data: str, depth: str | None) -> DataFrame:
    """AG10: explode value arrays (with their depth array or positions) and keep
    min/max with where (depth) and when (time), plus sum and count per key."""
    if depth:
        ex = df.select(*keys, time, F.inline(F.arrays_zip(F.col(data).alias("v"), F.col(depth).alias("d"))))
    else:
        ex = df.select(*keys, time, F.posexplode(data).alias("d", "v"))
    ex = ex.filter(F.col("v").isNotNull())
    lo = F.min(F.struct(F.col("v"), F.col(time).alias("t"), F.col("d")))
    hi = F.max(F.struct(F.col("v"), F.col(time).alias("t"), F.col("d")))
    agg = ex.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi"), F.sum("v").alias("sum_value"),
                                F.count("v").alias("count_value"))
    return agg.select(*keys, F.col("_lo.v").alias("min_value"), F.col("_lo.t").alias("min_time"),
                      F.col("_lo.d").alias("min_depth"), F.col("_hi.v").alias("max_value"),
                      F.col("_hi.t").alias("max_time"), F.col("_hi.d").alias("max_depth"),
                      "sum_value", "count_value")


def array_average(df: DataFrame, keys: Sequence[str], data: str, out: str = "data") -> DataFrame:
    """AG11: element-wise average of equal-position array elements per key.

    ``posexplode`` -> ``avg`` per (key, position) -> position-sorted collect.
    The collect per key is bounded by the array width.
    """
    ex = df.select(*keys, F.posexplode(data).alias("_pos", "_v"))
    avg = ex.groupBy(*keys, "_pos").agg(F.avg("_v").alias("_a"))
    lst = avg.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_pos", "_a"))).alias("_l"))
    return lst.select(*keys, F.transform("_l", lambda x: x["_a"]).alias(out))


def flatten_lists(df: DataFrame, keys: Sequence[str], lists: str, out: str) -> DataFrame:
    """AG12: flatten + distinct of per-row lists per key: elements are exploded
    first and gathered as a set (deduplicated map-side), so a hot key never
    holds all of its lists at once."""
    ex = df.select(*keys, F.explode(lists).alias("_e"))
    return ex.groupBy(*keys).agg(F.sort_array(F.collect_set("_e")).alias(out))


def multiplicity(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """AG13: rows per key with a single / multi label (HAVING = 1 / > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .withColumn("kind", F.when(F.col(out) == 1, F.lit("single")).otherwise(F.lit("multi"))))


def min_of_max(df: DataFrame, group: str, ts: str) -> DataFrame:
    """AG14: latest time per group and the earliest of those latest times
    (the common "data complete up to" watermark)."""
    per = df.groupBy(group).agg(F.max(ts).alias("max_time"))
    # one row per sensor type: a global window over that tiny aggregate
    return per.withColumn("min_of_max", F.min("max_time").over(Window.partitionBy()))


def top_n(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """AG15: frequency count, top ``n`` by count then key (a top-k report)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(n)


def duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """AG16: keys occurring more than once, with copy count and smallest id."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies"), F.min(id_col).alias(f"min_{id_col}"))
              .filter(F.col("n_copies") > 1))


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "parameter",
         value: str = "value") -> DataFrame:
    """ST1: wide -> long in one pass (``unpivot``), not a union of scans."""
    return df.unpivot(list(keys), list(columns), name, value)
