"""Interval operators: overlap join (JN6), N-way AND / OR of interval sets
(RU4-RU6 combination, ST2), same-time presence (JN9).

Overlap join without a nested loop: an interval's level is the power of
``fanout`` (from ``base``) that is at least its length, so it touches at most
two bins of its own level. Two intervals meet on the higher of their levels:
one of them is there by its own level (at most two bins) and the other, being
no longer than a bin, touches at most two of these bins too. So two equi joins
find all pairs: left by its own level with the right rows of that level or
lower, and right by its own level with the left rows of strictly lower ones.
A row is placed on a level above its own only where the other side has rows of
that level, in two bins at most, and candidates share a bin as long as the
longer of the two; there is no cap and nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import DEFAULT_CHUNK, carry, chunk_of


def _level(length: Column, base: int, fanout: int) -> Column:
    """Smallest level whose bins are at least as long as the interval."""
    return F.greatest(F.lit(0), F.ceil(F.log(float(fanout), F.greatest(length, F.lit(1)) / F.lit(float(base))) - F.lit(1e-9))).cast("int")


def _width(level: Column, base: int, fanout: int) -> Column:
    return (F.lit(base) * F.pow(F.lit(float(fanout)), level)).cast("long")


def _cells(df: DataFrame, s: str, e: str, level: Column, prefix: str, base: int, fanout: int) -> DataFrame:
    """``df`` once per bin of ``level`` that it touches."""
    df = df.withColumn(f"{prefix}at", level)
    width = _width(F.col(f"{prefix}at"), base, fanout)
    return df.withColumn(f"{prefix}bin", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ls: str, le: str, rs: str, re: str,
                 base: int | str = 3600, fanout: int = 16) -> DataFrame:
    """All pairs of closed intervals that overlap (``ls <= re and rs <= le``) with
    equal ``keys``; adds ``start_time = greatest(starts)``, ``end_time = least(ends)``.

    Column names other than ``keys`` must differ between the sides and from
    ``start_time``/``end_time``. ``base`` is the bin length of the lowest level,
    best near the shortest common interval length (``"auto"``: the median length
    of both sides, one approximate percentile aggregate). Rows with a null bound
    or an end before their start join nothing.
    """
    keys = list(keys)
    if base == "auto":
        lens = (left.select((F.col(le) - F.col(ls)).alias("_len"))
                    .unionByName(right.select((F.col(re) - F.col(rs)).alias("_len"))))
        base = max(int(lens.agg(F.percentile_approx("_len", 0.5)).first()[0] or 0), 1)
    lcols, rcols = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    a = left.filter(F.col(ls) <= F.col(le)).withColumn("_lv", _level(F.col(le) - F.col(ls), base, fanout))
    b = right.filter(F.col(rs) <= F.col(re)).withColumn("_rv", _level(F.col(re) - F.col(rs), base, fanout))
    rkeys = [F.col(k).alias(f"_r_{k}") for k in keys]

    def levels(df: DataFrame, own: str, name: str) -> DataFrame:
        """Per key the levels in use: a short list."""
        return df.groupBy(*keys).agg(F.collect_set(own).alias(name))

    def raised(df: DataFrame, other: DataFrame, own: str, strict: bool) -> DataFrame:
        """``df`` once per level of ``other`` (same keys) that is not below (``strict``: above) its own."""
        up = df.join(other, keys, "inner")
        above = F.filter("_levels", lambda x: (x > F.col(own)) if strict else (x >= F.col(own)))
        return up.withColumn("_to", F.explode(above)).drop("_levels")

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        """Left cells ``x`` with right cells ``y``; a pair counts in the bin of the greater start."""
        y = y.select(*rkeys, *rcols, "_rat", "_rbin")
        on = [F.col(k) == F.col(f"_r_{k}") for k in keys] + [F.col("_lat") == F.col("_rat"), F.col("_lbin") == F.col("_rbin")]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        start = F.greatest(F.col(ls), F.col(rs))
        j = x.join(y, cond, "inner")
        j = j.filter((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le))
                     & (F.col("_lbin") == F.floor(start / _width(F.col("_lat"), base, fanout))))
        return j.select(*keys, *lcols, *rcols, start.alias("start_time"), F.least(F.col(le), F.col(re)).alias("end_time"))

    own_left = _cells(a, ls, le, F.col("_lv"), "_l", base, fanout)
    own_right = _cells(b, rs, re, F.col("_rv"), "_r", base, fanout)
    up_right = _cells(raised(b, levels(a, "_lv", "_levels"), "_rv", False), rs, re, F.col("_to"), "_r", base, fanout)
    up_left = _cells(raised(a, levels(b, "_rv", "_levels"), "_lv", True), ls, le, F.col("_to"), "_l", base, fanout)
    return meet(own_left, up_right).unionByName(meet(up_left, own_right))


def intersect_members(intervals: DataFrame, group: Sequence[str], member: str, n_members: str,
                      chunk=DEFAULT_CHUNK) -> DataFrame:
    """AND of interval sets (RU4-RU6 with join condition AND).

    ``intervals`` holds ``group..., member, n_members, start_time, end_time``;
    each member's intervals are disjoint and not adjacent (islands). Output:
    the maximal ``[start_time, end_time]`` where all ``n_members`` members hold
    an interval, i.e. ``[greatest(starts), least(ends)]`` of every overlapping
    combination, with ``start <= end`` always (S3).

    Sweep line: +1 at a start, -1 after an end, running sum per group. The
    running sum is exact per day chunk plus the carried total of earlier
    chunks, so no task holds a whole group.
    """
    g = list(group)
    ev = intervals.select(*g, n_members, F.explode(F.array(
        F.struct(F.col("start_time").alias("p"), F.lit(1).alias("d")),
        F.struct((F.col("end_time") + 1).alias("p"), F.lit(-1).alias("d")))).alias("_e"))
    # one row per (group, point): net change at that point
    ev = (ev.groupBy(*g, n_members, F.col("_e.p").alias("_p")).agg(F.sum("_e.d").alias("_d"))
            .withColumn("_chunk", chunk_of("_p", chunk)))
    wc = Window.partitionBy(*g, "_chunk").orderBy("_p")
    ev = ev.withColumn("_loc", F.sum("_d").over(wc.rowsBetween(Window.unboundedPreceding, 0)))
    tot = ev.groupBy(*g, "_chunk").agg(F.sum("_d").alias("_tot"), F.min("_p").alias("_first"))
    tot = carry(tot, g, {"_before": F.sum("_tot")})
    wk = Window.partitionBy(*g).orderBy("_chunk")
    tot = tot.withColumn("_nfirst", F.lead("_first").over(wk)).select(*g, "_chunk", "_before", "_nfirst")
    ev = ev.join(tot, [*g, "_chunk"], "inner")
    ev = (ev.withColumn("_cov", F.col("_loc") + F.coalesce(F.col("_before"), F.lit(0)))
            .withColumn("_next", F.coalesce(F.lead("_p").over(wc), F.col("_nfirst"))))
    return (ev.filter((F.col("_cov") == F.col(n_members)) & F.col("_next").isNotNull())
              .select(*g, F.col("_p").alias("start_time"), (F.col("_next") - 1).alias("end_time")))


def all_present(hits: DataFrame, group: Sequence[str], at: str, member: str, n_members: str) -> DataFrame:
    """Times (or grid cells) at which every member of a group has a hit (JN9):
    ``count(distinct member) == n``; an aggregate, no self-join."""
    return (hits.groupBy(*group, at).agg(F.count_distinct(member).alias("_n"), F.first(n_members).alias("_need"))
                .filter(F.col("_n") == F.col("_need")).select(*group, at))
