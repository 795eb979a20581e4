"""Record reconciliation (RC1-RC7): id set differences, staged checks,
attribute rules, referential and foreign-key integrity, corrections, and
pattern-based export splits. Every check is a join (anti / semi / equi on the
attribute), never a nested loop over ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def missing_ids(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """RC1: distinct ids of ``a`` absent from ``b``."""
    bk = b.select(F.col(b_key or key).alias(key)).filter(F.col(key).isNotNull())
    return a.select(key).distinct().join(bk, key, "left_anti")


def staged_check(candidates: DataFrame, key: str, status: str, prefixes: Sequence[str],
                 first: DataFrame, first_ok: Column, second: DataFrame, second_ok: Column) -> DataFrame:
    """RC2: ids whose status starts with one of ``prefixes`` and that are neither
    confirmed in ``first`` (rows passing ``first_ok``) nor in ``second``
    (rows passing ``second_ok``)."""
    cond = None
    for p in prefixes:
        c = F.col(status).startswith(p)
        cond = c if cond is None else cond | c
    ids = candidates.filter(cond).select(key).distinct()
    ok1 = first.filter(first_ok).select(key)
    ok2 = second.filter(second_ok).select(key)
    return ids.join(ok1, key, "left_anti").join(ok2, key, "left_anti")


def attribute_violations(features: DataFrame, rules: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """RC3: rules ``(pattern, attribute, expected)``: a feature whose ``text_col``
    matches ``pattern`` must have ``attribute == expected``. ``features`` is long
    (id, text, attribute, value); the join is on the attribute (equi), the
    pattern is tested per matching row."""
    r = rules
    j = features.join(r, "attribute")
    bad = j.filter(F.expr(f"{text_col} rlike pattern") & ~F.col("value").eqNullSafe(F.col("expected")))
    return bad.select(id_col, "attribute", F.col("value").alias("actual"), "expected", "pattern")


def fk_report(child: DataFrame, child_name: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """RC4/RC5: child rows whose foreign key has no parent row, counted per value."""
    p = parent.select(F.col(pk).alias(fk))
    orphans = child.filter(F.col(fk).isNotNull()).join(p, fk, "left_anti")
    return orphans.groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(child_name).alias("child"), F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("value"), "n_rows")


def correct(df: DataFrame, corrections: Sequence[tuple[Column, str, Column]]) -> DataFrame:
    """RC6: conditional replacement: for each (condition, column, new value) the
    column takes the new value where the condition holds; adds ``corrected``."""
    changed = F.lit(False)
    out = df
    for cond, c, v in corrections:
        hit = cond & ~F.col(c).eqNullSafe(v)
        changed = changed | hit
        out = out.withColumn("_chg_" + c, hit).withColumn(c, F.when(cond, v).otherwise(F.col(c)))
    flags = [c for c in out.columns if c.startswith("_chg_")]
    any_change = F.lit(False)
    for f in flags:
        any_change = any_change | F.col(f)
    return out.withColumn("corrected", any_change).drop(*flags)


def dedupe_by_preference(df: DataFrame, keys: Sequence[str], preference: Sequence[str]) -> DataFrame:
    """RC6: one row per key, the first by ``preference`` columns (ascending)."""
    others = [c for c in df.columns if c not in keys]
    order = [*preference, *[c for c in others if c not in preference]]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in others])


def split_by_pattern(df: DataFrame, id_col: str, patterns: dict[str, str], default: str = "other") -> DataFrame:
    """RC7: class per id by substring patterns (first match wins), for a
    ``partitionBy("cable_class")`` export."""
    cls = None
    for name, pat in patterns.items():
        c = F.col(id_col).contains(pat)
        cls = F.when(c, F.lit(name)) if cls is None else cls.when(c, F.lit(name))
    return df.withColumn("cable_class", cls.otherwise(F.lit(default)) if cls is not None else F.lit(default))
