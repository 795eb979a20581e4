"""Scalar column helpers (projection / filter building blocks, PJ*).

All helpers return ``Column`` expressions built from Spark built-ins so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Comparison operators accepted in rule documents.
OPERATORS = (">", "<", ">=", "<=", "==", "!=")

# Timestamp text patterns tried, in this order, by ``parse_epoch``.
TIME_PATTERNS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyy-dd-MM", "dd-MMM-yyyy")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c, dtype: DataType | None = None) -> Column:
    """Whole epoch seconds (floor) of a timestamp column.

    ``timestamp_ntz`` values are read as UTC wall time without depending on the
    session time zone; ``timestamp`` values use ``unix_seconds``.
    """
    c = col(c)
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_seconds(c.cast("timestamp"))


def bucket_floor(ts, n) -> Column:
    """Bucket start ``ts - pmod(ts, n)`` (PJ7); equals ``floor(ts/n)*n`` for every ts."""
    ts = col(ts)
    n = n if isinstance(n, Column) else F.lit(int(n))
    return ts - F.pmod(ts, n)


def compare(value, op, threshold) -> Column:
    """Operator dispatch ``value <op> threshold`` (PJ10).

    ``op`` may be a Python string (resolved at plan time) or a string column
    (one CASE expression; unknown operators give null, i.e. no hit).
    """
    value, threshold = col(value), threshold if isinstance(threshold, Column) else F.lit(threshold)
    table = {
        ">": value > threshold, "<": value < threshold, ">=": value >= threshold,
        "<=": value <= threshold, "==": value == threshold, "=": value == threshold,
        "!=": value != threshold, "<>": value != threshold,
    }
    if isinstance(op, str):
        if op not in table:
            raise ValueError(f"unknown operator {op!r}; expected one of {OPERATORS}")
        return table[op]
    expr = None
    for sym, cond in table.items():
        expr = F.when(op == sym, cond) if expr is None else expr.when(op == sym, cond)
    return expr


def scale_units(value, tag, factors: dict[str, float]) -> Column:
    """Conditional unit scaling per tag (PJ5): ``value * factors[tag]`` else value."""
    value, tag = col(value), col(tag)
    expr = None
    for t, f in factors.items():
        expr = F.when(tag == t, value * F.lit(f)) if expr is None else expr.when(tag == t, value * F.lit(f))
    return value if expr is None else expr.otherwise(value)


def parse_epoch(text, patterns=TIME_PATTERNS) -> Column:
    """Epoch seconds from text trying several patterns (PJ6); null when none fits."""
    text = col(text)
    return F.unix_timestamp(F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns]))


def normalise(c, mapping: dict[str, str]) -> Column:
    """Name normalisation through a literal map (PJ9); unmapped names kept."""
    c = col(c)
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[F.lower(F.trim(c))], c)


def pct_change(current, baseline, absolute: bool = True) -> Column:
    """Percentage change vs baseline (PJ14, S4): null when the baseline is 0.

    ``absolute=True`` is the gauge/flow form ``abs(%)``; ``False`` is the signed
    fibre form.
    """
    current, baseline = col(current), col(baseline)
    pct = F.try_divide(current - baseline, baseline) * 100
    return F.abs(pct) if absolute else pct


def zfill(c, width: int = 18) -> Column:
    """Left pad with zeros to ``width``; longer strings are kept whole (PJ11)."""
    c = col(c).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def nonzero_traffic(a, b) -> Column:
    """Rows where either of two measures is non-zero (PJ15)."""
    return (F.coalesce(col(a), F.lit(0)) != 0) | (F.coalesce(col(b), F.lit(0)) != 0)
