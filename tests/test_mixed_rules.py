"""AND across rule kinds, and threshold ladders, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from sensorlake.plans import ladder
from sensorlake.plans import rules as ru
from sensorlake.session import local_frame

OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
       "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


@pytest.mark.parametrize("rungs", [1, 3, 1024])
def test_ladder_equals_every_pair(spark, rungs):
    rng = random.Random(rungs)
    rules = [(i, 1, rng.choice("ab"), rng.choice(list(OPS)), rng.choice([None, 1.0, 2.0, 2.0, 3.5, -4.0, 9.0])) for i in range(60)]
    rules.append((99, 1, "a", "~", 1.0))
    series = [(i, rng.choice("abc"), rng.choice([None, -5.0, 1.0, 2.0, 2.5, 9.0, 10.0])) for i in range(200)]
    r = local_frame(spark, rules, "rule_id int, condition_id int, key string, operator string, threshold double")
    s = local_frame(spark, series, "n int, key string, value double")
    got = ladder.passing(s, r, "key", "value", ("rule_id", "condition_id"), rungs).select("n", "rule_id").collect()
    want = [(n, i) for n, k, v in series for i, _, key, op, t in rules
            if key == k and v is not None and t is not None and op in OPS and OPS[op](v, t)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_rows_leaving_the_ladder_are_the_hits(spark):
    """No operator of the plan holds more rows than readings x ladders or the hits."""
    rules = local_frame(spark, [(i, 1, "a", ">", float(i)) for i in range(1000)],
                        "rule_id int, condition_id int, key string, operator string, threshold double")
    series = spark.range(1000).select(F.lit("a").alias("key"), (F.col("id") % 10).cast("double").alias("value"))
    hits = ladder.passing(series, rules, "key", "value", ("rule_id",))
    assert hits.count() == sum(range(10)) * 100
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Cartesian" not in hits._jdf.queryExecution().executedPlan().toString()


def _conditions(spark, rows, end):
    c = local_frame(spark, rows, "rule_id int, condition_id int, asset_id long, parameter string, function string, operator string, "
                                 "threshold double, duration long, data_frequency long, join_condition string")
    return c.withColumn("start_time", F.lit(0).cast("long")).withColumn("end_time", F.lit(end).cast("long"))


def _plain(rows, conditions, end, mode):
    """Anomalies of AND rules per asset: members' sets of closed spans, intersected second by second."""
    out = set()
    for rule in {c[0] for c in conditions}:
        own = [c for c in conditions if c[0] == rule]
        for asset in {r[0] for r in rows}:
            spans = []
            for _, _, _, tag, kind, op, limit, duration, frequency, _ in own:
                hit = sorted({t for a, p, t, v in rows if a == asset and p == tag and OPS[op](v, limit)})
                if kind == "magnitude":
                    found = [(t, t) for t in hit]
                elif kind == "raw":
                    found, gap = [], 2 * frequency - 1
                    for t in hit:
                        if found and t - found[-1][1] <= gap:
                            found[-1] = (found[-1][0], t)
                        else:
                            found.append((t, t))
                    found = [(s, e) for s, e in found if e - s >= duration or e == end]
                else:
                    cells = [t // duration for a, p, t, _ in rows if a == asset and p == tag]
                    found = [(g * duration, (g + 1) * duration) for g in sorted(set(cells)) if OPS[op](cells.count(g), limit)]
                spans.append(found)
            if mode == "exact":
                out |= {(rule, asset, s, e) for s, e in set(spans[0]).intersection(*spans[1:])}
                continue
            held = set(range(-1, 2 * end))
            for found in spans:
                held &= {t for s, e in found for t in range(s, e + 1)}
            for t in sorted(held):
                if t - 1 not in held:
                    e = t
                    while e + 1 in held:
                        e += 1
                    out.add((rule, asset, t, e))
    return out


@pytest.mark.parametrize("mode", ["overlap", "exact"])
@pytest.mark.parametrize("seed", [1, 2])
def test_and_across_kinds(spark, mode, seed):
    rng = random.Random(seed)
    end = 400
    rows = [(rng.randrange(2), rng.choice("pqe"), rng.randrange(0, end, 10), rng.choice([1.0, 5.0, 9.0])) for _ in range(250)] + [(0, "p", end, 1.0)]
    conditions = [
        (1, 1, None, "p", "raw", ">", 4.0, 0, 10, "and"), (1, 2, None, "e", "count", ">=", 2.0, 40, 10, "and"),
        (2, 1, None, "q", "magnitude", ">", 6.0, 0, 10, "and"), (2, 2, None, "e", "count", ">=", 1.0, 30, 10, "and"),
        (3, 1, None, "p", "raw", ">=", 1.0, 10, 10, "and"), (3, 2, None, "q", "magnitude", "<", 6.0, 0, 10, "and"),
        (3, 3, None, "e", "count", "<=", 3.0, 50, 10, "and"), (3, 4, None, "q", "count", ">", 0.0, 20, 10, "and"),
        (4, 1, None, "p", "raw", ">", 4.0, 0, 10, "and"), (4, 2, None, "q", "count", ">=", 1.0, 10, 10, "and")]
    readings = local_frame(spark, [(*r, None) for r in rows], "asset_id long, parameter string, epoch long, value double, k int")
    got = ru.evaluate(readings, _conditions(spark, conditions, end), mode).collect()
    want = _plain(rows, conditions, end, mode)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    if mode == "overlap":
        assert {w[0] for w in want} == {1, 2, 3, 4}
    else:
        assert 4 in {w[0] for w in want}


def test_mixed_and_over_explicit_assets(spark):
    rows = [(1, "p", t, 9.0, None) for t in range(0, 100, 10)] + [(2, "e", 55, 1.0, None), (2, "e", 125, 1.0, None)]
    readings = local_frame(spark, rows, "asset_id long, parameter string, epoch long, value double, k int")
    c = _conditions(spark, [(5, 1, 1, "p", "raw", ">", 5.0, 0, 10, "and"), (5, 2, 2, "e", "count", ">=", 1.0, 50, 10, "and")], 200)
    assert [tuple(r) for r in ru.evaluate(readings, c).collect()] == [(5, None, 50, 90)]


def test_large_rule_tables_give_the_same(spark, monkeypatch):
    """Rules that are not made local rows (a large rule table) take the distributed path."""
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice("pqe"), rng.randrange(0, 300, 10), rng.choice([1.0, 5.0, 9.0]), None) for _ in range(200)]
    readings = local_frame(spark, rows, "asset_id long, parameter string, epoch long, value double, k int")
    c = _conditions(spark, [(1, 1, None, "p", "raw", ">", 4.0, 0, 10, "and"), (1, 2, None, "e", "count", ">=", 2.0, 40, 10, "and"),
                            (2, 1, None, "q", "avg", "<", 6.0, 30, 10, "or"), (3, 1, 1, "q", "magnitude", ">", 4.0, 0, 10, "or")], 300)
    small = sorted(map(repr, ru.evaluate(readings, c).collect()))
    monkeypatch.setattr(ru, "SMALL_BYTES", -1)
    assert sorted(map(repr, ru.evaluate(readings, c).collect())) == small and small
