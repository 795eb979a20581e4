import random

from pyspark.sql import functions as F

from sensorlake.operators.islands import islands


def _brute(points, limit):
    pts = sorted(points)
    out, s, prev = [], None, None
    for t in pts:
        if prev is None or t - prev > limit:
            if s is not None:
                out.append((s, prev))
            s = t
        prev = t
    if s is not None:
        out.append((s, prev))
    return out


def test_islands_fixture(spark):
    df = spark.createDataFrame([(1, t) for t in [1, 2, 3, 10, 11]], "k int, t long")
    got = sorted((r.start_time, r.end_time) for r in islands(df, ["k"], "t", 1, duration=2, lo=0, hi=100).collect())
    assert got == [(1, 3)]
    got = sorted((r.start_time, r.end_time) for r in islands(df, ["k"], "t", 1, duration=2, lo=0, hi=11).collect())
    assert got == [(1, 3), (10, 11)]


def test_islands_across_chunks_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(3):
        t = 0
        for _ in range(300):
            t += rnd.choice([1, 1, 2, 3, 9, 30])
            rows.append((k, t))
            if rnd.random() < 0.1:
                rows.append((k, t))  # duplicate time
    df = spark.createDataFrame(rows, "k int, t long")
    for chunk in (7, 50, 100000):
        got = sorted((r.k, r.start_time, r.end_time) for r in islands(df, ["k"], "t", 4, chunk=chunk).collect())
        exp = sorted((k, s, e) for k in range(3) for s, e in _brute([t for kk, t in rows if kk == k], 4))
        assert got == exp, chunk


def test_islands_disjoint_and_ordered(spark):
    rows = [(1, t) for t in range(0, 500, 3)] + [(1, t) for t in range(600, 700)]
    out = sorted((r.start_time, r.end_time) for r in islands(spark.createDataFrame(rows, "k int, t long"),
                                                              ["k"], "t", 5, chunk=64).collect())
    for (s1, e1), (s2, e2) in zip(out, out[1:]):
        assert s1 <= e1 < s2 <= e2


def test_islands_with_many_duplicate_times(spark):
    rows = [(1, t) for t in (5, 5, 5, 6, 6, 20, 20, 21, 40)] * 3
    df = spark.createDataFrame(rows, "k int, t long").repartition(3)
    for chunk in (1, 7, 86400):
        got = sorted((r.start_time, r.end_time) for r in islands(df, ["k"], "t", 2, chunk=chunk).collect())
        assert got == [(5, 6), (20, 21), (40, 40)], chunk


def test_islands_with_a_long_int_limit(spark):
    """A plain int limit of over a day, on a series longer than its cells: same as brute force, no overflow."""
    rows = [(1, t * 40_000) for t in range(50)] + [(1, 50 * 40_000 + 200_000)]
    df = spark.createDataFrame(rows, "k int, t long")
    got = sorted((r.start_time, r.end_time) for r in islands(df, ["k"], "t", 86_399).collect())
    assert got == _brute([t for _, t in rows], 86_399)


def test_islands_need_two_shuffles(spark):
    df = spark.createDataFrame([(1, 1)], "k int, t long")
    plan = islands(df, ["k"], "t", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_islands_of_many_hits_use_all_tasks(spark):
    """hits that compress to little are still sorted in the fixed number of tasks, not merged into one."""
    hits = spark.range(200_000).selectExpr("cast(id % 50 AS int) AS rule_id", "id % 7 AS asset_id", "id AS t")
    out = islands(hits, ["rule_id", "asset_id"], "t", 349, chunk=3600)
    assert out.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = {(r.rule_id, r.asset_id): (r.start_time, r.end_time) for r in islands(hits, ["rule_id", "asset_id"], "t", 350, chunk=3600).collect()}
    assert len(rows) == 350 and all(b - a > 199_000 for a, b in rows.values())
    assert out.count() == 200_000
