import random

from sensorlake.operators.intervals import intersect_members, overlap_join


def test_overlap_join_matches_brute_force(spark):
    rnd = random.Random(3)
    left, right = [], []
    for i in range(150):
        s = rnd.randint(0, 100_000)
        ln = rnd.choice([0, 5, 60, 600, 5000, 90_000])  # short and very long intervals
        left.append((rnd.randint(0, 2), i, s, s + ln))
    for j in range(150):
        s = rnd.randint(0, 100_000)
        ln = rnd.choice([0, 30, 300, 20_000])
        right.append((rnd.randint(0, 2), j, s, s + ln))
    L = spark.createDataFrame(left, "k int, li int, ls long, le long")
    R = spark.createDataFrame(right, "k int, ri int, rs long, re long")
    got = sorted((r.k, r.li, r.ri, r.start_time, r.end_time)
                 for r in overlap_join(L, R, ["k"], "ls", "le", "rs", "re", base=100, fanout=4).collect())
    exp = sorted((a[0], a[1], b[1], max(a[2], b[2]), min(a[3], b[3]))
                 for a in left for b in right if a[0] == b[0] and a[2] <= b[3] and b[2] <= a[3])
    assert got == exp


def test_overlap_of_three_is_empty(spark):
    rows = [(1, 1, 1, 9), (1, 2, 2, 4), (1, 3, 6, 8)]
    df = spark.createDataFrame([(r, c, s, e, 3) for r, c, s, e in rows],
                               "rule_id int, condition_id int, start_time long, end_time long, n int")
    assert intersect_members(df, ["rule_id"], "condition_id", "n").count() == 0


def test_and_of_two_members(spark):
    rows = [(1, 1, 0, 10), (1, 1, 20, 30), (1, 2, 5, 25)]
    df = spark.createDataFrame([(r, c, s, e, 2) for r, c, s, e in rows],
                               "rule_id int, condition_id int, start_time long, end_time long, n int")
    for chunk in (3, 86400):
        got = sorted((r.start_time, r.end_time) for r in
                     intersect_members(df, ["rule_id"], "condition_id", "n", chunk=chunk).collect())
        assert got == [(5, 10), (20, 25)]


def test_overlap_join_auto_grid(spark):
    left = [(1, i, i * 50, i * 50 + (i % 7) * 40) for i in range(60)]
    right = [(1, j, j * 35 + 3, j * 35 + 3 + (j % 5) * 90) for j in range(80)]
    L = spark.createDataFrame(left, "k int, li int, ls long, le long")
    R = spark.createDataFrame(right, "k int, ri int, rs long, re long")
    got = sorted((r.li, r.ri) for r in overlap_join(L, R, ["k"], "ls", "le", "rs", "re", base="auto").collect())
    exp = sorted((a[1], b[1]) for a in left for b in right if a[2] <= b[3] and b[2] <= a[3])
    assert got == exp


def test_overlap_candidates_grow_with_the_pairs(spark):
    """Sparse intervals with one very long one: join rows stay near the pairs, not their square."""
    made = {}
    for n in (500, 1000, 2000):
        left = [(1, i, i * 10_000, i * 10_000 + 50) for i in range(n)] + [(1, -1, 0, 3_000)]
        right = [(1, i, i * 10_000 + 20, i * 10_000 + 90) for i in range(n)]
        L = spark.createDataFrame(left, "k int, li int, ls long, le long")
        R = spark.createDataFrame(right, "k int, ri int, rs long, re long")
        df = overlap_join(L, R, ["k"], "ls", "le", "rs", "re", base=60)
        assert df.count() == n + 1
        plan = df._jdf.queryExecution()
        df.collect()
        rows = _join_rows(plan.executedPlan())
        made[n] = rows
    assert made[2000] <= 6 * made[500] and made[2000] <= 40 * 2001


def _join_rows(node):
    """Output rows of the joins on cells in an executed plan."""
    total, todo = 0, [node]
    while todo:
        x = todo.pop()
        name = x.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(x.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(x.plan())
            continue
        if "Join" in name and "_lbin" in x.verboseStringWithOperatorId():
            total += x.metrics().apply("numOutputRows").value()
        kids = x.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total
