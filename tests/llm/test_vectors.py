"""Operators over vectors against plain versions."""

import math
import random

import llm_plain as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import embed_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_vectors(seed=1, n=300, width=8):
    rng = np.random.default_rng(seed)
    rows = []
    base = rng.normal(size=(20, width))
    for i in range(n):
        v = base[i % 20] + rng.normal(scale=0.08, size=width) * rng.integers(0, 3)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * width, 1), (n + 3, [math.nan] + [1.0] * (width - 1), 1),
             (n + 4, [math.inf] + [1.0] * (width - 1), 1), (n + 5, [None] + [1.0] * (width - 1), 1), (n + 6, rows[0][1], None),
             (n + 7, rows[0][1], 0), (n + 8, rows[0][1], 0), (n + 9, [2 * x for x in rows[0][1]], 0), (n + 10, [1.0, 2.0], 0),
             (None, rows[3][1], 0), (5, rows[5][1], 2)]
    return rows


def live(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("c", "e", "first", "block", "n", "score"):
        df = df.withColumn(extra, F.lit(1))
    return rows, df


@pytest.mark.parametrize("block", [40, 5000])
def test_top_k(vectors, block):
    rows, df = vectors
    scaled = topk.scaled(df)
    got = topk.top_k(scaled.filter("vec_id % 50 = 0"), scaled, 10, block).collect()
    v = [(i, [math.floor(1024 * x) for x in e]) for i, e, _ in rows if i is not None and live(e)]
    want = []
    for q, a in v:
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:10]
            want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_queries_in_blocks(vectors):
    """Queries dealt into many small blocks give the same rows as one block."""
    _, df = vectors
    scaled = topk.scaled(df)
    queries = scaled.filter("vec_id % 10 = 0")
    one = topk.top_k(queries, scaled, 10, 40, 100_000).collect()
    many = topk.top_k(queries, scaled, 10, 40, 5).collect()
    assert len(one) > 50 and sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_top_k_few_and_none(spark):
    two = topk.scaled(spark.createDataFrame([(0, [0.5, -0.25], 0), (3, [1.0], 0)], SCHEMA))
    assert [tuple(r) for r in topk.top_k(two.filter("vec_id = 0"), two).collect()] == [(0, 1, 3, 512 * 1024)]
    none = topk.scaled(spark.createDataFrame([], SCHEMA))
    assert topk.top_k(none, none).count() == 0


def plain_links(rows, threshold):
    def linked(i, j):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if la is None or la != lb or not live(a) or not live(b) or len(a) != len(b) or not any(a) or not any(b):
            return False
        a, b = np.array(a), np.array(b)
        return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)) >= threshold
    n = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    root = brute.groups(len(rows), linked)
    least = {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(rows[k][0], n[k], least.get(r), rows[k][0] is not None and rows[k][0] == least.get(r)) for k, r in enumerate(root)]


@pytest.mark.parametrize("codes,piece", [(4, 2048), (16, 7)])
def test_near_vectors(vectors, codes, piece):
    rows, df = vectors
    got = embed_dedup.near_duplicates(df, 0.98, codes=codes, piece=piece).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(plain_links(rows, 0.98), key=order)


def test_near_vectors_empty(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [0.0], 1), (3, [1.0], None)], SCHEMA)
    assert sorted(map(tuple, embed_dedup.near_duplicates(bad).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_traversal_order_and_bound():
    rng = random.Random(3)
    for _ in range(50):
        a, b = ([rng.random() for _ in range(rng.randint(1, 6))] for _ in range(2))
        cells = embed_dedup.visited(np.array(a), np.array(b), 0.9)
        cost = [a[i] + b[j] for i, j in cells]
        assert cost == sorted(cost) and len({tuple(c) for c in cells.tolist()}) == len(cells)
        assert len(cells) == sum(x + y <= 0.9 for x in a for y in b)


def test_cell_cost_is_a_lower_bound():
    rng = np.random.default_rng(2)
    centres, x, y = rng.normal(size=(6, 4)), rng.normal(size=(60, 4)), rng.normal(size=(60, 4))
    _, cost = embed_dedup.cell_costs(x, centres)
    home, _ = embed_dedup.cell_costs(y, centres)
    assert (((x[:, None] - y[None]) ** 2).sum(axis=2) >= cost[:, home] - 1e-9).all()


@pytest.mark.parametrize("name", ["op1_exact_topk", "op2_substring_dedup", "op4_embedding_near_dedup", "op10_source_mixing"])
def test_registered_queries_match_sql(spark, name):
    import duckdb

    from sensorlake.llm.catalog import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    rows = lambda rs: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rs)
    assert rows(map(tuple, got.select(*cols).collect())) == rows(want.fetchall())
