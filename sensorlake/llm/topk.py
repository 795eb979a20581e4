"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import spread


def finite(vec: Column) -> Column:
    """True where a vector is not null and holds neither null nor non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & ~bad, F.lit(False))


def scaled(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v: integer components floor(scale * x) of the vectors that take part."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return vectors.filter(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select("vec_id", x.alias("v"))


class Postings:
    """Term -> (rows, weights) of a block of integer vectors; zero weights have no posting."""

    def __init__(self, vectors: list[np.ndarray]):
        sizes = np.array([len(v) for v in vectors], dtype=np.int64)
        weight = np.concatenate(vectors) if len(vectors) else np.zeros(0, dtype=np.int64)
        term = np.arange(len(weight)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row = np.repeat(np.arange(len(vectors)), sizes)
        live = weight != 0
        order = np.argsort(term[live], kind="stable")
        term, self.row, self.weight = term[live][order], row[live][order], weight[live][order]
        self.n, self.terms = len(vectors), int(term[-1]) + 1 if len(term) else 0
        self.at = np.searchsorted(term, np.arange(self.terms + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Dense scores of one query: each of its terms scatters its weighted postings."""
        out = np.zeros(self.n, dtype=np.int64)
        for t in np.flatnonzero(query[:self.terms]).tolist():
            a, b = self.at[t], self.at[t + 1]
            out[self.row[a:b]] += self.weight[a:b] * query[t]
        return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids: a partition, then a sort of what it selects."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= floor)  # with all ties at the edge
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, block: int = 2048,
          query_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products over all candidates.

    ``queries`` and ``candidates`` hold vec_id and v (array<long>, missing trailing components count as
    zero). Candidates are dealt by a hash of their id into blocks of about ``block`` rows, queries into
    blocks of about ``query_block``, and every pair of blocks is one group, so no group depends on the
    size of the whole. In a group each query accumulates its terms' postings into a dense score array,
    a partition selects its k best, and these are merged over blocks. A candidate with the query's own
    vec_id is left out. Ties go to the smaller vec_id; repeated rows stay separate candidates; fewer
    than k candidates give fewer rows; empty inputs give none. Scores are 64-bit integers.
    """
    spark = candidates.sparkSession
    blocks = spread(spark, candidates.count(), block)
    asks = spread(spark, queries.count(), query_block)

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    own = candidates.select(dealt(blocks).alias("block"), each(asks).alias("asks"), "vec_id", "v")
    asked = queries.select(each(blocks).alias("block"), dealt(asks).alias("asks"), "vec_id", "v")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.asarray(left["vec_id"].combine_chunks())
        postings = Postings(_rows(left["v"]))
        out_q, out_c, out_s = [], [], []
        for q, v in zip(np.asarray(right["vec_id"].combine_chunks()).tolist(), _rows(right["v"])):
            scores = postings.scores(v)
            other = np.flatnonzero(ids != q)
            at = other[best(scores[other], ids[other], k)]
            out_q.append(np.full(len(at), q, dtype=np.int64))
            out_c.append(ids[at])
            out_s.append(scores[at])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        return pa.table({"query_id": join(out_q), "vec_id": join(out_c), "score": join(out_s)})

    part = own.groupBy("block", "asks").cogroup(asked.groupBy("block", "asks")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rows(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Arrays of a list column's rows."""
    lists = column.combine_chunks()
    values, offsets = np.asarray(lists.values, dtype=np.int64), np.asarray(lists.offsets)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
