"""Embedding near-duplicates by an inverted multi-index with exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage, spread
from sensorlake.llm.components import components
from sensorlake.llm.simhash import spanning_forest
from sensorlake.llm.topk import finite

#: Rows of one side compared in one piece.
PIECE = 2048


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_codebooks(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the two halves of unit vectors: k-means on each half by itself."""
    rng = np.random.default_rng(seed)
    books = []
    half = sample.shape[1] // 2
    for part in (sample[:, :half], sample[:, half:]):
        part = np.unique(part, axis=0)
        centres = part[rng.permutation(len(part))[:k]].copy()
        for _ in range(rounds):
            near = np.argmin(_distances(part, centres), axis=1)
            for c in range(len(centres)):
                mine = part[near == c]
                if len(mine):
                    centres[c] = mine.mean(axis=0)
        books.append(centres)
    return books[0], books[1]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1))


def cell_costs(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home centre, least squared distance from x to any point whose home is centre c) per row of x."""
    d = _distances(x, centres)
    home = np.argmin(d, axis=1)
    apart = np.sqrt(_distances(centres, centres))[home]
    gap = d - d[np.arange(len(x)), home][:, None]
    bound = np.maximum(0, gap / np.maximum(2 * apart, 1e-300)) ** 2
    bound[np.arange(len(x)), home] = 0
    return home, np.where(gap <= 0, 0, bound)


def visited(cost1: np.ndarray, cost2: np.ndarray, radius2: float) -> np.ndarray:
    """Cells (i, j) of the product grid in order of cost1[i] + cost2[j], up to ``radius2``.

    Multi-sequence traversal: both halves' costs are sorted and cells are taken off a front of next
    cells, nearest first. The sum bounds the distance to anything in a cell from below, so recall is
    complete when the front passes ``radius2``, the target here.
    """
    import heapq

    o1, o2 = np.argsort(cost1, kind="stable"), np.argsort(cost2, kind="stable")
    a, b = cost1[o1].tolist(), cost2[o2].tolist()
    front, out = [(a[0] + b[0], 0, 0)], []
    while front:
        cost, i, j = heapq.heappop(front)
        if cost > radius2:
            break
        out.append((o1[i], o2[j]))
        if j + 1 < len(b):
            heapq.heappush(front, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(front, (a[i + 1] + b[0], i + 1, 0))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, codes: int = 16, sample_rows: int = 20_000,
                    piece: int = PIECE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector.

    Vectors of equal, non-null label link at cosine >= ``threshold``, verified in double precision.
    Exact copies (same label and components) are one class, represented by its smallest vec_id, and cost
    one row from there on. The index: codebooks of ``codes`` centres for each half of the unit vectors,
    fitted on at most about ``sample_rows`` rows; every row stands in the cell of its two centres. A row
    asks the cells that the multi-sequence traversal visits until nothing within the threshold's
    distance can be missed; the bound is exact, so recall is 1. It travels once to each first centre it
    visits, with the list of second ones. The rows of a first centre are cut into pieces of ``piece``,
    and so are their askers; a task compares one piece with one, cell by cell. Links are counted there
    and leave the task as a spanning forest.

    Null, zero and non-finite vectors, null labels: n_links 0, a component of their own. A null vec_id
    keeps its row and links like any other, but never names a component that has another. Vectors of
    different length never link. Empty input: no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("e"))
    live = finite(F.col("e")) & F.col("label").isNotNull() & F.coalesce(F.exists("e", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("live", F.coalesce(live, F.lit(False)))
    classes = (rows.filter("live").groupBy("label", "e").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    classes = cut_lineage(classes.withColumn("c", F.xxhash64("label", "e")))
    total = classes.count()
    if total:
        links = _links(classes, threshold, codes, sample_rows, piece, total)
        counted = links.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("n_other"))
        edges = links.filter(F.col("b").isNotNull()).select("a", "b")
        member = components(edges)
        named = classes.select("c", "rep", F.col("n").alias("copies"), F.col("label").alias("l"), F.col("e").alias("v"))
        named = named.join(counted, F.col("c") == F.col("a"), "left").join(member, F.col("c") == F.col("node"), "left")
        named = named.withColumn("root", F.coalesce("root", "c"))
        least = named.groupBy("root").agg(F.min("rep").alias("least")).withColumnRenamed("root", "r")
        named = named.join(least, F.col("root") == F.col("r")).select(
            "l", "v", "least", (F.col("copies") - 1 + F.coalesce("n_other", F.lit(0))).alias("links"))
        found = rows.join(named, F.col("live") & (F.col("label") == F.col("l")) & (F.col("e") == F.col("v")), "left")
    else:
        found = rows.withColumn("links", F.lit(None).cast("long")).withColumn("least", F.lit(None).cast("long"))
    component = F.coalesce(F.col("least"), F.col("vec_id"))
    return found.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _links(classes: DataFrame, threshold: float, codes: int, sample_rows: int, piece: int, total: int) -> DataFrame:
    """Rows (a, null, n): class a has n vectors of other classes linked in one piece; rows (a, b): a
    spanning forest of the links found in one piece."""
    spark = classes.sparkSession
    radius2 = 2.0 - 2.0 * threshold + 1e-9
    kinds = classes.select(F.size("e").alias("d")).groupBy("d").count().orderBy(F.col("count").desc(), "d").limit(1).first()
    share = min(1.0, sample_rows / total)
    sample = (classes.filter((F.size("e") == kinds["d"]) & (F.pmod(F.col("c"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)))
              .select("e").toArrow())
    width = int(kinds["d"])
    books = fit_codebooks(_unit(_matrix(sample["e"].combine_chunks(), width)), codes) if len(sample) and width > 1 else None

    def index(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(np.asarray(lists.offsets))
            home = np.zeros((len(sizes), 2), dtype=np.int32)
            asks = [[(0, [0])]] * len(sizes)
            usual = np.flatnonzero(sizes == width) if books else np.zeros(0, dtype=np.int64)
            if len(usual):
                x = _unit(_matrix(lists.take(pa.array(usual)), width))
                half = width // 2
                home[usual, 0], c1 = cell_costs(x[:, :half], books[0])
                home[usual, 1], c2 = cell_costs(x[:, half:], books[1])
                for i, a, b in zip(usual.tolist(), c1, c2):
                    cells = visited(a, b, radius2)
                    asks[i] = [(f, cells[cells[:, 0] == f, 1].tolist()) for f in np.unique(cells[:, 0]).tolist()]
            of = pa.list_(pa.struct([("first", pa.int32()), ("second", pa.list_(pa.int32()))]))
            rows = pa.array([[{"first": f, "second": g} for f, g in r] for r in asks], of)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home[:, 0]), pa.array(home[:, 1]), rows],
                                             names=["c", "e", "label", "n", "first", "second", "asks"])

    label, vector = (classes.schema[c].dataType.simpleString() for c in ("label", "e"))
    placed = cut_lineage(classes.select("c", "e", "label", "n").mapInArrow(
        index, f"c long, e {vector}, label {label}, n long, first int, second int, "
               "asks array<struct<first:int,second:array<int>>>"))
    standing = placed.select("label", "first", "second", "c", "e", "n")
    asking = placed.select("label", F.explode("asks").alias("ask"), "c", "e").select(
        "label", F.col("ask.first").alias("first"), F.col("ask.second").alias("cells"), "c", "e")
    stand = standing.groupBy("label", "first").agg(F.count(F.lit(1)).alias("rows"))
    asked = asking.groupBy("label", "first").agg(F.count(F.lit(1)).alias("asked"))
    sizes = stand.join(asked, ["label", "first"]).select(
        F.col("label").alias("l"), F.col("first").alias("f"), F.ceil(F.col("rows") / piece).cast("int").alias("parts"),
        F.ceil(F.col("asked") / piece).cast("int").alias("ask_parts"))
    sizes = cut_lineage(sizes)
    split = lambda n: F.pmod(F.xxhash64("c"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    same = (F.col("label") == F.col("l")) & (F.col("first") == F.col("f"))
    keys = ["label", "first", "i", "j"]
    left = standing.join(sizes, same).withColumn("i", split("parts")).withColumn("j", each("ask_parts"))
    right = asking.join(sizes, same).withColumn("j", split("ask_parts")).withColumn("i", each("parts"))
    left = left.select(*keys, "second", "c", "e", "n")
    right = right.select(*[F.col(c).alias(c) for c in (*keys, "cells", "c", "e")])  # columns of its own

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        c1, c2 = (np.asarray(t["c"].combine_chunks(), dtype=np.int64) for t in (one, two))
        n, cell = (np.asarray(one[c].combine_chunks(), dtype=np.int64) for c in ("n", "second"))
        e1, e2, asks = one["e"].combine_chunks(), two["e"].combine_chunks(), two["cells"].combine_chunks()
        s1, s2 = np.diff(np.asarray(e1.offsets)), np.diff(np.asarray(e2.offsets))
        who, where = np.repeat(np.arange(len(c2)), np.diff(np.asarray(asks.offsets))), np.asarray(asks.flatten())
        nodes = np.unique(np.concatenate([c1, c2]))
        at1, at2 = np.searchsorted(nodes, c1), np.searchsorted(nodes, c2)
        links, label = np.zeros(len(c2), dtype=np.int64), np.arange(len(nodes))
        for k, d in np.unique(np.stack([cell, s1], axis=1), axis=0).tolist():
            r1, r2 = np.flatnonzero((cell == k) & (s1 == d)), who[where == k]
            r2 = r2[s2[r2] == d]
            if not len(r2) or not d:
                continue
            x1, x2 = (_unit(_matrix(e.take(pa.array(r)), d)) for e, r in ((e1, r1), (e2, r2)))
            for begin in range(0, len(r2), 512):
                q, p = np.nonzero(x2[begin:begin + 512] @ x1.T >= threshold)
                q, p = r2[begin + q], r1[p]
                other = c2[q] != c1[p]
                q, p = q[other], p[other]
                links += np.bincount(q, weights=n[p], minlength=len(c2)).astype(np.int64)
                spanning_forest(label, at2[q], at1[p])
        some, linked = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(nodes)))
        a = np.concatenate([c2[some], nodes[linked]])
        b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(nodes[label[linked]])])
        return pa.table({"a": pa.array(a), "b": b, "n": pa.array(np.concatenate([links[some], np.zeros(len(linked), dtype=np.int64)]))})

    return cut_lineage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a long, b long, n long"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, width)


NEAR_SQL = """
WITH RECURSIVE u AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
live AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM u
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM live a JOIN live b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM u
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.a = c.vec_id
"""
