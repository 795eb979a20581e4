"""Mixing sources to target weights by systematic sampling (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import block_ranks, cut_lineage, word_count

CYCLE = (3, 1, 2)


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """Per source: total size, weight, target.

    ``sizes`` has ``source`` and ``size``. Sources in code-point order (null last) weigh ``cycle``,
    repeated. Targets share ``share`` times all sizes by weight; a target above ``max_repeat`` times
    its source's size is held there and the excess is shared again until none is above. The sources
    held are a prefix of the order by size per weight, so one running sum finds them: source k is held
    when the fill level left by the sources before it exceeds its own limit. One row per source; no
    step touches the documents again.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    per = per.withColumn("weight", weight)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = filled.rowsBetween(Window.unboundedPreceding, -1)
    left_size = F.lit(share) * F.sum("source_size").over(every) \
        - F.lit(max_repeat) * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    per = per.withColumn("_size", left_size).withColumn("_weight", left_weight)
    limit = F.lit(max_repeat) * F.col("source_size")
    per = per.withColumn("_held", F.col("_size") * F.col("weight") / F.col("_weight") >= limit)
    # the first source that is not held fixes the level of all that are not
    first = F.min(F.when(~F.col("_held"), F.struct(F.col("source_size") / F.col("weight"), "_size", "_weight"))).over(every)
    per = per.withColumn("_first", first)
    target = F.when(F.col("_held"), limit).otherwise(F.col("_first._size") * F.col("weight") / F.col("_first._weight"))
    return per.select("source", "source_size", "weight", target.cast("double").alias("target"))


def deal(doc_id: str, text: str) -> Column:
    """Number that deals a document to a block of ranks: 32 bits of the digest of its doc_id, or of its text."""
    named = F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, seed: int = 42, cycle: tuple[int, ...] = CYCLE, share: float = 1.5,
        max_repeat: float = 2.0, rows_per_block: int = 1000) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken: how often the mix takes each document.

    A document's expected copies are its source's target over the source's size. Inside a source the
    documents stand in order of size (bands of three leading digits), expected copies are
    prefix-summed, one offset per source (from ``seed`` and the source's name) is added, and a document
    is taken once for each integer its interval crosses. Systematic sampling along the sizes keeps the
    words taken within a few documents of the target. Ranks are counted in blocks, to which documents are
    dealt by a digest of their doc_id (of their text, where it is null).

    Null or empty text: size 0, counted and possibly taken, 0 words. Null source: a source of its own.
    Equal doc_ids stay separate rows. Sources without words: target 0, taken 0. Empty input: no rows.
    Only doc_id, text and source are read, so further columns cannot clash.
    """
    sized = cut_lineage(docs.select(  # texts are read once; their sizes serve every later step
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        deal("doc_id", "text").alias("_deal")))
    targets = source_targets(sized, cycle, share, max_repeat)
    digits = F.length(F.col("size").cast("string"))
    band = F.when(digits <= 3, F.col("size")).otherwise(
        F.col("size") - F.pmod(F.col("size"), F.pow(F.lit(10), digits - 3).cast("long")))
    ranked = block_ranks(sized, ["source"], band.cast("long"), [F.col("size"), F.col("doc_id")],
                         F.col("_deal"), "_rank", rows_per_block)
    targets = targets.withColumnRenamed("source", "_source").drop("weight")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source"), F.lit(""))).cast("binary"))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    crossed = F.floor(F.col("_offset") + F.col("_rate") * F.col("_rank")) \
        - F.floor(F.col("_offset") + F.col("_rate") * (F.col("_rank") - 1))
    return (ranked.join(targets, F.col("source").eqNullSafe(F.col("_source")), "inner").drop("_source")
            .withColumn("_rate", rate).withColumn("_offset", offset)
            .withColumn("copies", F.least(crossed.cast("long"), F.lit(int(max_repeat))))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, CAST(source AS VARCHAR) AS source,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 8))::BIGINT AS deal,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM per),
filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
            - 2.0::DOUBLE * coalesce(sum(source_size) OVER e, 0) AS left_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER e, 0) AS left_weight
  FROM weighed
  WINDOW e AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (SELECT *, left_size * weight / left_weight >= 2.0::DOUBLE * source_size AS held FROM filled),
level AS (
  SELECT left_size AS s, left_weight AS w FROM held WHERE NOT held ORDER BY source_size / weight LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN held THEN 2.0::DOUBLE * source_size
              ELSE (SELECT s FROM level) * weight / (SELECT w FROM level) END AS target FROM held),
banded AS (
  SELECT *, CASE WHEN length(size::VARCHAR) <= 3 THEN size
                 ELSE size - size % (10 ** (length(size::VARCHAR) - 3))::BIGINT END AS band FROM sized),
blocked AS (
  SELECT *, deal % ceil(count(*) OVER (PARTITION BY source, band) / 1000.0)::BIGINT AS block FROM banded),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, block, size, doc_id NULLS FIRST) AS r FROM blocked),
joined AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.r,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('42|' || coalesce(r.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(floor(u + rate * r) - floor(u + rate * (r - 1)), 2) * size)::BIGINT AS taken
FROM joined
"""
