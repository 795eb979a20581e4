"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import cut_lineage, ensure_checkpoint_dir

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD_PATTERN", "block_ranks", "cut_lineage", "documents", "embeddings", "ensure_checkpoint_dir",
           "spread", "text_bytes", "word_count"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but space and 0x09-0x0D); null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: the one figure that sizes blocks and buckets."""
    return int(docs.select(F.sum(F.octet_length(F.col(text))).alias("b")).first()["b"] or 0)


def spread(spark: SparkSession, units: float, per_task: float) -> int:
    """Number of blocks of about ``per_task`` units each, at least one."""
    return max(1, int(-(-units // per_task)))


def block_ranks(rows: DataFrame, group: list[str], band: Column, order: list[Column], salt: Column,
                rank: str, rows_per_block: int = 1000) -> DataFrame:
    """``rows`` with ``rank`` = position (from 1, long) inside ``group``, ordered by
    (band, block, *order*).

    A window over a whole group would put a hot group into one task. Each (group, band) is cut into
    as many blocks as its row count asks for (``salt``, a long, deals rows to blocks); ranks are
    counted inside a block and shifted by the rows of the blocks before it, which is a window over
    one row per block. Nulls form groups of their own.
    """
    from pyspark.sql import Window

    keyed = rows.withColumn("_band", band).withColumn("_salt", salt)
    sized = keyed.groupBy(*group, "_band").agg(F.count(F.lit(1)).alias("_n"))
    sized = sized.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_band").alias("_b"),
                         F.ceil(F.col("_n") / F.lit(rows_per_block)).cast("long").alias("_parts"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_band").eqNullSafe(F.col("_b"))]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    keyed = keyed.join(sized, cond, "inner").withColumn("_block", F.pmod(F.col("_salt"), F.col("_parts")))
    keyed = keyed.drop("_b", "_parts", "_salt", *[f"_g{i}" for i in range(len(group))])
    blocks = keyed.groupBy(*group, "_band", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_band", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = blocks.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_band").alias("_b"),
                           F.col("_block").alias("_k"), "_shift")
    inside = Window.partitionBy(*group, "_band", "_block").orderBy(*order)
    keyed = keyed.withColumn("_r", F.row_number().over(inside))
    ranked = keyed.join(blocks, cond & (F.col("_block") == F.col("_k")), "inner")
    return ranked.withColumn(rank, (F.col("_shift") + F.col("_r")).cast("long")).drop(
        "_b", "_k", "_shift", "_r", "_band", "_block", *[f"_g{i}" for i in range(len(group))])
