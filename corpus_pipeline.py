"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of documents (doc_id, text, lang, source, n_chars). ``run`` writes each stage's result as
Parquet to the shared checkpoint folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm import language, mixing, packing, simhash, suffix_dedup
from sensorlake.llm.common import cut_lineage, documents
from sensorlake.llm.tokens import tokenizer_path
from sensorlake.session import share_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE, MAX_BITS = 4, 4
MATCH_BYTES = 50
MAX_TOKENS = 1024


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``lang`` becomes the predicted one.

    Learned from the stage's own labelled documents. Rejected: text null or without letters. A text of
    several languages stays, whatever their shares; its ``lang`` is the one with the largest. With no
    labelled document at all nothing can be predicted, and all documents with letters stay as they are.
    """
    model = language.train(docs)
    if not model[0]:
        return docs.filter(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    kept = language.identify(docs, model, keep_columns=COLUMNS)
    kept = kept.filter(F.col("lang_pred") != language.UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one that names the component.

    Rows that repeat its doc_id and text stay once. Rows without a doc_id are grouped among themselves
    and one of each group stays; they neither link nor remove rows that have one, nor are removed by them.
    """
    found = simhash.near_duplicates(docs.filter(F.col("doc_id").isNotNull()), SHINGLE, MAX_BITS)
    named = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept"))
    kept = docs.join(named, F.col("doc_id") == F.col("_kept"), "left_semi").select(*COLUMNS)
    if found.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "text"])
    unnamed = docs.filter(F.col("doc_id").isNull()).select(*COLUMNS)
    return kept.unionByName(one_of_each(unnamed)) if unnamed.limit(1).count() else kept


def one_of_each(unnamed: DataFrame) -> DataFrame:
    """One row of each near-duplicate group of rows without a doc_id, which their texts' digests name."""
    single = unnamed.withColumn("_name", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["_name"])
    single = cut_lineage(single)
    found = simhash.near_duplicates(single.select(F.col("_name").alias("doc_id"), "text"), SHINGLE, MAX_BITS)
    named = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept"))
    return single.join(named, F.col("_name") == F.col("_kept"), "left_semi").select(*COLUMNS)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat a smaller doc_id's 50-byte strings."""
    cleaned = suffix_dedup.remove_repeats(docs, MATCH_BYTES, with_text=True, carry=("lang", "source"))
    return cleaned.withColumn("text", F.col("kept_text")).withColumn(
        "n_chars", F.length("kept_text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (a document taken twice is two rows).

    Rows that share doc_id, source and size take the copies of those rows in turn.
    """
    def key(size):
        parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), size.cast("string"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))]
        return F.concat_ws("|", *parts)

    copies = mixing.mix(docs).select(key(F.col("size")).alias("_key2"), "copies")
    copies = copies.groupBy("_key2").agg(F.sort_array(F.collect_list("copies")).alias("_copies")).filter("_copies[size(_copies) - 1] > 0")
    keyed = docs.select(*COLUMNS, key(mixing.word_count(F.col("text"))).alias("_key"))
    keyed = keyed.withColumn("_turn", F.row_number().over(Window.partitionBy("_key").orderBy("text")))
    taken = keyed.join(copies, F.col("_key") == F.col("_key2"), "inner").withColumn("_n", F.element_at("_copies", F.col("_turn")))
    return taken.filter("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix's documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), MAX_TOKENS)


def stage(function):
    """A stage whose Python workers find this package."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        share_package(spark)
        return function(spark, docs, sf_dir)
    return run_stage


STAGES = [
    ("language_id", stage(language_stage)),
    ("simhash_near_dedup", stage(simhash_stage)),
    ("suffix_array_dedup", stage(suffix_stage)),
    ("source_mixing", stage(mixing_stage)),
    ("best_fit_packing", stage(packing_stage)),
]

#: Language mixtures, XXH64 fingerprints and token ids cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table of documents; the last stage's rows."""
    docs = documents(spark, sf_dir)
    for _, function in STAGES[:-1]:
        docs = cut_lineage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
