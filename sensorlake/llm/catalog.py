"""Registered queries of the training-data operators, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import conversations, embed_dedup, harmonic, language, mixing, packing, periodic, simhash, substring, suffix_dedup, token_counts, token_files, topk
from sensorlake.llm.common import documents, embeddings, ensure_checkpoint_dir
from sensorlake.llm.tokens import tokenizer_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_exact_topk", topk.TOP_K_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best by integer inner product for the vec_ids divisible by 100, against all rows."""
    rows = topk.scaled(embeddings(spark, sf_dir))
    return topk.top_k(rows.filter(F.col("vec_id") % 100 == 0), rows, k=10)


@query("op2_substring_dedup", substring.REPEATS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by 13-word windows that start in a smaller doc_id, removed from every document."""
    return substring.remove_repeats(documents(spark, sf_dir), window=13)


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the three quarters that are not held out."""
    docs = documents(spark, sf_dir)
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.identify(docs, model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_langs")


@query("op4_embedding_near_dedup", embed_dedup.NEAR_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine >= 0.98 inside a label, and their components."""
    return embed_dedup.near_duplicates(embeddings(spark, sf_dir), threshold=0.98)


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), max_tokens=1024)


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as directly addressable codes and read back."""
    path = token_files.write_token_files(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, path)


@query("op7_simhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the compiled transducer."""
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), limit=4096)


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings that start in a smaller doc_id, removed from every document."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), length=50)


@query("op10_source_mixing", mixing.MIX_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets by systematic sampling."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_conversation_repair", conversations.REPAIR_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired by the cheapest edits."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair_report(conversations.damage(turns), dropped="dropped")


@query("op12_harmonic_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, bins of reciprocal-capacity classes."""
    return harmonic.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), max_tokens=1024)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words in every document, some of them planted, and the texts without them."""
    return periodic.run_report(periodic.collapse(periodic.plant(documents(spark, sf_dir)), min_words=6, min_repeats=4))
