"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.llm import oracle
from heliovane.llm.bpe import byte_bpe, token_digest
from heliovane.llm.common import table
from heliovane.llm.conversations import damaged, repaired_conversations
from heliovane.llm.decontaminate import benchmark_matches
from heliovane.llm.exact import exact_groups
from heliovane.llm.lines import near_lines
from heliovane.llm.neighbours import nearest_neighbours
from heliovane.llm.phrases import collocations
from heliovane.llm.quality import THRESHOLD, fit_rules, held_out, quality_scores, training_sample
from heliovane.llm.render import page_texts
from heliovane.llm.secrets import KINDS, joined, secret_spans
from heliovane.llm.shards import hilbert_shards
from heliovane.llm.simhash import simhash_components
from heliovane.llm.suffixes import without_repeats

SHARDS = 40


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        token_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_lines(table(spark, sf_dir, "documents")).drop("text_hash", "n_chars")


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_rules(training_sample(docs, table(spark, sf_dir, "labels")))
    return quality_scores(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("bigint").alias("n_kept"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return benchmark_matches(docs, items).drop("text_hash", "distance")


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = hilbert_shards(table(spark, sf_dir, "documents"), SHARDS)
    return shards.withColumn("grown_shard", F.lit(None).cast("int"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The history is the earlier half of the range of ids; what came later is looked up in its index.
    first, last = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if first is None else (first + last) // 2
    return exact_groups(docs, F.col("doc_id") <= middle)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repaired_conversations(damaged(conversations), conversations)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_byte_bpe,
        op2_multi_index,
        op3_line_dedup,
        op4_rule_ensemble,
        op5_secret_scan,
        op6_suffix_dedup,
        op7_decontaminate,
        op8_page_text,
        op9_hilbert_shards,
        op10_simhash,
        op11_exact_dedup,
        op12_conversation_repair,
        op13_collocations,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
