"""The corpus pipeline: stages over ``documents``, each written before the next one reads it.

Every stage takes all rows that its predecessor kept. All but the last return the columns of their input, so each can be
run by itself. Null and empty texts, repeated rows, null ids and further columns pass as the docstrings say; an empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliovane.llm.bpe import byte_bpe, token_digest
from heliovane.llm.common import noted_scratch, remove_paths, same_document, stored, table
from heliovane.llm.decontaminate import benchmark_matches
from heliovane.llm.lines import near_lines
from heliovane.llm.quality import THRESHOLD, fit_rules, quality_scores, training_sample
from heliovane.llm.simhash import simhash_representatives

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Characters of the shortest line that the line stage takes out.
LINE_CHARS = 20

#: Documents to leave out whose keys are broadcast; more are left out by a shuffle join.
BROADCAST_DOCUMENTS = 1_000_000

#: Scratch tables of the last stage, which are of no use once the next one starts from what was written.
_scratch: list[str] = []


def _stage(work: Stage) -> Stage:
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_paths(spark, _scratch)
        _scratch.clear()
        with noted_scratch() as paths:
            result = work(spark, docs, sf_dir)
        _scratch.extend(paths)
        return result

    stage.__name__, stage.__doc__ = work.__name__, work.__doc__
    return stage


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash`` and the whole row, so that no column of it can clash with others."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), row)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject. It learns from the labelled documents of the input."""
    model = fit_rules(training_sample(docs, table(spark, sf_dir, "labels")))
    # The row as a whole, so that no column of it is taken for the score.
    scored = quality_scores(_keyed(docs).select("row", F.col("row.text").alias("text")), model)
    return scored.where(F.col("quality_score") >= THRESHOLD).select("row.*")


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of 20 characters or more that repeat or nearly repeat an earlier line of the table.

    Shorter lines are headings and answers that may well occur again. A text that loses no line stays as it is. One that
    loses all keeps its row with an empty text. ``n_chars`` follows the text.
    """
    gone = near_lines(docs).where(~F.col("kept") & (F.col("n_chars") >= LINE_CHARS))
    gone = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("gone_lines"))
    joined = same_document(_keyed(docs), gone, "left")
    text, untouched = F.col("row.text"), F.col("gone_lines").isNull()
    lines = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("gone_lines", i))
    text = F.when(untouched, text).otherwise(F.array_join(lines, "\n"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        size = F.when(untouched, F.col("row.n_chars")).otherwise(F.length(text))
        changed["n_chars"] = size.cast(dict(docs.dtypes)["n_chars"])
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: that of the smallest id, and one of its rows if they repeat."""
    chosen = stored(simhash_representatives(docs), "representatives")
    joined = same_document(_keyed(docs), chosen, "inner")
    if not chosen.where(F.col("rows") > 1).isEmpty():
        others = [F.col(f"row.`{name}`") for name in sorted(set(docs.columns) - {"text"})]
        order = Window.partitionBy("doc_id", "text_hash").orderBy(*others)
        joined = joined.withColumn("repeat", F.row_number().over(order)).where("repeat = 1")
    return joined.select("row.*")


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = benchmark_matches(docs, table(spark, sf_dir, "benchmark"))
    found = stored(found.select("doc_id", "text_hash").distinct(), "contaminated")
    if found.count() <= BROADCAST_DOCUMENTS:
        found = F.broadcast(found)
    return same_document(_keyed(docs), found, "left_anti").select("row.*")


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document, their number, and digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        token_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Learned rules, SimHash and the tokenizer have no SQL counterpart; the tests compare every stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
