from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from heliovane.llm.bpe import byte_bpe
from heliovane.llm.decontaminate import benchmark_matches
from heliovane.llm.lines import near_lines
from heliovane.llm.quality import RuleModel, quality_scores
from heliovane.llm.render import page_texts
from heliovane.llm.secrets import secret_spans
from heliovane.llm.shards import hilbert_shards
from heliovane.llm.simhash import simhash_components
from heliovane.llm.suffixes import without_repeats

OPERATORS = {
    "bpe": lambda d: byte_bpe(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    "quality": lambda d: quality_scores(d, RuleModel(0.0, ())),
    "secrets": secret_spans,
    "suffixes": without_repeats,
    "counted suffixes": lambda d: without_repeats(d, window=20, gram=8, limit=0),
    "pages": lambda d: page_texts(d, "doc_id", "text").withColumnRenamed("page_id", "doc_id"),
    "shards": lambda d: hilbert_shards(d, 3),
    "simhash": simhash_components,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_large_ids_survive_beside_a_null(large_ids, name):
    found = [r["doc_id"] for r in OPERATORS[name](large_ids).select("doc_id").collect()]
    assert sorted(found, key=str) == sorted([2**53 + 1, None, 2**53 + 3, 2**53 + 5], key=str)


def test_large_ids_in_partial_results(spark, large_ids):
    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta")], "item_id bigint, text string")
    found = [r["doc_id"] for r in benchmark_matches(large_ids, items).collect()]
    assert sorted(found, key=str) == [2**53 + 1, None]
    lines = near_lines(large_ids).where(F.col("kept")).collect()
    assert sorted(r["class_doc_id"] for r in lines) == [2**53 + 1, 2**53 + 5]
