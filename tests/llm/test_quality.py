from __future__ import annotations

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from heliovane.llm.quality import (
    FEATURES,
    Rule,
    RuleModel,
    fit_rules,
    held_out,
    quality_scores,
    statistics,
    training_sample,
)

SF = "/root/testdata/sf0.01"


def as_frame(spark, rows):
    return spark.createDataFrame(rows, "label double, " + ", ".join(f"{n} double" for n in FEATURES))


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, fit_rules(training_sample(docs, labels))


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = (
        quality_scores(docs, model)
        .where(held_out(F.col("doc_id")))
        .join(labels, "doc_id")
        .select("quality", "quality_score")
        .collect()
    )
    right = sum((r["quality_score"] >= 0.3) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95
    assert all(0 <= r["quality_score"] <= 1 for r in rows)


def test_rules_are_sparse_and_compile_to_what_they_say(spark, fitted):
    _, _, model = fitted
    assert 0 < len(model.rules) < 60
    rng = random.Random(1)
    rows = [tuple([0.0] + [rng.random() * rng.choice([1, 10]) for _ in FEATURES]) for _ in range(200)]
    got = as_frame(spark, rows).select("*", model.score().alias("score")).collect()
    for r in got:
        total = model.intercept + sum(
            w for rule, w in model.rules if all(lo < r[n] <= hi for n, lo, hi in rule.bounds)
        )
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_rows_do_not_teach(spark, documents):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = documents(*[(i, f"text {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id bigint, quality int")
    assert training_sample(docs, labels).count() == 0
    found = {r[0] for r in docs.where(held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert found == set(ids)


def test_sample_is_bounded(spark, documents):
    docs = documents(*[(i, "a b") for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id bigint, quality int")
    assert 150 < training_sample(docs, labels, 200).count() < 260


def test_statistics_of_odd_texts(odd_documents):
    rows = odd_documents.select("doc_id", *[c.alias(n) for n, c in statistics(F.col("text")).items()])
    by_id = {r["doc_id"]: r for r in rows.collect()}
    assert all(by_id[1][n] == by_id[2][n] for n in FEATURES)
    assert by_id[2]["log_words"] == 0 and by_id[2]["distinct_words"] == 0
    assert by_id[5]["distinct_words"] == pytest.approx(1 / 20_000)
    assert all(r[n] is not None and math.isfinite(r[n]) for r in rows.collect() for n in FEATURES)


def test_scores_keep_rows_and_columns(odd_documents):
    docs = odd_documents.withColumn("capitals", F.lit("clash")).withColumn("kept", F.lit(1))
    model = RuleModel(0.0, ((Rule((("log_words", -math.inf, 1.0),)), -2.0),))
    out = quality_scores(docs, model)
    assert out.columns == [*docs.columns, "quality_score"]
    assert sorted(map(str, out.drop("quality_score").collect())) == sorted(map(str, docs.collect()))
    scores = {r["doc_id"]: r["quality_score"] for r in out.collect()}
    assert scores[1] == scores[2] == pytest.approx(1 / (1 + math.exp(2))) and scores[3] == 0.5


def test_one_label_or_none(spark):
    none = as_frame(spark, [])
    assert fit_rules(none) == RuleModel(0.0, ())
    ones = as_frame(spark, [tuple([1.0] + [0.5] * len(FEATURES))] * 3)
    assert fit_rules(ones).intercept > 5
    both = ones.unionByName(as_frame(spark, [tuple([0.0] + [0.5] * len(FEATURES))]))
    assert fit_rules(both).intercept == pytest.approx(math.log(3))


def test_empty_table(documents):
    assert quality_scores(documents(), RuleModel(0.0, ())).collect() == []
