"""Every stage of the pipeline against a plain version of it."""

from __future__ import annotations

import math
import random

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from heliovane.llm.quality import THRESHOLD, fit_rules, statistics, training_sample

from .test_bpe import PATHS, reference
from .test_decontaminate import brute_force as leaks
from .test_lines import brute_force as line_classes
from .test_lines import edited
from .test_simhash import classes, plain_fingerprint


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def plain_quality(docs, labels):
    model = fit_rules(training_sample(docs, labels))
    kept = []
    features = [c.alias(n) for n, c in statistics(F.col("text")).items()]
    for r in docs.select("*", *features).collect():
        total = model.intercept + sum(
            w for rule, w in model.rules if all(lo < r[n] <= hi for n, lo, hi in rule.bounds)
        )
        if 1 / (1 + math.exp(-total)) >= THRESHOLD:
            kept.append(tuple(r[: len(docs.columns)])[:5])
    return kept


def plain_lines(rows):
    gone = {}
    for found in line_classes([(r[0], r[1]) for r in rows]):
        doc_id, line_no, *_, kept = eval(found)
        text = next(r[1] for r in rows if r[0] == doc_id)
        if not kept and len(text.split("\n")[line_no].strip(" \t\r")) >= 20:
            gone.setdefault(doc_id, set()).add(line_no)
    out = []
    for r in rows:
        text, n = r[1], r[4]
        if r[0] in gone and text is not None:
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[r[0]])
            n = len(text)
        out.append((r[0], text, *r[2:4], n))
    return out


def plain_groups(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = classes(range(len(rows)), near)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root[i], []).append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(21)
    words = ["the", "of", "and", "Émile", "river", "stone", "cloud", "paper", "glass", "north"] + [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(4)]
    pool = [" ".join(rng.choices(words, k=rng.randrange(4, 12))) for _ in range(30)]
    docs, labels = [], []
    for i in range(160):
        bad = i % 4 == 0
        if bad:
            text = " ".join(f"{w.upper()}!!" for w in rng.choices(words[:6], k=60))
        else:
            text = "\n".join([" ".join(rng.choices(words, k=40)), rng.choice(pool), edited(rng, rng.choice(pool), 1)])
        if i % 20 == 3:
            text += " " + rng.choice(items)[1]
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    docs += [(200 + k, docs[k][1], "fr", "copy", docs[k][4]) for k in (1, 2, 5)]
    docs += [(300, None, None, None, None), (301, "", "en", "s", 0), (302, "", "en", "s", 0), docs[6], (None, "lost words", None, None, 10)]
    docs.append((303, "word other " * 5000, "en", "long", 55000))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages_equal_their_plain_versions(spark, folder):
    path, items = folder
    labels = spark.read.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clashes = ["gone_lines", "quality_score", "a.b", "row", "text_hash", "rows", "repeat", "line"]
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.coalesce("source", F.lit("none"))) for name in clashes})
    plain = {
        "quality": lambda df: plain_quality(df, labels),
        "line_dedup": lambda df: plain_lines(rows_of(df)),
        "near_dedup": lambda df: plain_groups(rows_of(df)),
        "decontaminate": lambda df: [r for r in rows_of(df) if not leaks(r[1], items)],
    }
    sizes = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        expected = plain[name](docs)
        result = stage(spark, docs, path)
        assert result.schema == docs.schema
        for row in result.collect():
            assert all(row[c] == f"{c} of {'none' if row['source'] is None else row['source']}" for c in clashes)
        docs = spark.createDataFrame(result.collect(), docs.schema)
        assert sorted(map(str, rows_of(docs))) == sorted(map(str, expected)), name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 50
    encoding = reference(PATHS[0])
    texts = {r[0]: r[1] for r in rows_of(docs)}
    for r in pipeline.STAGES[-1][1](spark, docs, path).collect():
        assert r["ids"] == encoding.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(r["ids"])


def test_run_is_the_stages_in_order(spark, folder):
    path, _ = folder
    out = pipeline.run(spark, path)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) > 50


def test_empty_tables(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
