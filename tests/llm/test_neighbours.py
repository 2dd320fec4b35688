from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliovane.llm import neighbours
from heliovane.llm.neighbours import MultiIndex, cell_blocks, nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, asks, top=5):
    """Nearest by cosine, ties to smaller ids, over usable vectors."""
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q, x in good.items():
        if asks(q):
            scores = [
                (-math.fsum(x * y) / math.sqrt(math.fsum(x * x)) / math.sqrt(math.fsum(y * y)), i)
                for i, y in good.items()
                if i != q
            ]
            out[q] = [(i, -s) for s, i in sorted(scores)[:top]]
    return out


def by_query(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_recall_and_scores_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = by_query(nearest_neighbours(table, F.col("vec_id") % 5 == 0))
    truth = brute_force(rows, lambda q: q % 5 == 0)
    assert found.keys() == truth.keys()
    hits = total = 0
    for q, best in truth.items():
        near = dict(found[q])
        hits += len(near.keys() & dict(best).keys())
        total += len(best)
        exact = {i: s for i, s in best}
        assert all(near[i] == pytest.approx(exact[i], abs=1e-12) for i in near.keys() & exact.keys())
        scores = [s for _, s in found[q]]
        assert scores == sorted(scores, reverse=True) and len(scores) == 5
    assert hits / total >= 0.9


@pytest.mark.parametrize("block", [16, 8192])
def test_visiting_all_cells_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(6)]) for i in range(300)]
    rows = [(i, v) for i, v in rows if any(v)] + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(100)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = by_query(nearest_neighbours(table, F.col("vec_id") % 20 == 0, share=1.0))
    truth = brute_force(rows, lambda q: q % 20 == 0)
    assert found.keys() == truth.keys()
    for q in truth:
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in truth[q]], abs=1e-12)
        if q >= 1000:
            assert [i for i, _ in found[q]] == [i for i, _ in truth[q]]


def test_heap_visits_cells_in_order_of_distance():
    rng = np.random.default_rng(1)
    index = MultiIndex(rng.normal(size=(9, 3)), rng.normal(size=(9, 3)), dict.fromkeys(range(81), 1))
    for _ in range(20):
        a, b = rng.random(9), rng.random(9)
        cells = index.visited(a, b, 81)
        sums = [a[c // 9] + b[c % 9] for c in cells]
        assert sorted(cells) == list(range(81)) and sums == sorted(sums)
        assert index.visited(a, b, 10) == cells[:10]
    index.counts = {5: 3, 70: 4}
    assert sorted(index.visited(a, b, 7)) == [5, 70]


def test_blocks_hold_every_cell():
    blocks, spread = cell_blocks({1: 5, 2: 5, 7: 35, 8: 1, 9: 9}, 10)
    assert blocks == {1: [0], 2: [0], 7: [1, 2, 3, 4], 8: [5], 9: [5]}
    assert spread == {1: 1, 2: 1, 7: 4, 8: 1, 9: 1}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]),
        (0, [1.0, 0.0, 0.0]),
        (50, None),
        (100, [0.0, 0.0, 0.0]),
        (150, [1.0, None, 0.0]),
        (200, [nan, 1.0, 0.0]),
        (250, [inf, 1.0, 0.0]),
        (300, [1.0, 0.0]),
        (350, []),
        (None, [1.0, 1.0, 1.0]),
        (1, [1e-30, 0.0, 0.0]),
        (2, [-1e30, 0.0, 1e30]),
    ]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    table = table.withColumn("vector", F.lit("clash")).withColumn("cell", F.lit("clash"))
    found = by_query(nearest_neighbours(table, F.col("vec_id") % 50 == 0))
    assert list(found) == [0]
    assert [i for i, _ in found[0]] == [1, 2]
    assert [s for _, s in found[0]] == pytest.approx([1.0, -math.sqrt(0.5)])


def test_empty_and_single(spark):
    assert nearest_neighbours(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)
    assert nearest_neighbours(one, F.lit(True)).collect() == []
