from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heliovane.llm.shards import hilbert_index, hilbert_shards, string_bounds


@pytest.mark.parametrize("bits,dims", [(3, 2), (3, 3), (2, 4)])
def test_curve_visits_every_cell_one_step_at_a_time(spark, bits, dims):
    cells = [((F.col("id") / 2 ** (bits * k)).cast("bigint") % 2**bits) for k in range(dims)]
    points = spark.range(2 ** (bits * dims)).select(
        *[c.alias(f"c{k}") for k, c in enumerate(cells)], hilbert_index(cells, bits).alias("index")
    )
    rows = {r["index"]: [r[f"c{k}"] for k in range(dims)] for r in points.collect()}
    assert sorted(rows) == list(range(2 ** (bits * dims)))
    for i in range(1, len(rows)):
        assert sum(abs(a - b) for a, b in zip(rows[i - 1], rows[i], strict=True)) == 1


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_every_row_gets_a_slot(documents, odd_documents, law):
    texts = ["copy of a text"] * 300 + [f"text {i} " * (i % 50) for i in range(300)]
    docs = documents(*enumerate(texts, 100)).unionByName(odd_documents)
    docs = docs.withColumn("shard", F.lit("clash")).withColumn("position", F.lit(None))
    rows = hilbert_shards(docs, 7, law=law).collect()
    assert len(rows) == docs.count()
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    held = {k: sorted(r["slot"] for r in rows if r["shard"] == k) for k in range(7)}
    assert all(slots == list(range(len(slots))) for slots in held.values())
    if law == "rows":
        counts = [len(s) for s in held.values()]
        assert max(counts) - min(counts) <= 1
    else:
        sizes = Counter()
        for r in rows:
            sizes[r["shard"]] += r["size"]
        largest = max(r["size"] for r in rows)
        assert all(abs(n - sum(sizes.values()) / 7) <= largest for n in sizes.values())
    sample = {r["doc_id"]: r for r in rows}
    assert sample[6]["size"] == len("tab\tand\nline é ü \U0001f600".encode()) + 16
    assert sample[6]["text_crc32"] == zlib.crc32("tab\tand\nline é ü \U0001f600".encode())
    assert (sample[1]["size"], sample[1]["text_crc32"]) == (16, 0)


def test_order_follows_the_curve_and_prunes(documents):
    rows = [(i, "x" * (i * 37 % 500), f"l{i % 5}", f"s{i * 7 % 11}", 0) for i in range(1000)]
    out = hilbert_shards(documents(*rows), 20).orderBy("position").collect()
    assert [r["curve"] for r in out] == sorted(r["curve"] for r in out)
    lang = {i: row[2] for i, row in enumerate(rows)}
    source = {i: row[3] for i, row in enumerate(rows)}
    spread = {name: 0 for name in ("lang", "source", "size")}
    for k in range(20):
        mine = [r for r in out if r["shard"] == k]
        spread["lang"] += len({lang[r["doc_id"]] for r in mine}) / 5
        spread["source"] += len({source[r["doc_id"]] for r in mine}) / 11
        spread["size"] += (max(r["size"] for r in mine) - min(r["size"] for r in mine)) / 500
    # A shard spans about half of each dimension or less; dealt at random it would span all of it.
    assert all(total / 20 < 0.7 for total in spread.values()), spread


def test_sources_of_one_prefix_prune(documents):
    rows = [(i, "x" * (i * 37 % 500), "en", f"https://example.org/é/{i * 7 % 11:02}", 0) for i in range(1000)]
    source = {row[0]: row[3] for row in rows}
    out = hilbert_shards(documents(*rows, (1000, "x", None, None, None)), 20).collect()
    spread = [len({source[r["doc_id"]] for r in out if r["shard"] == k and r["doc_id"] < 1000}) / 11 for k in range(20)]
    assert sum(spread) / 20 < 0.7, spread


def test_string_bounds_are_quantiles(documents):
    rows = [(i, "", "en", f"https://e.org/{'aéz'[i % 3] * (i % 40)}", 0) for i in range(500)]
    docs = documents(*rows, (500, "", "en", None, 0))
    values = sorted((row[3] for row in rows), key=str.encode)
    shares = [i / 16 for i in range(1, 16)]
    expected = {values[math.ceil(share * len(values)) - 1] for share in shares}
    assert string_bounds(docs, "source", shares) == sorted(expected, key=str.encode)
    assert string_bounds(docs.where("doc_id = 500"), "source", shares) == []


def test_empty_table(documents):
    assert hilbert_shards(documents(), 4).collect() == []
