from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from heliovane.llm.components import connected_components
from heliovane.llm.simhash import covering_masks, fingerprint, links_within, simhash_components


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_the_radius(radius):
    masks = covering_masks(list(range(64)), radius)
    rng = random.Random(7)
    for _ in range(2000):
        differ = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(differ & mask == 0 for mask in masks)


@pytest.mark.parametrize("limit", [4, 1024])
def test_components_equal_all_pairs(spark, limit):
    rng = random.Random(3)
    values = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            values.add(at)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                at ^= 1 << b
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = {r[0]: r[1] for r in connected_components(links_within(fps, 3, limit)).collect()}
    near = [
        (a, b)
        for i, a in enumerate(signed)
        for b in signed[:i]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    ]
    expected = classes(signed, near)
    assert {n: found.get(n, n) for n in signed} == expected


def test_documents_against_brute_force(spark, documents, odd_documents):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(400)]
        texts.append(" ".join(base))
        for _ in range(3):
            base[rng.randrange(400)] = rng.choice(words)
            texts.append(" ".join(base).replace(" ", "\n", 1).upper())
    docs = documents(*enumerate(texts, 50)).unionByName(odd_documents).withColumn("fp", F.lit("clash"))
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    near = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    root = classes(range(len(rows)), near)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[root[i]] = min(least.get(root[i], r["doc_id"]), r["doc_id"])
    expected = sorted((str(r["doc_id"]), f"{prints[i]:016x}", str(least.get(root[i]))) for i, r in enumerate(rows))
    got = simhash_components(docs).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == expected
    assert len({r[2] for r in got}) < len(rows) - 20


def test_few_words_and_long_texts():
    assert fingerprint(None) == fingerprint(b" \n\t") == 0
    for text in ("One", "one TWO", "a b c", "É é x  y\x0bz", "a b c d " * 30_000):
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_empty_table(documents):
    assert simhash_components(documents()).collect() == []
