from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliovane.llm.decontaminate import (
    RADIUS,
    Items,
    benchmark_matches,
    block_masks,
    shingles,
    weighted_similarity,
    words_of,
)

ITEM = "item_id bigint, text string"


def brute_force(text, items, least=0.8):
    """Best similarity of any window of the item's size, without fingerprints."""
    words, found = words_of(text), {}
    for item_id, item in items:
        target = words_of(item)
        size, width = min(len(words), len(target)), min(5, len(target))
        for start in range(max(1, len(words) - size + 1)) if target and words else ():
            window = words[start : start + size]
            if len(window) < width:
                continue
            bag = Counter(shingles(window, width))
            similarity = weighted_similarity(bag, Counter(shingles(target)))
            if similarity >= least and similarity > found.get(item_id, (0, 0))[0]:
                found[item_id] = (similarity, start)
    return found


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "of", "É"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 5, 12, 25, 40])))) for i in range(25)]
    docs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 150))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                end = rng.choice([0, -1])
                passage[end if rng.random() < 0.7 else rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        text = " ".join(words)
        docs.append((i, text.upper() if i % 5 == 0 else text.replace(" ", ",\n", 3)))
    return docs, items


@pytest.mark.parametrize("block", [7, 1000])
def test_equals_brute_force(spark, documents, odd_documents, block):
    docs, items = corpus(random.Random(9))
    given = documents(*[(i + 100, t) for i, t in docs]).unionByName(odd_documents)
    given = given.withColumn("item_id", F.lit("clash"))
    table = spark.createDataFrame([*items, items[0], (900, None), (901, ""), (902, "lost and found")], ITEM)
    rows = benchmark_matches(given, table, item_block=block).collect()
    expected = {
        (i + 100, item): best
        for i, text in docs
        for item, best in brute_force(text, items).items()
    }
    expected[None, 902] = (1.0, 0)
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in rows}
    assert len(got) == len(rows)
    assert got == expected and len(got) > 40


def test_radius_holds_what_is_similar_enough():
    rng = random.Random(1)
    far = 0
    for k in range(300):
        words = [f"x{rng.randrange(10**6)}" for _ in range(40)]
        items = Items([(k, " ".join(words))], RADIUS, 0.8)
        changed = words[:]
        for end in (0, 1, -1)[: rng.randrange(4)]:
            changed[end] = "other"
        if weighted_similarity(Counter(shingles(words)), Counter(shingles(changed))) >= 0.8:
            far += not list(items.matches(changed))
    assert far == 0


@pytest.mark.parametrize("radius", [0, 5, RADIUS])
def test_no_radius_loses_what_is_similar_enough(radius):
    rng = random.Random(3)
    beyond = 0
    for k in range(400):
        size = rng.choice([3, 9, 14, 27, 60])
        vocabulary = [f"x{rng.randrange(10**6)}" for _ in range(rng.choice([2, 5, 1000]))]
        item = rng.choices(vocabulary, k=size)
        changed = item[:]
        for _ in range(rng.randrange(4)):
            changed[rng.choice([0, -1, rng.randrange(len(changed))])] = rng.choice(["other", *vocabulary])
        changed = changed[rng.randrange(2) :] if rng.random() < 0.3 else changed
        text = " ".join([*rng.choices(vocabulary, k=rng.choice([0, 5])), *changed, *rng.choices(vocabulary, k=rng.choice([0, 5]))])
        other = " ".join([*item[:-1], "last"])
        given = [(1, " ".join(item)), (2, other)]
        found = list(Items(given, radius, 0.8).matches(words_of(text)))
        assert {number: (similarity, start) for number, start, _, _, similarity in found} == brute_force(text, given)
        beyond += any(bits > radius for *_, bits, _ in found)
    assert beyond > 0 or radius == RADIUS


def test_a_similar_window_beyond_the_radius():
    words = [f"x559y{i}" for i in range(40)]
    changed = [*words[:36], "some", "other", "words", "here"]
    (found,) = Items([(1, " ".join(words))], RADIUS, 0.8).matches(changed)
    assert found[:3] == (1, 0, 40) and found[3] > RADIUS and found[4] >= 0.8


@pytest.mark.parametrize("radius", [0, 3, 11, 18, 31])
def test_blocks_cover_the_fingerprint(radius):
    masks = block_masks(radius)
    assert len(masks) == radius + 1 and sum(masks) == (1 << 64) - 1 and all(masks)


def test_blocks_bring_up_few_others():
    prints = np.random.default_rng(5).integers(0, 2**63, (2, 20_000), np.uint64) * np.uint64(2)
    differ = prints[0] ^ prints[1]
    agree = np.any([differ & np.uint64(mask) == 0 for mask in block_masks(RADIUS)], axis=0)
    assert 0.02 < agree.mean() < 0.04


def test_what_each_source_brings_up(monkeypatch):
    """Within the radius the blocks alone, beyond it the shingles alone: without the index all that is within it is lost."""
    rng = random.Random(8)
    vocabulary = [f"x{i}" for i in range(5_000)]
    given = [(k, " ".join(rng.choices(vocabulary, k=40))) for k in range(60)]
    texts = []
    for k, item in given:
        words = item.split()
        for end in range(k % 6):
            words[end] = "other"
        texts.append(" ".join([*rng.choices(vocabulary, k=30), *words, *rng.choices(vocabulary, k=30)]))
    items = Items(given, RADIUS, 0.8)

    def found():
        return {(n, *m[:2]): m[3] for n, text in enumerate(texts) for m in items.matches(words_of(text))}

    both = found()
    within = {key for key, bits in both.items() if bits <= RADIUS}
    assert set(key[1] for key in both) == {k for k, _ in given if k % 6 < 5}
    assert len(within) >= 25 and len(both) - len(within) >= 5
    monkeypatch.setattr(Items, "_near", lambda *_: set())
    assert not within & set(found()) and set(both) - within <= set(found())
    monkeypatch.undo()
    monkeypatch.setattr(Items, "_sharing", lambda *_: {})
    alone = found()
    assert within <= set(alone) and all(bits <= RADIUS for bits in alone.values())


def test_long_text_and_repeats():
    item = " ".join(f"p{i}" for i in range(30))
    items = Items([(1, item)], RADIUS, 0.8)
    text = f"{'word ' * 50_000}{item} {'other ' * 50_000}{item}"
    assert list(items.matches(words_of(text))) == [(1, 50_000, 30, 0, 1.0)]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEM)
    some = spark.createDataFrame([(1, "a b c d e f")], ITEM)
    assert benchmark_matches(documents((1, "a b c d e f")), none).collect() == []
    assert benchmark_matches(documents(), some).collect() == []
