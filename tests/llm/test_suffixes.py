from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heliovane.llm import suffixes
from heliovane.llm.suffixes import anchors, blind_sort, merged, repeated_starts, sort_suffixes, without_repeats


def brute_force(texts, window):
    """Removed ranges of each text by counting every window."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        hit = [(i, i + window) for i in range(len(d) - window + 1) if count[d[i : i + window]] > 1]
        out.append((merged(hit), d))
    return out


def corpus(rng, scale):
    """Texts that share passages of many lengths, periodic runs and small changes."""
    letters = "abcdefghij é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 4 * scale))) for _ in range(12)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(6)):
            kind = rng.randrange(5)
            if kind < 3:
                p = rng.choice(passages)
                a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1)))
                parts.append(p if kind else p[a:b])
            elif kind == 3:
                parts.append(rng.choice(["ab", "x", "word "]) * rng.randrange(scale))
            else:
                parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(2 * scale))))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("shallow", [0, 8, 160])
def test_suffixes_are_sorted(seed, shallow):
    rng = random.Random(seed)
    suffixes = [bytes(rng.choices(b"ab", k=rng.randrange(40))) for _ in range(200)]
    suffixes += [b"q" * 170 + s for s in suffixes]
    expected = sorted(suffixes)
    assert [suffixes[k] for k in sort_suffixes(suffixes, shallow)] == expected
    assert [suffixes[k] for k in blind_sort(suffixes, list(range(len(suffixes))))] == expected


@pytest.mark.parametrize("seed", range(6))
def test_windows_of_a_group(seed):
    rng = random.Random(seed)
    window, core = 12, b"<core>"
    spans, at = [], []
    for _ in range(40):
        left = bytes(rng.choices(b"ab", k=rng.randrange(8)))
        right = bytes(rng.choices(b"ab", k=rng.randrange(8)))
        if len(left) + len(right) >= 6 and (left, right) not in zip(spans, at, strict=True):
            spans.append(left + core + right)
            at.append(len(left))
    pairs = sorted(set(zip(spans, at, strict=True)))
    spans, at = [s for s, _ in pairs], [a for _, a in pairs]
    count = Counter()
    for s, a in pairs:
        for i in range(len(s) - window + 1):
            count[s[i : i + window], a - i] += i <= a
    expected = {(k, i) for k, (s, a) in enumerate(pairs) for i in range(min(a, len(s) - window) + 1)
                if count[s[i : i + window], a - i] > 1}
    got = {(k, i) for k, low, high in repeated_starts(spans, at, window) for i in range(low, high + 1)}
    assert got == expected


@pytest.mark.parametrize("piece", [512, 1 << 18])
def test_anchors_stand_for_every_window_and_depend_on_it_alone(monkeypatch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(2)
    text = bytes(rng.choices(b"abc", k=3000)) + b"ab" * 600
    seen = {}
    for copy in (text, b"other start" * 50 + text):
        starts = []
        for place, _, first, last in anchors(copy, 400, 128):
            for p, a, b in zip(place.tolist(), first.tolist(), last.tolist(), strict=True):
                for s in range(a, b + 1):
                    starts.append(s)
                    assert s <= p <= s + 400 - 128
                    assert seen.setdefault(copy[s : s + 400], p - s) == p - s
        assert starts == list(range(len(copy) - 399))


@pytest.mark.parametrize("limit", [1, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_counting_all_windows(documents, odd_documents, seed, limit):
    texts = corpus(random.Random(seed), 120)
    docs = documents(*enumerate(texts, 100)).unionByName(odd_documents)
    docs = docs.withColumn("gram", F.lit("clash")).withColumn("span", F.lit(None))
    rows = docs.select("doc_id", "text").collect()
    expected = []
    for r, (cut, data) in zip(rows, brute_force([r["text"] for r in rows], 60), strict=True):
        left = bytearray()
        end = 0
        for a, b in [*cut, (len(data), len(data))]:
            left += data[end:a]
            end = b
        expected.append((str(r["doc_id"]), len(data), cut, bytes(left)))
    out = without_repeats(docs, window=60, gram=20, limit=limit).collect()
    got = [(str(r[0]), r[1], [(x["start"], x["end"]) for x in r[2]], bytes(r[3])) for r in out]
    assert sorted(got) == sorted(expected)
    assert sum(len(cut) for _, _, cut, _ in got) > 20


def test_empty_table(documents):
    assert without_repeats(documents()).collect() == []
