from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from heliovane.llm.components import connected_components
from heliovane.llm.lines import (
    THRESHOLDS,
    banded_distance,
    candidate_pairs,
    flips,
    hashes_of,
    line_classes,
    line_keys,
    missing_pairs,
    near_lines,
    sketch,
    split_keys,
    star_pairs,
    verified_links,
    within,
    words_of,
)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        at = rng.randrange(len(words))
        match rng.randrange(3):
            case 0:
                words[at] = rng.choice(["abc", "é", "", "x1"])
            case 1 if len(words) > 1:
                del words[at]
            case _:
                words.insert(at, rng.choice(["abc", "é", "x1"]))
    return " ".join(words).strip()


def some_line(rng, words, vocabulary=("a", "b", "é", "dd")):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


def allowed(a, b, thresholds=THRESHOLDS):
    """The edits that may part two lines."""
    shorter = min(len(a.split(" ")), len(b.split(" ")))
    return max([t for words, t in thresholds if shorter >= words], default=0)


def near(a, b, thresholds=THRESHOLDS):
    most = allowed(a, b, thresholds)
    x, y = a.split(" "), b.split(" ")
    return a == b or (abs(len(x) - len(y)) <= most and distance(x, y) <= most)


def classes_of(texts, thresholds=THRESHOLDS):
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if near(a, b, thresholds):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {t: find(t) for t in texts}


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_banded_distance(spark, threshold):
    rng = random.Random(threshold)
    rows = []
    for _ in range(400):
        a = some_line(rng, rng.randrange(8, 40))
        b = edited(rng, a, rng.randrange(6))
        if len(b.split(" ")) > 2 * threshold and a != b:
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = words_of(F.col("a")), words_of(F.col("b"))
    differ = flips(sketch(hashes_of(F.col("a"))), sketch(hashes_of(F.col("b"))))
    got = df.select("a", "b", banded_distance(a, b, threshold).alias("d"), differ.alias("flips"),
                    within(F.col("a"), F.col("b"), threshold, threshold).alias("near"),
                    within(F.col("a"), F.col("b"), threshold, F.lit(1)).alias("one")).collect()
    for r in got:
        true = distance(r["a"].split(" "), r["b"].split(" "))
        assert (r["d"] if r["d"] <= threshold else None) == (true if true <= threshold else None)
        assert r["flips"] <= 2 * true and r["near"] == (true <= threshold) and r["one"] == (true <= 1)


def lines_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "line_id bigint, line string")
    return df.select("*", F.size(words_of(F.col("line"))).alias("size"), hashes_of(F.col("line")).alias("hashes"))


@pytest.mark.parametrize("thresholds,limit", [(((3, 1),), 2), (THRESHOLDS, 1), (THRESHOLDS, 2), (((7, 1), (9, 2), (14, 3)), 2)])
def test_classes_miss_no_link(spark, thresholds, limit):
    rng = random.Random(str(thresholds))
    texts = set()
    for _ in range(8):
        base = some_line(rng, rng.randrange(3, 40), [f"w{i}" for i in range(rng.choice([2, 6, 60]))])
        texts |= {edited(rng, base, rng.randrange(6)) for _ in range(14)}
    texts = sorted(t for t in texts if len(t.split(" ")) >= thresholds[0][0])
    expected = classes_of(texts, thresholds)
    found = {r["node"]: r["component"] for r in line_classes(lines_of(spark, texts), thresholds, limit).collect()}
    place = {t: i for i, t in enumerate(texts)}
    assert {i: found.get(i, i) for i in range(len(texts))} == {i: place[expected[t]] for i, t in enumerate(texts)}


def test_every_near_pair_is_a_candidate(spark):
    rng = random.Random(12)
    texts = set()
    for _ in range(60):
        base = some_line(rng, rng.randrange(5, 40), [f"w{i}" for i in range(500)])
        texts |= {base, edited(rng, base, 1), edited(rng, base, 2)}
    texts = sorted(texts)
    pairs, hot = candidate_pairs(lines_of(spark, texts), THRESHOLDS)
    pairs = {frozenset(r) for r in pairs.collect()}
    shared = {}
    for r in hot.collect() if hot is not None else []:
        shared.setdefault(r["key"], set()).add(r["line_id"])
    for i, a in enumerate(texts):
        for j in range(i):
            if allowed(a, texts[j]) and near(a, texts[j]):
                assert frozenset((i, j)) in pairs or any({i, j} <= ids for ids in shared.values())


def test_near_lines_share_a_key_at_every_size(spark):
    """The longer line meets a segment of the shorter one, where sizes change their class or threshold too."""
    rng = random.Random(21)
    pairs = []
    for size in [*range(5, 70), 127, 128, 129, 130, 300]:
        for _ in range(6):
            base = some_line(rng, size, [f"w{i}" for i in range(rng.choice([3, 1000]))])
            other = edited(rng, base, rng.choice([1, 2, 2]))
            if base != other and allowed(base, other) and near(base, other):
                pairs.append(sorted((base, other), key=lambda t: len(t.split(" "))))
    texts = sorted({t for pair in pairs for t in pair})
    place = {t: i for i, t in enumerate(texts)}
    own, met = {}, {}
    for r in line_keys(lines_of(spark, texts), THRESHOLDS).collect():
        met.setdefault(r["line_id"], set()).add(r["key"])
        if r["own"]:
            own.setdefault(r["line_id"], set()).add(r["key"])
    for a, b in pairs:
        assert own[place[a]] & met[place[b]]


def test_keys_of_a_line_are_few(spark):
    """Three segments, two more shifts of the middle one, and what sizes at the edge of a class add."""
    lines = lines_of(spark, [" ".join(f"w{i}_{n}" for i in range(n)) for n in range(32, 64)])
    keys = line_keys(lines, THRESHOLDS)
    assert keys.where("own").count() == 3 * 32 and keys.count() <= 6 * 32


def test_a_line_without_partner_is_its_own_class(documents):
    docs = documents((7, "alone in this text, nowhere else\n\nsecond"), (None, "second\nno id and no partner"))
    got = near_lines(docs).select("doc_id", "line_no", "class_doc_id", "class_line_no", "lines", "texts", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(
            str,
            [
                (7, 0, 7, 0, 1, 1, True),
                (7, 2, 7, 2, 2, 1, True),
                (None, 0, 7, 2, 2, 1, False),
                (None, 1, None, 1, 1, 1, True),
            ],
        )
    )


def candidates_of(spark, texts):
    """Candidates that are compared, and links."""
    lines = lines_of(spark, sorted(set(texts)))
    pairs, hot = candidate_pairs(lines, THRESHOLDS)
    parts = split_keys(lines, hot, THRESHOLDS)
    first = pairs.unionByName(star_pairs(parts)).distinct()
    links = verified_links(lines, first, THRESHOLDS)
    more = missing_pairs(parts, connected_components(links), THRESHOLDS)
    return first.count() + more.count(), links.count() + verified_links(lines, more, THRESHOLDS).count()


@pytest.mark.parametrize("kind", ["number", "rest", "variants"])
def test_candidates_of_a_template_grow_with_its_lines(spark, kind):
    """Lines that share most of their words, whether near each other or not."""
    rng = random.Random(kind)
    base = [f"word{i}" for i in range(60)]

    def made(n):
        if kind == "number":
            return f"the order with the number {rng.randrange(10**6):06} has left the house today and will be there on friday"
        if kind == "rest":
            return " ".join([*base[:20], *[f"r{rng.randrange(10**5)}" for _ in range(25)]])
        words = [w if rng.random() > 0.05 else f"x{rng.randrange(10**4)}" for w in base]
        return " ".join(words)

    counts = []
    for size in (200, 800):
        lines = [made(n) for n in range(size)]
        counts.append(candidates_of(spark, lines)[0] / size)
    assert counts[1] < 2 * counts[0] + 1


def test_a_replaced_word_in_a_long_line(documents):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
    other = [*words[:17], "another", *words[18:]]
    far = ["three", "other", "words", *words[3:]]
    text = "\n".join(map(" ".join, (words, other, far)))
    got = near_lines(documents((1, text))).orderBy("line_no").collect()
    assert [(r["class_line_no"], r["lines"], r["kept"]) for r in got] == [(0, 2, True), (0, 2, False), (2, 1, True)]


def brute_force(rows, least_chars=1):
    lines = []
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if len(line.strip(" \t\r")) >= least_chars:
                lines.append((doc_id is None, doc_id or 0, n, line.strip(" \t\r")))
    root = classes_of(sorted({x[3] for x in lines}))
    first, count = {}, {}
    for x in lines:
        k = root[x[3]]
        first[k] = min(first.get(k, x[:3]), x[:3])
        count[k] = count.get(k, 0) + 1
    out = []
    for x in lines:
        k = root[x[3]]
        name = (None if first[k][0] else first[k][1], first[k][2])
        out.append((None if x[0] else x[1], x[2], *name, count[k], first[k] == x[:3]))
    return sorted(map(str, out))


def test_classes_equal_brute_force(documents, odd_documents):
    rng = random.Random(4)
    vocabulary = ["abc", "d", "é", "fg", "", "the", "of"]
    pool = [some_line(rng, rng.randrange(1, 25), vocabulary).strip() for _ in range(25)]
    pool += [edited(rng, p, rng.randrange(1, 4)) for p in pool for _ in range(2)]
    rows = [(i, "\n".join(rng.choices(pool, k=6)) + "\r\nshort\n \t\n") for i in range(40)]
    docs = documents(*rows).unionByName(odd_documents).withColumn("line", F.lit("clash")).withColumn("h1", F.lit(0))
    docs = docs.withColumns({name: F.lit("clash") for name in ("a.b", "size", "hashes", "place", "key")})
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_lines(docs).select("doc_id", "line_no", "class_doc_id", "class_line_no", "lines", "kept").collect()
    assert sorted(str(tuple(r)) for r in got) == brute_force(given)


def test_a_very_long_line(documents):
    words = [f"w{i}" for i in range(30_000)]
    text = " ".join(words) + "\n" + " ".join([*words[:15_000], "new", *words[15_000:]])
    got = near_lines(documents((1, text), (2, None))).collect()
    assert [(r["lines"], r["texts"]) for r in got] == [(2, 2), (2, 2)]


def test_thresholds_need_enough_words(documents):
    with pytest.raises(ValueError):
        near_lines(documents(), thresholds=((4, 2),))


def test_no_python_in_the_plan(documents):
    df = near_lines(documents((1, "a line that is long enough")))
    plan = df._jdf.queryExecution().toString()
    assert not any(node in plan for node in ("EvalPython", "Pandas", "Arrow", "PythonUDF"))


def test_empty_table(documents):
    assert near_lines(documents()).collect() == []
