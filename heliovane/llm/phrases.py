"""Collocations by Toivonen's method: a sample proposes phrases, a full pass counts them and their negative border.

A phrase of ``k`` words can be frequent only if both of its parts of ``k - 1`` words are. The sample's frequent phrases are
the proposals; their negative border are the phrases that are not proposed but whose two parts are. A pass over all texts
counts proposals and border exactly, that is every occurrence whose two parts are proposed (all words, for ``k = 1``).
Where a phrase of the border turns out frequent the sample has failed: it joins the proposals, and a further pass counts
what its extensions add. No such phrase left means closed, and nothing frequent can be missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import stored

#: Words of the longest phrase.
LONGEST = 4

#: Occurrences from which a phrase is a candidate.
LEAST = 30

#: Of a hundred occurrences of a phrase, so many inside one longer phrase make it a part of that.
ABSORBED = 80

#: Phrases that are returned for each language.
TOP = 2_000

SCORE_UNIT = 2_000_000

#: Share of the documents that proposes phrases. It decides how much the passes count, never what comes out.
SAMPLE_SHARE = 0.1

#: A sample's phrase is proposed from this share of the occurrences that the sample should hold of the rarest candidate.
SAMPLE_LENIENCE = 0.6

#: Bits of the filter that tells tasks which phrases are proposed, 8 MB however many there are. A phrase that passes by
#: accident is extended without need; none is missed.
FILTER_BITS = 1 << 26

#: Bytes of text that a task counts at once, and those it holds back in all to fill such a piece for each language.
CHUNK_BYTES = 6 << 20
HELD_BYTES = 12 << 20

#: Language of documents without one.
NO_LANGUAGE = "und"

#: Bits of the numbers that the first step counts, and the bytes of text for each of their ranges. A task holds the numbers of
#: one range at a time, so there are more ranges the more text there is.
NUMBER_BITS = 40
RANGE_BYTES = 8 << 20

_NUMBERS = "range int, numbers binary, times binary"

_COUNTS = "lang string, phrase string, words int, hash bigint, n bigint"

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _ENDS + b"\t", _UPPER.lower() + b"\n" * len(_ENDS) + b" ")


def _mixed(bits: np.ndarray) -> np.ndarray:
    bits = (bits ^ (bits >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return bits ^ (bits >> np.uint64(29))


def _passes(proposed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(proposed.size * 8 - 1)
    return (proposed[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


class _Words:
    """The words of some texts of one language: their numbers in a dictionary, and the pieces they stand in."""

    def __init__(self, texts: list[bytes], lang: str) -> None:
        raw = np.frombuffer(b"\n".join(texts).translate(_TABLE), np.uint8)
        inside = (raw != 32) & (raw != 10)
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(raw == 10), starts).astype(np.int32)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
        encoded = pa.Array.from_buffers(pa.string(), len(starts), letters).dictionary_encode()
        self.ids = encoded.indices.to_numpy().astype(np.int64)
        self.words = encoded.dictionary
        own = pd.util.hash_array(np.array([lang], object), categorize=False)
        spelled = self.words.to_numpy(zero_copy_only=False)
        self.word_hash = _mixed(pd.util.hash_array(spelled, categorize=False) ^ own)

    def extended(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words from those of one word less, by place."""
        return _mixed(hashes[:-1] * np.uint64(0x100000001B3) + self.word_hash[self.ids[size - 1 :]])

    def distinct(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different phrase of ``size`` words at ``places``, and how often it stands there."""
        if size == 1:
            _, first, times = np.unique(self.ids[places], return_index=True, return_counts=True)
            return places[first], times
        count = len(self.words)

        def pair(at: int) -> np.ndarray:
            return self.ids[places + at] * count + self.ids[places + at + 1]

        key = pair(0)
        if size > 2:
            key = np.unique(key, return_inverse=True)[1]
            last = self.ids[places + 2] if size == 3 else np.unique(pair(2), return_inverse=True)[1]
            key = key * (int(last.max()) + 1) + last
        _, first, times = np.unique(key, return_index=True, return_counts=True)
        return places[first], times

    def spelled(self, places: np.ndarray, size: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.ids[places + at])) for at in range(size)]
        return parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")


def _rows(lang: str, phrases: pa.Array, size: int, hashes: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    count = len(phrases)
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(lang), count),
            phrases,
            pa.repeat(pa.scalar(size, pa.int32()), count),
            pa.array(hashes.view(np.int64)),
            pa.array(times.astype(np.int64)),
        ],
        names=["lang", "phrase", "words", "hash", "n"],
    )


def _wanted(
    found: _Words, proposed: np.ndarray, counted: np.ndarray | None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, places and hashes at all places of the phrases that a pass counts: both of whose parts are proposed, without those
    that the pass by ``counted`` has counted. Words are counted by the first pass."""
    hashes = found.word_hash[found.ids]
    if counted is None:
        yield 1, np.arange(len(hashes)), hashes
    known = _passes(proposed, found.word_hash)[found.ids]
    before = None if counted is None else _passes(counted, found.word_hash)[found.ids]
    for size in range(2, LONGEST + 1):
        if not known.any():
            return
        wanted = known[:-1] & known[1:] & (found.piece[size - 1 :] == found.piece[: 1 - size])
        done = None if before is None else before[:-1] & before[1:]
        hashes = found.extended(hashes, size)
        places = np.flatnonzero(wanted if done is None else wanted & ~done)
        if len(places):
            yield size, places, hashes
        # Only what can be counted at all may be extended: both parts proposed, within one piece.
        known = np.zeros(len(wanted), bool)
        extending = np.flatnonzero(wanted)
        known[extending] = _passes(proposed, hashes[extending])
        if done is not None:
            before = np.zeros(len(wanted), bool)
            extending = np.flatnonzero(wanted & done)
            before[extending] = _passes(counted, hashes[extending])


def _numbers(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - NUMBER_BITS)


def _range_width(ranges: int) -> int:
    return -(-(1 << NUMBER_BITS) // ranges)


def _number_counts(lang: str, texts: list[bytes], proposed: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """How often each number that the phrases of the first pass are hashed to stands for one: a row for each range of numbers,
    with the numbers less the range's first, and their counts."""
    wanted = [hashes[places] for _, places, hashes in _wanted(_Words(texts, lang), proposed, None)]
    if not wanted:
        return
    numbers, times = np.unique(_numbers(np.concatenate(wanted)), return_counts=True)
    width = np.uint64(_range_width(ranges))
    of = numbers // width
    held, first = np.unique(of, return_index=True)
    offsets = pa.py_buffer((np.append(first, len(numbers)) * 4).astype(np.int32))

    def packed(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(held), [None, offsets, pa.py_buffer(values.astype(np.uint32))])

    arrays = [pa.array(held.astype(np.int32)), packed(numbers - of * width), packed(times)]
    yield pa.RecordBatch.from_arrays(arrays, names=["range", "numbers", "times"])


def _frequent_numbers(least: int, ranges: int):
    """The numbers counted ``least`` times or more, out of rows sorted by range."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, numbers, times = None, [], []

        def ended() -> pa.RecordBatch:
            all_numbers, place = np.unique(np.concatenate(numbers), return_inverse=True)
            totals = np.bincount(place, np.concatenate(times).astype(np.float64))
            found = all_numbers[totals >= least].astype(np.int64) + current * _range_width(ranges)
            return pa.RecordBatch.from_arrays([pa.array(found)], names=["hash"])

        for batch in batches:
            for held, *packed in zip(*batch.columns, strict=True):
                if held.as_py() != current:
                    if current is not None:
                        yield ended()
                    current, numbers, times = held.as_py(), [], []
                for array, values in zip((numbers, times), packed, strict=True):
                    array.append(np.frombuffer(values.as_buffer(), np.uint32))
        if current is not None:
            yield ended()

    return frequent


def _phrase_counts(
    lang: str, texts: list[bytes], proposed: np.ndarray, counted: np.ndarray | None, heavy: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of a pass, spelled out; with ``heavy`` of those whose number may be frequent."""
    found = _Words(texts, lang)
    if counted is None and len(found.ids):
        yield _rows(lang, pa.array([""]), 0, np.zeros(1, np.uint64), np.array([len(found.ids)]))
    for size, places, hashes in _wanted(found, proposed, counted):
        if heavy is not None:
            places = places[_passes(heavy, _numbers(hashes[places]))]
        if len(places):
            first, times = found.distinct(places, size)
            yield _rows(lang, found.spelled(first, size), size, hashes[first], times)


def _counting(counts, *filters):
    """The task that counts with ``counts`` in pieces of text of one language; filters come as broadcasts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [None if bits is None else bits.value for bits in filters]
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def emptied(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            return counts(lang, held.pop(lang), *known)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, text = lang.as_py(), text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= CHUNK_BYTES:
                    yield from emptied(lang)
                elif sum(sizes.values()) >= HELD_BYTES:
                    yield from emptied(max(sizes, key=sizes.__getitem__))
        for lang in list(held):
            yield from emptied(lang)

    return count


def _filter_bits(phrases: DataFrame) -> np.ndarray:
    """The filter of the phrases' hashes. At most ``FILTER_BITS / 64`` words come to the driver, whatever the number of phrases."""
    place = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = phrases.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint8)


def _frequent(texts: DataFrame, proposed: Broadcast, least: int) -> DataFrame:
    """The numbers in ``hash`` that phrases of the first pass are hashed to ``least`` times or more."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    # At least as many ranges as leave numbers of 32 bits in each.
    ranges = max(1 << (NUMBER_BITS - 32), -(-total // RANGE_BYTES))
    counts = texts.mapInArrow(_counting(partial(_number_counts, ranges=ranges), proposed), _NUMBERS)
    dealt = counts.repartition(tasks, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(_frequent_numbers(least, ranges), "hash bigint")


def mined_phrases(texts: DataFrame, least: int, proposals: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``lang, phrase, words, hash, n`` of every phrase that occurs ``least`` times or more, and the passes it took.

    ``texts`` has ``lang`` and ``text`` without nulls. ``proposals`` (with ``lang, phrase, hash, words``) only decide what the
    first pass counts; without any the passes go word by word. All words of a language together are a row with no words.
    """
    context = texts.sparkSession.sparkContext
    texts = texts.select("lang", F.col("text").cast("binary").alias("text"))
    known = None if proposals is None else proposals.where(F.col("words").between(1, LONGEST - 1))
    proposed = np.zeros(FILTER_BITS // 8, np.uint8) if known is None else _filter_bits(known)
    counted, found = None, []
    while True:
        sent = [None if bits is None else context.broadcast(bits) for bits in (proposed, counted)]
        heavy = None
        if counted is None:
            heavy = context.broadcast(_filter_bits(_frequent(texts, sent[0], least)))
        rows = texts.mapInArrow(_counting(_phrase_counts, *sent, heavy), _COUNTS)
        totals = rows.groupBy("lang", "phrase").agg(
            F.min("words").alias("words"), F.min("hash").alias("hash"), F.sum("n").alias("n")
        )
        found.append(stored(totals.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts"))
        for bits in (*sent, heavy):
            if bits is not None:
                bits.unpersist()
        failures = found[-1].where(F.col("words").between(1, LONGEST - 1))
        if known is not None:
            failures = failures.join(known.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        failures = stored(failures, "phrase-failures")
        if failures.isEmpty():
            return reduce(DataFrame.unionByName, found), len(found)
        known = failures if known is None else known.select(failures.columns).unionByName(failures)
        counted, proposed = proposed, proposed | _filter_bits(failures)


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _scored(found: DataFrame) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of their lowest-scoring cut, the earliest of several."""
    words = F.split("phrase", " ")
    cuts = (
        found.where("words >= 2")
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang",
            "phrase",
            F.col("n").alias("a"),
            "cut",
            _part(words, F.lit(1), F.col("cut")).alias("first"),
            _part(words, F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"),
        )
    )
    sides = found.where("words >= 1")
    left = sides.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = sides.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"(cast(a AS decimal(20,0)) * {SCORE_UNIT}) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "lowest.*").drop("cut")


def _absorbed(found: DataFrame) -> DataFrame:
    """``lang, phrase`` of the candidates that mostly occur inside a longer one."""
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, s), ' '))))"
    )
    longer = found.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    met = found.where("words >= 2").join(longer, ["lang", "phrase"])
    enough = F.col("longer").cast("decimal(38,0)") * 100 >= F.col("n").cast("decimal(38,0)") * ABSORBED
    return met.where(enough).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    share: float = SAMPLE_SHARE,
) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased in A-Z only and split at ``. , ; : ! ?`` and line ends into pieces, those at blanks and tabs into
    words. ``a`` counts all occurrences of a phrase of 2 to 4 words within pieces, ``l`` and ``r`` those of the two sides of its
    lowest-scoring cut, ``n`` all words of the language; ``score`` is ``floor(2000000 a / (l + r))``. Phrases that lie in a
    longer one with at least 80 % as many occurrences are dropped. Ranked by score, then ``a``, then the phrase's bytes.

    A null language is ``und``. Null and empty texts have no words, a language without words gives no rows, and neither
    does an empty table. Repeated rows count as often as they stand. Very long texts are counted in one piece of their own.
    Ids only decide who is in the sample. Other columns are ignored.

    Tasks count pieces of text with arrays and send one row per phrase and piece; exact totals come from an aggregate.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    lang = F.coalesce(F.col(f"`{lang_column}`"), F.lit(NO_LANGUAGE)).alias("lang")
    texts = docs.select(lang, text)
    picked = F.pmod(F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")), F.lit(1_000_000))
    sample = docs.where(picked < int(share * 1_000_000)).select(lang, text)
    lenient = max(1, round(least * share * SAMPLE_LENIENCE))
    proposals, _ = mined_phrases(sample, lenient)
    found, _ = mined_phrases(texts, least, proposals)
    found = stored(found, "phrases")
    kept = _scored(found).join(_absorbed(found), ["lang", "phrase"], "left_anti")
    total = found.where("words = 0").select("lang", F.col("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
