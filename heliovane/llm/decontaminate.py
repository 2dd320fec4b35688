"""Benchmark passages in documents, found by SimHash windows of each item's size.

Every window of an item's number of words gets a fingerprint over its word shingles. The fingerprints of the items
are indexed by ``radius + 1`` blocks of bits: two fingerprints within the radius agree in at least one block. What the blocks
bring up is compared bit by bit, and then by the exact weighted similarity of the shingles. Blocks are wide enough to bring up
few others, which leaves similar windows beyond the radius: those are supplemented by the shingles that they share with an
item, and go through the same comparison.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import as_before, as_text

BITS = 64

#: Words of a shingle.
SHINGLE = 5

#: Least similarity of a window and an item.
SIMILARITY = 0.8

#: Differing bits up to which fingerprints bring up an item. That makes eight blocks of eight bits, one of which a window
#: that has nothing to do with an item agrees in in 3 % of all cases. Copies differ in none, windows of similarity 0.9 in about
#: 5, those of 0.8 in about 9: what is beyond is found by shared shingles.
RADIUS = 7

#: Items searched for in one pass over the documents, which bounds what is broadcast.
ITEM_BLOCK = 20_000

_words = re.compile(r"\w+").findall

RESULT = "item_id bigint, start_word int, n_words int, distance int, similarity double"


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; punctuation and white space only separate them."""
    return _words((text or "").lower())


def shingles(words: list[str], width: int = SHINGLE) -> list[str]:
    """Runs of ``width`` words, or all words if there are fewer."""
    width = min(width, len(words))
    return [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Shared weight over all weight, a shingle weighing as often as it occurs."""
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if shared else 0.0


def signs(items: list[str]) -> np.ndarray:
    """One row of +1 and -1 for each shingle, from the bits of its hash."""
    hashes = np.array([xxhash.xxh64_intdigest(s.encode("utf-8"), 0) for s in items], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from rows of sums: bit set where the sum is positive."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8")[:, 0]


def block_masks(radius: int) -> list[int]:
    """``radius + 1`` blocks of neighbouring bits that together cover the fingerprint."""
    edges = [round(k * BITS / (radius + 1)) for k in range(radius + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


class Items:
    """A block of benchmark items with the index of their fingerprints."""

    def __init__(self, rows: list[tuple[int, str | None]], radius: int, similarity: float) -> None:
        self.radius, self.similarity, self.masks = radius, similarity, block_masks(radius)
        self.ids, self.bags, self.prints = [], [], []
        self.vocabulary: dict[str, int] = {}
        self.index: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        # For each shingle width: its word numbers folded to one number, and the sizes of the items that have it.
        holders: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        self.codes: list[Counter] = []
        self.sizes: list[int] = []
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            found = shingles(words)
            number, size, width = len(self.ids), len(words), min(SHINGLE, len(words))
            self.ids.append(item_id)
            self.bags.append(Counter(found))
            self.prints.append(int(packed(signs(found).sum(axis=0, keepdims=True))[0]))
            for block, mask in enumerate(self.masks):
                self.index[size, block, self.prints[-1] & mask].append(number)
            coded = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
            self.codes.append(Counter(fold(coded, width).tolist()))
            self.sizes.append(size)
            for code in self.codes[-1]:
                holders[width][code].add(size)
        # Items by their rarest shingles, so many that a window without any of these shares too few of the others.
        held = Counter((min(SHINGLE, size), code) for size, codes in zip(self.sizes, self.codes, strict=True) for code in codes)
        self.rare: dict[tuple[int, int], list[int]] = defaultdict(list)
        for number, (size, codes) in enumerate(zip(self.sizes, self.codes, strict=True)):
            width, left = min(SHINGLE, size), codes.total()
            for code in sorted(codes, key=lambda c: (held[width, c], c)):
                if left < self._least(codes.total()):
                    break
                self.rare[width, code].append(number)
                left -= codes[code]
        self.holders = {width: (np.array(sorted(codes), np.uint64), codes) for width, codes in holders.items()}

    def _least(self, item: int, window: int | None = None) -> int:
        """Shingles that an item and a window of so many must share to be similar enough; at least, of any window."""
        least = self.similarity * (item if window is None else (item + window) / (1 + self.similarity))
        return max(1, math.ceil(least - 1e-9))

    def _hits(self, words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Places of shingles that some item has, and their numbers, by width."""
        coded = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        hits = {}
        for width, (codes, _) in self.holders.items():
            if len(words) < width:
                continue
            known = np.lib.stride_tricks.sliding_window_view(coded != 0, width).all(axis=1)
            places = np.flatnonzero(known)
            values = fold(coded, width, places)
            at = np.minimum(np.searchsorted(codes, values), len(codes) - 1)
            hit = codes[at] == values
            hits[width] = places[hit], values[hit]
        return hits

    def windows(self, words: list[str], hits: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, set[int]]:
        """Starts of the windows to compare, by size: all that contain some shingle of an item of that size.

        A window without any has similarity zero to each of them.
        """
        starts: dict[int, set[int]] = defaultdict(set)
        for width, (places, values) in hits.items():
            holders = self.holders[width][1]
            for place, value in zip(places.tolist(), values.tolist(), strict=True):
                for size in holders[value]:
                    last = max(0, len(words) - size)
                    starts[size].update(range(max(0, min(last, place + width - size)), min(last, place) + 1))
        return starts

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, int, int, float]]:
        """For every item with a window similar enough: ``item_id``, its best window's start and size, the bits
        that differ and the similarity. Ties go to the earlier window."""
        best: dict[int, tuple] = {}
        hits = self._hits(words)
        sharing = self._sharing(words, hits)
        for size, starts in self.windows(words, hits).items():
            for run in runs(sorted(starts)):
                self._compare(words, size, run, sharing, best)
        for number, (negative, start, size, bits) in sorted(best.items()):
            yield self.ids[number], start, size, bits, -negative

    def _sharing(
        self, words: list[str], hits: dict[int, tuple[np.ndarray, np.ndarray]]
    ) -> dict[tuple[int, int], list[int]]:
        """Items, by size and start of a window, of which it holds so many shingles that they may be similar enough."""
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for width, (places, values) in hits.items():
            rare = (self.rare.get((width, value), ()) for value in np.unique(values).tolist())
            for number in sorted(set(chain.from_iterable(rare))):
                item_size = self.sizes[number]
                size = min(len(words), item_size)
                count = size - width + 1
                least = self._least(self.codes[number].total(), count)
                own = places[np.isin(values, np.array(list(self.codes[number]), np.uint64))]
                if least > count or len(own) < least:
                    continue
                # A window with enough of these places holds some ``least`` neighbouring ones.
                lows = np.maximum(own[least - 1 :] - count + 1, 0)
                highs = np.minimum(own[: len(own) - least + 1], len(words) - size)
                after = 0
                for low, high in zip(lows.tolist(), highs.tolist(), strict=True):
                    for start in range(max(low, after), high + 1):
                        found[item_size, start].append(number)
                    after = max(after, high + 1)
        return found

    def _compare(
        self,
        words: list[str],
        item_size: int,
        run: range,
        sharing: dict[tuple[int, int], list[int]],
        best: dict[int, tuple],
    ) -> None:
        """Windows of items of that size that start in ``run``; a document shorter than the item is one window."""
        size, width = min(len(words), item_size), min(SHINGLE, item_size)
        part = words[run.start : run.stop - 1 + size]
        found = [" ".join(part[i : i + width]) for i in range(len(part) - width + 1)]
        total = np.zeros((len(found) + 1, BITS), np.int32)
        np.cumsum(signs(found), axis=0, out=total[1:])
        count = size - width + 1
        for offset, print_ in enumerate(packed(total[count:] - total[:-count]).tolist()):
            bag = None
            near = self._near(print_, item_size)
            alike = sharing.get((item_size, run.start + offset), ())
            for number in near.union(alike):
                bits = (print_ ^ self.prints[number]).bit_count()
                # Within the radius the blocks bring up what is compared, beyond it the shingles do.
                if number not in (near if bits <= self.radius else alike):
                    continue
                bag = bag if bag is not None else Counter(found[offset : offset + count])
                similarity = weighted_similarity(bag, self.bags[number])
                if similarity >= self.similarity:
                    key = (-similarity, run.start + offset, size, bits)
                    best[number] = min(best.get(number, key), key)

    def _near(self, print_: int, size: int) -> set[int]:
        """Items of that size whose fingerprint agrees in some block."""
        return set(
            chain.from_iterable(
                self.index.get((size, block, print_ & mask), ()) for block, mask in enumerate(self.masks)
            )
        )


def fold(coded: np.ndarray, width: int, places: np.ndarray | None = None) -> np.ndarray:
    """``width`` neighbouring word numbers folded to one number, at the given places or everywhere."""
    places = np.arange(len(coded) - width + 1) if places is None else places
    total = np.zeros(len(places), np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + coded[places + k]
    return total


def runs(numbers: list[int]) -> Iterator[range]:
    """Runs of neighbouring numbers, cut so that none is much longer than a passage."""
    first = last = None
    for n in numbers:
        if first is not None and (n != last + 1 or n - first >= 2048):
            yield range(first, last + 1)
            first = n
        first, last = n if first is None else first, n
    if first is not None:
        yield range(first, last + 1)


def item_blocks(items: DataFrame, size: int = ITEM_BLOCK) -> Iterator[list[tuple[int, str | None]]]:
    """Distinct ``item_id, text`` in blocks; the driver holds one block at a time."""
    block = []
    for row in items.select("item_id", "text").distinct().toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """One row per document and benchmark item (``item_id, text``) that it holds:
    ``doc_id, text_hash, item_id, start_word, n_words, distance, similarity``.

    The row describes the document's window nearest to the item, the earlier one on ties: its first word (from 0), its words,
    the bits its fingerprint differs in, and the similarity of the word shingles, weighted by how often they occur.
    Null and empty texts and items match nothing; an item of fewer words than a shingle matches only as a whole; a
    document shorter than an item is compared as one window. Repeated rows give repeated results, items that occur twice
    count once, empty tables give an empty result, other columns are ignored.

    Documents are scanned once for every ``item_block`` items and never shuffled. The driver and the tasks hold one block.
    """
    context = docs.sparkSession.sparkContext
    narrow = docs.select(
        as_text(id_column, "doc_id"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        F.col(text_column).alias("text"),
    )
    schema = f"doc_id string, text_hash bigint, {RESULT}"
    columns = [part.split()[0] for part in schema.split(", ")]

    def scan(block: list[tuple[int, str | None]]) -> DataFrame:
        shared = context.broadcast(block)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = Items(shared.value, radius, similarity)
            for batch in batches:
                rows: list[tuple] = []
                for doc_id, text_hash, text in batch.itertuples(index=False):
                    rows += [(doc_id, text_hash, *match) for match in known.matches(words_of(text))]
                yield pd.DataFrame(rows, columns=columns)

        return narrow.mapInPandas(run, schema)

    found = [scan(block) for block in item_blocks(items, item_block)]
    result = found[0] if found else docs.sparkSession.createDataFrame([], schema)
    for more in found[1:]:
        result = result.unionByName(more)
    return as_before(result, "doc_id", dict(docs.dtypes)[id_column])
