"""Repeated byte strings across documents, found by sorting suffixes.

A string of ``window`` bytes occurs twice only if the smallest hash of its grams does, so every window is represented by
an anchor, the place of its leftmost smallest gram; one in about 140 places is an anchor. Windows with one anchor start
at neighbouring places and together form its span. Anchors with equal grams are brought together:

- spans that occur twice as a whole are repeated as a whole, and a hash tells;
- the others are settled by sorting the suffixes that start at the anchors: a multikey quicksort orders them
  to a shallow depth, blind tries order what is still equal there, and common prefixes of neighbours, within groups whose bytes
  before the anchor agree, tell which windows occur twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import as_before, same_document, stored

#: Bytes of a string that counts as repeated, and of the grams among which anchors are chosen.
WINDOW = 400
GRAM = 128

#: Bytes of a text whose anchors are found at once.
PIECE = 1 << 18

#: Bytes up to which quicksort orders suffixes, and how many it compares at a time.
SHALLOW = 160
WORD = 8

#: Different spans of one gram that a task sorts. For more, the windows themselves are counted.
GROUP_LIMIT = 4096

_BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    filled, step = 1, base
    while filled < count:
        size = min(filled, count - filled)
        out[filled : filled + size] = out[:size] * np.uint64(step)
        filled, step = filled + size, step * step & _MASK
    return out


_tables: dict[str, np.ndarray] = {}


def _table(name: str, size: int) -> np.ndarray:
    """At least ``size`` powers of the hash base, or of its inverse."""
    if len(_tables.get(name, ())) < size:
        base = _BASE if name == "powers" else pow(_BASE, -1, 1 << 64)
        _tables[name] = _powers(base, max(size, PIECE + 2 * WINDOW))
    return _tables[name]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A well mixed hash of every gram of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    powers = _table("powers", len(data))[: len(data)]
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _table("inverse", len(data))[: len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(_BASE)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks in both directions."""
    count = len(values)
    padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: count - width + 1], ahead[width - 1 : count])


def anchors(
    text: bytes, window: int = WINDOW, gram: int = GRAM
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece of a text: places of its anchors, their gram hashes, and the first and last start of their
    windows. Which gram stands for a window depends on the window's bytes alone."""
    places = np.uint64(PIECE * 2 - 1)
    for at in range(0, max(0, len(text) - window + 1), PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + window - 1, len(text) - at), at)
        hashes = gram_hashes(data, gram)
        # The place in the lower bits makes the leftmost of equal grams the smallest.
        keyed = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (sliding_minimum(keyed, window - gram + 1) & places).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.concatenate((first[1:] - 1, [len(chosen) - 1]))
        yield chosen[first] + at, hashes[chosen[first]].view(np.int64), first + at, last + at


def _common(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common from the start."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size - (differ.bit_length() + 7) // 8


def sort_suffixes(suffixes: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Numbers of the suffixes in order: multikey quicksort to a shallow depth, blind tries below it."""
    out: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(suffixes))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out += group
        elif depth >= shallow:
            out += blind_sort(suffixes, group)
        else:
            keys = [suffixes[k][depth : depth + WORD] for k in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            parts: tuple[list[int], list[int], list[int]] = ([], [], [])
            for k, key in zip(group, keys, strict=True):
                parts[(key >= pivot) + (key > pivot)].append(k)
            # Suffixes that end inside the pivot's word are equal.
            deeper = depth + WORD if len(pivot) == WORD else shallow
            todo += [(parts[2], depth), (parts[1], deeper), (parts[0], depth)]
    return out


class _Branch:
    """A node of a blind trie: how many bytes its leaves share, and the child for each next byte (-1: the end)."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int) -> None:
        self.depth, self.children = depth, {}


def blind_sort(suffixes: list[bytes], group: list[int]) -> list[int]:
    """Numbers of a group in order. Each suffix walks down by its branching bytes only, is compared once with the
    leaf it meets, and enters where they part. Leaves hold equal suffixes."""
    root: _Branch | list[int] = [group[0]]
    for number in group[1:]:
        suffix = suffixes[number]
        node = root
        while isinstance(node, _Branch):
            byte = suffix[node.depth] if node.depth < len(suffix) else -1
            node = node.children.get(byte) or next(iter(node.children.values()))
        other = suffixes[node[0]]
        shared = _common(suffix, other)
        if shared == len(suffix) == len(other):
            node.append(number)
            continue
        # Down again to where the branch at the shared depth is, or belongs.
        parent, edge, node = None, -1, root
        while isinstance(node, _Branch) and node.depth < shared:
            edge = suffix[node.depth]
            parent, node = node, node.children[edge]
        if not isinstance(node, _Branch) or node.depth > shared:
            branch = _Branch(shared)
            branch.children[other[shared] if shared < len(other) else -1] = node
            if parent is None:
                root = branch
            else:
                parent.children[edge] = branch
            node = branch
        node.children[suffix[shared] if shared < len(suffix) else -1] = [number]
    out: list[int] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, _Branch):
            todo += [node.children[byte] for byte in sorted(node.children, reverse=True)]
        else:
            out += node
    return out


def repeated_starts(spans: list[bytes], offsets: list[int], window: int) -> list[tuple[int, int, int]]:
    """``number, first, last``: which windows of each span, by their starts, occur in another one.

    ``offsets`` are the places of the anchors; windows are compared with the same place before the anchor. Starting from the
    spans in the order of their suffixes, groups are split by the bytes before the anchor, one branching at a time. In
    a group that shares ``o`` bytes there, a span's longest common prefix is with a neighbour.
    """
    rights = [span[at:] for span, at in zip(spans, offsets, strict=True)]
    lefts = [span[:at][::-1] for span, at in zip(spans, offsets, strict=True)]
    order = sort_suffixes(rights)
    shared = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    found: list[tuple[int, int, int]] = []
    todo = [(order, shared, 0)]
    while todo:
        group, prefix, depth = todo.pop()
        least, most = lefts[group[0]], len(lefts[group[0]])
        for k in group[1:]:
            most = min(most, _common(least[:most], lefts[k]))
        for i, k in enumerate(group):
            best = max(prefix[i - 1] if i else 0, prefix[i] if i < len(prefix) else 0)
            first = max(depth, window - best)
            if first <= most:
                found.append((k, offsets[k] - most, offsets[k] - first))
        children: dict[int, tuple[list[int], list[int]]] = {}
        gaps: dict[int, int] = {}
        for i, k in enumerate(group):
            # The prefix shared with the last member of each child is the smallest in between.
            if i:
                for byte in gaps:
                    gaps[byte] = min(gaps[byte], prefix[i - 1])
            if most < len(lefts[k]):
                byte = lefts[k][most]
                members, between = children.setdefault(byte, ([], []))
                if members:
                    between.append(gaps[byte])
                members.append(k)
                gaps[byte] = window
        todo += [(members, between, most + 1) for members, between in children.values() if len(members) > 1]
    return found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order; those that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, packed``: texts compressed, so that they can be shuffled for little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([squeeze(text.as_buffer()) for text in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed], ["doc_id", "text_hash", "packed"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash bigint, packed binary")


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, gram bigint, span bigint, place int, first int, last int"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows, parts, held = [], [], 0

            def made() -> pa.RecordBatch:
                owner = pa.array(np.repeat([r for r, _ in rows], [n for _, n in rows]).astype(np.int64))
                gram_, span, place, first, last = (np.concatenate(column) for column in zip(*parts, strict=True))
                values = [gram_, span.view(np.int64), *(c.astype(np.int32) for c in (place, first, last))]
                keys = [column.take(owner) for column in batch.columns[:2]]
                return pa.RecordBatch.from_arrays([*keys, *map(pa.array, values)], names)

            for row, text in enumerate(batch.column(2)):
                data = text.as_py()
                view = memoryview(data)
                for place, hashes, first, last in anchors(data, window, gram):
                    ends, offsets = (last + window).tolist(), (place - first).tolist()
                    bounds = zip(first.tolist(), ends, offsets, strict=True)
                    span = np.array([digest(view[a:b], o) for a, b, o in bounds], np.uint64)
                    rows.append((row, len(place)))
                    parts.append((hashes, span, place, first, last))
                    held += len(place)
                    if held >= 1 << 16:
                        yield made()
                        rows, parts, held = [], [], 0
            if parts:
                yield made()

    return docs.mapInArrow(run, schema)


_KEY = ["doc_id", "text_hash"]


def _spans_with_text(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` (gram, place, first, last of a document) with the bytes of each span."""
    per_doc = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("gram", "place", "first", "end")).alias("wanted"))
    # Equal documents give a span several times, which is then repeated anyway.
    joined = same_document(_packed(docs), per_doc, "inner")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, gram bigint, first int, at int, span binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                text = expand(batch.column(2)[row].as_py())
                asked = batch.column(3)[row].as_py()
                keys = [column.take(pa.array([row] * len(asked))) for column in batch.columns[:2]]
                values = [
                    pa.array([s["gram"] for s in asked], pa.int64()),
                    pa.array([s["first"] for s in asked], pa.int32()),
                    pa.array([s["place"] - s["first"] for s in asked], pa.int32()),
                    pa.array([text[s["first"] : s["end"]] for s in asked], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *values], ["doc_id", "text_hash", "gram", "first", "at", "span"]
                )

    return joined.select(*_KEY, "packed", "wanted").mapInArrow(run, schema)


def _sorted_ranges(spans: DataFrame, window: int) -> DataFrame:
    """Repeated ranges out of the spans of each gram, which lie together in a task."""
    schema = f"doc_id {dict(spans.dtypes)['doc_id']}, text_hash bigint, start int, end int"

    def settle(held: pa.Table) -> pa.RecordBatch:
        texts, at = held["span"].to_pylist(), held["at"].to_pylist()
        gram = held["gram"].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1], [True]))).tolist()
        rows, starts, ends = [], [], []
        first = held["first"].to_pylist()
        for a, b in zip(edges, edges[1:], strict=False):
            for k, low, high in repeated_starts(texts[a:b], at[a:b], window):
                rows.append(a + k)
                starts.append(first[a + k] + low)
                ends.append(first[a + k] + high + window)
        picked = held.select(_KEY).take(pa.array(rows, pa.int64())).combine_chunks()
        columns = [pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
        table = pa.table([*picked.columns, *columns], names=[*_KEY, "start", "end"]).combine_chunks()
        return table.to_batches()[0] if table.num_rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            gram = held["gram"].to_numpy()
            whole = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            if whole:
                if (done := settle(held.slice(0, whole))) is not None:
                    yield done
                held = held.slice(whole)
        if held is not None and held.num_rows and (done := settle(held)) is not None:
            yield done

    dealt = spans.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, schema)


def _counted_ranges(spans: DataFrame, window: int) -> DataFrame:
    """The same for grams with very many different spans: every window is counted by its hash and its place before the anchor."""
    schema = "doc_id string, text_hash bigint, gram bigint, offset int, start int, h1 bigint, h2 bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                count = len(row.span) - window + 1
                sums = [xxhash.xxh3_128_digest(row.span[k : k + window]) for k in range(count)]
                h = np.frombuffer(b"".join(sums), "<i8").reshape(-1, 2)
                places = np.arange(count)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.Series([row.doc_id] * count, dtype=object),
                        "text_hash": row.text_hash,
                        "gram": row.gram,
                        "offset": row.at - places,
                        "start": row.first + places,
                        "h1": h[:, 0],
                        "h2": h[:, 1],
                    }
                )

    kind = dict(spans.dtypes)["doc_id"]
    windows = as_before(as_before(spans, "doc_id", "string").mapInPandas(run, schema), "doc_id", kind)
    key = ["gram", "offset", "h1", "h2"]
    twice = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(twice, key).select(*_KEY, "start", (F.col("start") + window).alias("end"))


def repeated_ranges(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, limit: int = GROUP_LIMIT
) -> DataFrame:
    """``doc_id, text_hash, start, end``: ranges whose union is all bytes of repeated windows, for documents
    (``doc_id, text_hash, text`` as bytes). Equal rows are separate documents that repeat each other."""
    found = stored(_anchor_rows(docs, window, gram), "anchors")
    grams = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("places"), F.min("span").alias("low"), F.max("span").alias("high")
    )
    grams = grams.where("places > 1").select("gram", (F.col("low") != F.col("high")).alias("varied"))
    # Stored, so that the join below reads both sides from exchanges and can split a gram with very many places.
    grams = stored(grams, "grams")
    twice = stored(found.join(grams, "gram"), "anchors-twice")
    whole = (F.col("last") + window).alias("end")
    alike = twice.where(~F.col("varied")).select(*_KEY, F.col("first").alias("start"), whole)
    varied = twice.where("varied")
    # Anchors of equal spans are settled by their number; the first that comes stands for all in the sort.
    one = F.first(F.struct(*_KEY, "place", "first", whole)).alias("one")
    spans = stored(varied.groupBy("gram", "span").agg(F.count(F.lit(1)).alias("copies"), one), "anchors-spans")
    sizes = stored(spans.groupBy("gram").agg(F.count(F.lit(1)).alias("spans")), "anchors-grams")
    repeated = spans.where("copies > 1").select("gram", "span")
    copied = varied.join(repeated, ["gram", "span"], "left_semi")
    copied = copied.select(*_KEY, F.col("first").alias("start"), whole)
    asked = spans.select("one.*", "gram")
    hot = sizes.where(F.col("spans") > limit).select("gram")
    texts = stored(_spans_with_text(asked, docs), "anchors-texts")
    ranges = alike.unionByName(copied)
    if hot.isEmpty():
        return ranges.unionByName(_sorted_ranges(texts, window))
    calm = texts.join(hot, "gram", "left_anti")
    crowded = texts.join(hot, "gram", "left_semi").select(texts.columns)
    return ranges.unionByName(_sorted_ranges(calm.select(texts.columns), window)).unionByName(
        _counted_ranges(crowded, window)
    )


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` for every row: the size of its text in UTF-8, the byte ranges
    ``start, end`` that are covered by strings of ``window`` bytes which also start at another place of the table, in
    order and apart from each other, and the bytes that are left.

    Strings are judged on the input, overlaps and the same document included, and never cross documents. Null texts
    are empty. Repeated rows repeat each other; a null id stays null; an empty table gives an empty result; other columns are
    ignored.

    Texts are shuffled twice, compressed: to cut out the spans that have to be sorted, and to take the ranges out. Anchors
    are shuffled as numbers. Equal spans are combined before the shuffle; grams with more than ``limit`` different spans are
    not sorted in one task, their windows are counted instead, which gives the same ranges.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    ranges = repeated_ranges(narrow, window, gram, limit)
    per_doc = ranges.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = same_document(_packed(narrow), per_doc, "left").select("doc_id", "packed", "ranges")
    schema = (
        f"doc_id {dict(narrow.dtypes)['doc_id']}, n_bytes bigint, "
        "removed array<struct<start: int, end: int>>, kept binary"
    )
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, kept = [], [], []
            for packed, found in zip(batch.column(1), batch.column(2), strict=True):
                text = expand(packed.as_py())
                cut = merged([(r["start"], r["end"]) for r in found.as_py() or ()])
                edges = [0, *[x for r in cut for x in r], len(text)]
                sizes.append(len(text))
                removed.append([{"start": a, "end": b} for a, b in cut])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pair), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    return joined.mapInArrow(run, schema)
