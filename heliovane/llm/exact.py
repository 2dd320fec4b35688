"""Exact duplicates against an index of historical texts: a minimal perfect hash whose slots hold digests and winners.

The distinct digests of the history are dealt into shards of bounded size. Each shard gets a minimal perfect hash: levels of
bit arrays, in which a digest takes the first place that it shares with no other digest left at that level; the bits before it
number its slot, so that ``n`` digests fill the slots from 0 to ``n - 1``. A slot holds the whole digest and where the row
that stays is found. A digest from outside lands on a slot or on none; only comparing all its bytes with the slot's tells
whether it is a member. Members join the slot's group, all others are grouped among themselves.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import stored

#: Distinct digests that a shard has on average, of the history or of the texts looked up in it.
SHARD_DIGESTS = 20_000

#: Groups of more than one row whose keys are broadcast when texts are compared; more are joined by a shuffle.
BROADCAST_GROUPS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEVELS = 256

Digest = Callable[[Column, int], Column]


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case, null as the empty text."""
    text = F.coalesce(text, F.lit(""))
    # Where all characters are ASCII, lower() does the same and is faster.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def sha256(text: Column, salt: int = 0) -> Column:
    """32 bytes. A salt gives other digests of the same texts."""
    return F.unhex(F.sha2(text if salt == 0 else F.concat(F.lit(f"{salt}:"), text), 256))


def _digest_words(digests: pa.ChunkedArray) -> np.ndarray:
    """Digests of one length as rows of 64-bit numbers."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(len(digests), -1)
    padded = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    padded[:, : raw.shape[1]] = raw
    return padded.view(np.uint64)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    bits = np.full(len(words), level + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in words.T:
        bits ^= column
        bits = (bits ^ (bits >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        bits ^= bits >> np.uint64(29)
    return (bits % np.uint64(size)).astype(np.int64)


def perfect_slots(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slots 0 to ``n - 1`` of ``n`` distinct digests, and the levels that lead there."""
    slots, levels, used = np.zeros(len(words), np.int64), [], 0
    left = np.arange(len(words))
    while len(left):
        if len(levels) == _LEVELS:
            raise ValueError("digests are not distinct")
        size = -(-len(left) // 64) * 64
        place = _places(words[left], len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        first = alone[place]
        slots[left[first]] = used + np.cumsum(alone)[place[first]] - 1
        used += int(alone.sum())
        levels.append(alone)
        left = left[~first]
    return slots, levels


def found_slots(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot that each digest leads to, -1 for none. A member's slot is its own, any other digest may lead anywhere."""
    slots, used = np.full(len(words), -1, np.int64), 0
    left = np.arange(len(words))
    for level, alone in enumerate(levels):
        place = _places(words[left], level, len(alone))
        first = alone[place]
        slots[left[first]] = used + np.cumsum(alone)[place[first]] - 1
        used += int(alone.sum())
        left = left[~first]
    return slots


def _indexed(history: pa.Table) -> pa.Table:
    """The rows of one shard in the order of their slots. The first also holds the levels."""
    slots, levels = perfect_slots(_digest_words(history["key"]))
    order = np.argsort(slots)
    packed = [[np.packbits(level).tobytes() for level in levels]] + [None] * (len(order) - 1)
    ordered = history.take(pa.array(order))
    return ordered.append_column("slot", pa.array(slots[order])).append_column("levels", pa.array(packed, pa.list_(pa.binary())))


def digest_index(history: DataFrame) -> DataFrame:
    """The index of distinct ``key`` with ``shard, doc_id, place, rows``: the same with ``slot`` and, at slot 0, ``levels``."""
    fields = ", ".join(f"`{name}` {kind}" for name, kind in history.dtypes)
    return history.groupBy("shard").applyInArrow(_indexed, f"{fields}, slot bigint, levels array<binary>")


def _merged(index: pa.Table, incoming: pa.Table) -> pa.Table:
    """One row per group of a shard: the slots, with what the incoming members add, and the nonmembers."""
    names = incoming.column_names
    if not len(index) or not len(incoming):
        return pa.concat_tables([index.select(names), incoming])
    # Slots may arrive in any order.
    index = index.sort_by("slot")
    levels = [np.unpackbits(np.frombuffer(level, np.uint8)).astype(bool) for level in index["levels"][0].as_py()]
    words = _digest_words(incoming["key"])
    slots = found_slots(words, levels)
    held = _digest_words(index["key"])
    member = slots >= 0
    member[member] = (held[slots[member]] == words[member]).all(axis=1)
    # Incoming digests are distinct, so a slot has one member at most.
    taken = np.full(len(index), -1, np.int64)
    taken[slots[member]] = np.flatnonzero(member)
    added = incoming.take(pa.array(taken, mask=taken < 0))
    later = pc.fill_null(pc.greater(added["doc_id"], index["doc_id"]), False)
    later = pc.or_(later, pc.and_(pc.is_null(index["doc_id"]), pc.is_valid(added["doc_id"])))
    changed = {
        "doc_id": pc.if_else(later, added["doc_id"], index["doc_id"]),
        "place": pc.if_else(later, added["place"], index["place"]),
        "rows": pc.add(index["rows"], pc.fill_null(added["rows"], 0)),
    }
    groups = pa.table({name: changed.get(name, index[name]) for name in names}).cast(incoming.schema)
    return pa.concat_tables([groups, incoming.filter(pa.array(~member))])


def merged_groups(index: DataFrame, incoming: DataFrame) -> DataFrame:
    """The groups of the history and of distinct incoming digests together, in the columns of ``incoming``."""
    pairs = index.groupBy("shard").cogroup(incoming.groupBy("shard"))
    return pairs.applyInArrow(_merged, ", ".join(f"`{name}` {kind}" for name, kind in incoming.dtypes))


def _distinct(keyed: DataFrame) -> DataFrame:
    """Digests of the history and of the other rows, each with its last row and its number of rows."""
    last = F.coalesce(F.max_by("place", "doc_id"), F.max("place"))
    return keyed.groupBy("past", "key").agg(
        F.max("doc_id").alias("doc_id"), last.alias("place"), F.count(F.lit(1)).alias("rows")
    )


def _collide(texts: DataFrame, groups: DataFrame) -> bool:
    """Whether the texts of some group differ. Only texts of groups of several rows are compared, byte by byte.

    Each task sends at most the least and the greatest text that it has of a group.
    """
    several = groups.where("rows > 1").select(F.xxhash64("key").alias("group")).distinct()
    several = stored(several, "exact-several")
    if several.count() <= BROADCAST_GROUPS:
        several = F.broadcast(several)
    met = texts.withColumn("group", F.xxhash64("key")).join(several, "group", "left_semi")
    ends = met.groupBy("key").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    return not ends.where("low <> high").isEmpty()


def exact_groups(
    docs: DataFrame,
    past: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Digest = sha256,
    shard_digests: int = SHARD_DIGESTS,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are the same bytes after lower-casing A-Z; null is the empty text, and empty texts are a group
    like any other. The row of the largest id stays (null ids come before all others, and of rows of one id any one stays), and
    ``keep_id`` names it. ``past`` tells the rows of the history, all if not given; null counts as not. It decides what is
    indexed and what is looked up, not what comes out. Very long texts take part by their digests and are compared where their
    group has several rows. An empty table gives an empty result; other columns are ignored.

    Copies are combined before they are shuffled, as digests. Should texts of one digest differ, digests of another salt
    are taken, so that the result is exact.
    """
    text = normalised(F.col(f"`{text_column}`"))
    whole = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.lit(True) if past is None else past, F.lit(False)).alias("past"),
        text.alias("text"),
    )
    salt = 0
    while True:
        texts = whole.withColumn("key", digest(F.col("text"), salt))
        sha = F.col("key") if digest is sha256 and salt == 0 else sha256(F.col("text"))
        keyed = texts.select("doc_id", "past", F.monotonically_increasing_id().alias("place"), "key", sha.alias("sha"))
        keyed = stored(keyed, "exact-rows")
        distinct = stored(_distinct(keyed), "exact-digests")
        sizes = dict(distinct.groupBy("past").count().collect())
        shards = max(1, -(-max(sizes.values(), default=0) // shard_digests))
        distinct = distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
        index = stored(digest_index(distinct.where("past").drop("past")), "exact-index")
        groups = stored(merged_groups(index, distinct.where("not past").drop("past")), "exact-groups")
        if not _collide(texts.select("key", "text"), groups):
            break
        salt += 1
    winners = groups.select(
        "key", F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place"), F.col("rows").alias("group_size")
    )
    return keyed.join(winners, "key").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
