"""SimHash near-duplicates through covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Each bit position gets a
nonzero vector of ``radius + 1`` bits, and each nonzero vector ``v`` of that length gives a mask of the
positions whose vector has an odd product with ``v``. The vectors of at most ``radius`` differing positions
are orthogonal to some ``v``, so two fingerprints within the radius agree under that mask: no pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import as_before, as_text, stored
from heliovane.llm.components import connected_components

BITS = 64
HASH_SEED = 42

#: Shingles whose bits are counted at once, which bounds the memory of a long text.
BLOCK = 1 << 15

#: Fingerprints of one bucket that a task compares in memory. Larger buckets are masked again.
BUCKET_LIMIT = 1024

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of UTF-8 bytes: A-Z lower-cased, words between ASCII white space, XXH64 of each
    shingle. A bit is 1 if more than half of the hashes have it. Fewer words are one shingle; none give 0."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones, total = np.zeros(BITS, np.int64), len(first)
    for at in range(0, total, BLOCK):
        spans = zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > total, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row; ``fp`` holds the 64 bits in a signed long. Null texts have no words."""
    narrow = docs.select(
        as_text(id_column, "doc_id"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        F.col(text_column).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([fingerprint(text, shingle) for text in batch["text"]], np.uint64)
            yield batch[["doc_id", "text_hash"]].assign(fp=values.view(np.int64))

    found = narrow.mapInPandas(run, "doc_id string, text_hash bigint, fp bigint")
    return as_before(found, "doc_id", dict(docs.dtypes)[id_column])


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Unsigned masks over the given bit positions, one for each nonzero vector of ``radius + 1`` bits."""
    top = 1 << (radius + 1)
    vectors = {position: 1 + k % (top - 1) for k, position in enumerate(positions)}
    return [
        sum(1 << p for p, vector in vectors.items() if (vector & v).bit_count() % 2)
        for v in range(1, top)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _under_masks(fp: Column, masks: list[int]) -> Column:
    """Array of ``(table, key)``, one for each mask."""
    keys = [
        F.struct(F.lit(k).alias("table"), fp.bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for k, mask in enumerate(masks)
    ]
    return F.array(*keys)


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is within the radius among the distinct values, one fewer than the members of each
    component: a search that compares each reached value with all not yet reached."""
    rest, links = values.view(np.uint64).copy(), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                links += [(at, other) for other in reached]
                queue += list(reached)
    return [(_signed(int(a)), _signed(int(b))) for a, b in links]


def _bucket_links(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links inside each bucket; a bucket's rows lie together and no bucket is larger than the limit allows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = (held[keys] == held[keys].iloc[-1]).all(axis=1).to_numpy()
            ready, held = held[~last], held[last]
            yield linked(ready)
        if held is not None:
            yield linked(held)

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        if len(frame):
            change = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)
            for group in np.split(frame["fp"].to_numpy(np.int64), np.flatnonzero(change) + 1):
                if len(group) > 1:
                    links += forest(group, radius)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(run, "a bigint, b bigint")


def links_within(fps: DataFrame, radius: int, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect distinct fingerprints (column ``fp``) exactly as all pairs within the
    radius would.

    Buckets of one fingerprint vanish in a count. Buckets above ``limit`` are masked once more over the bits
    that their mask left free, which keeps the guarantee and leaves at most 2**(free bits) members:
    about 16,000 for radius 3. Within a bucket only a spanning forest comes out, never all pairs.
    """
    masks = covering_masks(list(range(BITS)), radius)
    first = fps.select("fp", F.inline(_under_masks(F.col("fp"), masks)))
    counts = first.groupBy("table", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # Stored, so that the join reads both sides from exchanges and a large bucket can be split.
    counts = stored(counts, "simhash-counts")
    shared = stored(first.join(counts, ["table", "key"]), "simhash-buckets")
    small = shared.where(F.col("members") <= limit).select("table", "key", "fp")
    links = _bucket_links(small, ["table", "key"], radius)
    hot = shared.where(F.col("members") > limit)
    again = F.lit(None)
    for k, mask in enumerate(masks):
        free = [p for p in range(BITS) if not mask >> p & 1]
        inner = _under_masks(F.col("fp"), covering_masks(free, radius))
        again = F.when(F.col("table") == k, inner).otherwise(again)
    hot = hot.withColumn("again", F.explode(again)).select(
        "table", "key", F.col("again.table").alias("table2"), F.col("again.key").alias("key2"), "fp"
    )
    keys = ["table", "key", "table2", "key2"]
    counts = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    hot = hot.join(counts, keys).select(*keys, "fp")
    return links.unionByName(_bucket_links(hot, keys, radius)).distinct()


def _grouped(docs: DataFrame, id_column: str, text_column: str, shingle: int, radius: int) -> DataFrame:
    """Every row with its fingerprint, the name of its component and what is known of both."""
    rows = stored(fingerprints(docs, id_column, text_column, shingle), "simhash")
    fps = stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "simhash-distinct",
    )
    found = connected_components(links_within(fps.select("fp"), radius))
    joined = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.withColumn("component", F.coalesce("component", "fp"))
    groups = joined.groupBy("component").agg(
        F.min("least").alias("component_id"), F.sum("copies").alias("members")
    )
    return rows.join(joined.join(groups, "component").drop("least"), "fp")


def simhash_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, copies, linked``.

    Rows are linked if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    id reachable, ``copies`` the rows with the same fingerprint, ``linked`` whether the component has other rows.
    Null and empty texts share fingerprint zero. Repeated rows share a component; a null id never names one unless all
    of its component are null. An empty table gives an empty result; other columns are ignored.

    Equal fingerprints are combined before the shuffle, so copies cost one row per task. Only joins that adaptive
    execution can split meet them again.
    """
    rows = _grouped(docs, id_column, text_column, shingle, radius)
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "copies",
        (F.col("members") > 1).alias("linked"),
    )


def simhash_representatives(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """``doc_id, text_hash, rows``: one document for each component of ``simhash_components``, that of the smallest id, null
    ids last; ``rows`` counts the rows that repeat it."""
    grouped = _grouped(docs, id_column, text_column, shingle, radius)
    rows = grouped.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("component").orderBy(F.asc_nulls_last("doc_id"), "text_hash")
    first = rows.withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.select("doc_id", "text_hash", "rows")
