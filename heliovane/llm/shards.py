"""Shards along a Hilbert curve over metadata.

Rows that are near in all chosen dimensions get near positions on the curve. Runs of it are
the shards, so the minimum and maximum of every dimension are tight in each file and a reader can skip
files by any of them. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import let, stored

#: Cells per dimension are 2**BITS.
BITS = 4

#: Bytes counted for a row besides its text.
ROW_BYTES = 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (none for null) plus the bytes of the rest of the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def ordered(name: str, kind: str) -> Column:
    """A column as something in the same order: strings as they are, by their bytes, others as a number."""
    return F.col(name) if kind == "string" else F.col(name).cast("double")


def string_bounds(df: DataFrame, name: str, shares: list[float]) -> list[str]:
    """The values at which these shares of the rows with a value are reached, in ascending order.

    Equal values are counted first. The counts are sorted in ranges, of which one row each gives what lies before it.
    """
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = counts.repartitionByRange(partitions, "value").sortWithinPartitions("value")
    counted = stored(counted.withColumn("place", F.monotonically_increasing_id()), "shard-values")
    counted = counted.withColumn("piece", F.shiftright("place", 33))
    # One row per partition of the sort.
    pieces = counted.groupBy("piece").agg(F.sum("rows").alias("rows")).orderBy("piece").collect()
    total, offsets = 0, []
    for row in pieces:
        offsets.append((row["piece"], total))
        total += row["rows"]
    offset = df.sparkSession.createDataFrame(offsets, "piece bigint, rows_before bigint")
    reached = F.col("rows_before") + F.sum("rows").over(Window.partitionBy("piece").orderBy("place"))
    counted = counted.join(F.broadcast(offset), "piece").withColumn("reached", reached)
    wanted = [max(1, math.ceil(share * total)) for share in shares]
    at = F.exists(F.array(*map(F.lit, wanted)), lambda w: (w <= F.col("reached")) & (w > F.col("reached") - F.col("rows")))
    return sorted({row["value"] for row in counted.where(at).select("value").collect()}, key=lambda v: v.encode())


def quantile_bounds(df: DataFrame, names: list[str], bits: int = BITS) -> dict[str, list]:
    """At most 2**bits - 1 ascending bounds for each column, from all rows."""
    cells = 2**bits
    shares = [i / cells for i in range(1, cells)]
    texts = [name for name in names if dict(df.dtypes)[name] == "string"]
    numbers = [name for name in names if name not in texts]
    found = {name: string_bounds(df, name, shares) for name in texts}
    if numbers:
        row = df.agg(*[F.percentile_approx(name, shares, 100_000).alias(name) for name in numbers]).first()
        found |= {name: sorted(set(row[name] or [])) for name in numbers}
    return found


def cell_of(value: Column, bounds: list, bits: int = BITS) -> Column:
    """Number of bounds below the value, spread over 2**bits cells so that a dimension of few values
    weighs as much as others; null counts as the lowest."""
    if not bounds:
        return F.lit(0).cast("bigint")
    below = F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound < value)
    rank = F.coalesce(F.size(below), F.lit(0))
    return F.floor(rank * 2**bits / (len(bounds) + 1)).cast("bigint")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a point with ``bits`` bits in each of its cells.

    From the highest bit down, the bits of all dimensions choose a corner of the cube; the corner is
    read in the frame of the subcube reached so far (``entry``, ``axis``) and turned from Gray code
    into the next digits of the index.
    """
    n = len(cells)
    if not 2 <= n <= 8 or n * bits > 62:
        raise ValueError("a curve needs 2 to 8 dimensions and at most 62 bits")
    full = (1 << n) - 1

    def gray(x: Column) -> Column:
        return x.bitwiseXOR(F.shiftright(x, 1))

    def rotated(x: Column, by: Column) -> Column:
        """Rotate right within n bits; ``by`` is 1 to n."""
        wide = x.bitwiseOR(x * (1 << n))
        return F.floor(wide / F.pow(F.lit(2.0), by)).cast("bigint").bitwiseAND(F.lit(full))

    def degray(x: Column) -> Column:
        for shift in (1, 2, 4):
            x = (lambda y, s: let(y, lambda z: z.bitwiseXOR(F.shiftright(z, s))))(x, shift)
        return x

    def step(state: Column, bit: Column) -> Column:
        corner = F.lit(0).cast("bigint")
        for k, cell in enumerate(cells):
            one = F.floor(cell / F.pow(F.lit(2.0), bit)).cast("bigint").bitwiseAND(F.lit(1))
            corner = corner + one * (1 << k)
        local = rotated(corner.bitwiseXOR(state["entry"]), state["axis"] + 1)

        def moved(w: Column) -> Column:
            start = F.when(w == 0, F.lit(0).cast("bigint")).otherwise(
                gray(F.floor((w - 1) / 2).cast("bigint") * 2)
            )
            odd = F.when(w % 2 == 1, w).otherwise(F.greatest(w - 1, F.lit(0)))
            ones = F.bit_count(odd.bitwiseXOR(odd + 1)) - 1
            turn = F.when(w == 0, F.lit(0)).otherwise(ones % n)
            back = n - (state["axis"] + 1) % n
            return F.struct(
                (state["index"] * (1 << n) + w).cast("bigint").alias("index"),
                state["entry"].bitwiseXOR(rotated(start, back.cast("bigint"))).alias("entry"),
                ((state["axis"] + turn + 1) % n).cast("bigint").alias("axis"),
            )

        return let(degray(local), moved)

    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("index"), zero.alias("entry"), zero.alias("axis"))
    levels = F.transform(F.sequence(F.lit(bits - 1), F.lit(0)), lambda b: b.cast("bigint"))
    return F.aggregate(levels, start, step, lambda state: state["index"])


def hilbert_shards(
    docs: DataFrame,
    shards: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: tuple[str, ...] = ("lang", "source"),
    bits: int = BITS,
    law: str = "rows",
) -> DataFrame:
    """Every row with its shard: ``doc_id, size, text_crc32, curve, position, law, shard, slot``.

    The curve's dimensions are the row's size and the given columns, cut at quantiles over all rows.
    Positions follow the curve, then the checksum and the id, so copies with equal metadata lie
    together. With law ``rows`` the runs hold counts at most one apart, with ``bytes`` sizes that
    differ by at most one row from an equal part. Null texts count as empty, null metadata as the lowest;
    repeated rows take neighbouring slots; an empty table gives an empty result; other columns are ignored.

    The order is over a key that ends in the id, so a range partitioning deals copies and hot
    sources evenly. Positions need no window: the row numbers of the sorted partitions are stored,
    and one small row per partition gives each its offset.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)
    text = F.coalesce(F.col(text_column), F.lit(""))
    names = [f"dimension_{k}" for k in range(len(dimensions) + 1)]
    parts = [
        ordered(column, kinds[column]).alias(name)
        for column, name in zip(dimensions, names[1:], strict=True)
    ]
    narrow = docs.select(
        F.col(id_column).alias("doc_id"),
        text_size(F.col(text_column)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        text_size(F.col(text_column)).cast("double").alias(names[0]),
        *parts,
    )
    narrow = stored(narrow, "shard-rows")
    bounds = quantile_bounds(narrow, names, bits)
    curve = hilbert_index([cell_of(F.col(name), bounds[name], bits) for name in names], bits)
    key = ["curve", "text_crc32", "doc_id"]
    placed = narrow.select("doc_id", "size", "text_crc32", curve.alias("curve"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(partitions, *key).sortWithinPartitions(*key)
    # The upper bits of this id are the partition, the lower 33 the row's number in it.
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "shard-order")
    piece = F.shiftright("place", 33).alias("piece")
    row = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    totals = placed.groupBy(piece).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
    )
    # One row per partition of the sort.
    pieces = [tuple(r) for r in totals.orderBy("piece").collect()]
    n, size, offsets = 0, 0, []
    for number, rows, total in pieces:
        offsets.append((number, n, size))
        n, size = n + rows, size + total
    offset = spark.createDataFrame(offsets, "piece bigint, rows_before bigint, bytes_before bigint")
    placed = placed.withColumn("piece", piece).join(F.broadcast(offset), "piece")
    placed = placed.withColumn("position", F.col("rows_before") + row)
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"position * {shards} div {max(n, 1)}"))
        first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
        placed = placed.withColumn("slot", F.col("position") - first)
    else:
        placed = _cut_by_bytes(placed, shards, size)
    return placed.select(
        "doc_id",
        F.col("size").cast("bigint").alias("size"),
        "text_crc32",
        "curve",
        "position",
        F.lit(law).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
    )


def _cut_by_bytes(placed: DataFrame, shards: int, total: int) -> DataFrame:
    """Shard by the bytes before the row; a shard's slots start at its smallest position."""
    within = Window.partitionBy("piece").orderBy("place")
    before = F.col("bytes_before") + F.sum("size").over(within) - F.col("size")
    shard = F.least(F.floor(before * shards / F.lit(max(total, 1))), F.lit(shards - 1))
    placed = placed.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))
    placed = placed.join(F.broadcast(first), "shard")
    return placed.withColumn("slot", F.col("position") - F.col("first"))
