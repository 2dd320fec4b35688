"""Approximate nearest neighbours with an inverted multi-index.

Vectors are brought to length one, so the largest cosine is the smallest distance. Each half of a vector is quantised by
a codebook of its own; the two codes name a cell. A query visits cells in the order of the summed distances of its
halves to the two centroids, found with a heap, until the cells visited hold the wanted share of the vectors. Their vectors are
ranked again by the exact cosine of the original vectors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import stored

#: Vectors that the codebooks are fitted on, about, and the rounds of the fit.
SAMPLE = 10_000
ROUNDS = 8

#: Most centroids of a half, which bounds the cells that the driver and the tasks know.
CENTROIDS = 64

#: Share of the vectors whose cells a query visits.
SHARE = 0.55

#: Vectors that a query visits at least, for each neighbour wanted.
LEAST = 20

#: Vectors, and queries, that a task compares at once.
BLOCK = 8192
QUERIES = 2048

SEED = 5


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has that size, only finite components and some other than zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0)


def fit_codebook(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of ``rows`` after some rounds of k-means, started from evenly spaced rows."""
    centroids = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        code = distances(rows, centroids).argmin(axis=1)
        count = np.bincount(code, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, code, rows)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    return centroids


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, one row for each row and one column for each centroid."""
    return (rows**2).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(1)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no digit, so that their squares neither vanish nor overflow."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    rows = scaled(rows)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


class MultiIndex:
    """Two codebooks and the number of vectors in each of their cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray, counts: dict[int, int] | None = None) -> None:
        self.books, self.k, self.half = (first, second), len(first), first.shape[1]
        self.counts = counts or {}

    @staticmethod
    def fitted(rows: np.ndarray, k: int) -> MultiIndex:
        half = max(rows.shape[1] // 2, 1)
        first = fit_codebook(rows[:, :half], k)
        # A vector of one component has no second half.
        second = fit_codebook(rows[:, half:], k) if rows.shape[1] > half else np.zeros((k, 0))
        return MultiIndex(first, second)

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of each row's halves to the centroids."""
        parts = rows[:, : self.half], rows[:, self.half :]
        return tuple(distances(p, book) for p, book in zip(parts, self.books, strict=True))

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.halves(rows)
        return a.argmin(axis=1) * self.k + b.argmin(axis=1)

    def visited(self, a: np.ndarray, b: np.ndarray, wanted: int) -> list[int]:
        """Cells in the order of the sum of the distances ``a`` and ``b`` until they hold ``wanted`` vectors.

        A pair of ranks enters the heap once the pairs just before it in both halves have left it.
        """
        order_a, order_b = a.argsort(kind="stable").tolist(), b.argsort(kind="stable").tolist()
        near_a, near_b = a[order_a].tolist(), b[order_b].tolist()
        heap, left, found, total = [(near_a[0] + near_b[0], 0, 0)], [0] * self.k, [], 0
        while heap and total < wanted:
            _, i, j = heapq.heappop(heap)
            left[i] = j + 1
            cell = order_a[i] * self.k + order_b[j]
            if cell in self.counts:
                found.append(cell)
                total += self.counts[cell]
            if i + 1 < self.k and left[i + 1] == j:
                heapq.heappush(heap, (near_a[i + 1] + near_b[j], i + 1, j))
            if j + 1 < self.k and (i == 0 or left[i - 1] > j + 1):
                heapq.heappush(heap, (near_a[i] + near_b[j + 1], i, j + 1))
        return found


def nearest(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, allowed: np.ndarray, top: int
) -> list[tuple[int, int, float]]:
    """``query, id, cosine`` of each query's nearest rows among those ``allowed``, ties to the smaller id.

    A matrix product picks what may be nearest; each of these cosines is then computed alone, in the same way whatever the
    block, so that equal vectors tie.
    """
    out = []
    a, b = unit(queries), unit(rows)
    product = np.where(allowed, a @ b.T, -2.0)
    for k, line in enumerate(product):
        if len(line) > top + 1:
            least = np.partition(line, -(top + 1))[-(top + 1)]
            chosen = np.flatnonzero((line >= least - 1e-9) & (line > -1.5))
        else:
            chosen = np.flatnonzero(line > -1.5)
        chosen = chosen[ids[chosen] != query_ids[k]]
        x, y = scaled(queries[k : k + 1]), scaled(rows[chosen])
        exact = (y * x).sum(axis=1) / (np.sqrt((y * y).sum(axis=1)) * np.sqrt((x * x).sum()))
        best = np.lexsort((ids[chosen], -exact))[:top]
        out += [(int(query_ids[k]), int(ids[chosen][i]), float(exact[i])) for i in best]
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    top: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    share: float = SHARE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest found for each row where ``is_query`` holds.

    The score is the cosine in double precision, the largest first, ties to the smaller id; a row is never its own
    neighbour, and there are fewer neighbours if there are fewer rows. Rows without id, and vectors that are null, zero, of
    another size than most, or hold null or non-finite components, take no part. Repeated rows count once. An empty
    table gives an empty result, other columns are ignored.

    The codebooks are fitted on about ``SAMPLE`` rows chosen by the hash of their id; every row is indexed. Of equal
    vectors only the smallest ids that can be among the nearest are kept, so copies do not fill a cell. Rows are dealt by
    ranges of cells in blocks of ``BLOCK``, large cells over several, and queries meet only blocks with a cell they visit.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    given = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    sizes = given.groupBy(F.size("vector").alias("size")).count().where("size > 0")
    common = sizes.orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], schema)
    given = given.where(usable(F.col("vector"), common["size"]))
    order = Window.partitionBy("vector").orderBy("vec_id")
    # Equal vectors are equally near to every query: one more than ``top`` of them are enough besides the query.
    given = given.dropDuplicates(["vec_id", "vector"])
    entries = given.select("vec_id", "vector", F.row_number().over(order).alias("copy"))
    entries = stored(entries.where(F.col("copy") <= top + 1).select("vec_id", "vector"), "ann-rows")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], schema)
    range_ = 1 << 30
    sample = entries.where(F.pmod(F.xxhash64("vec_id"), F.lit(range_)) < range_ * min(1.0, SAMPLE / n))
    known = _matrix(sample.orderBy("vec_id").toPandas()["vector"])
    if not len(known):
        known = _matrix(entries.orderBy("vec_id").limit(1).toPandas()["vector"])
    index = MultiIndex.fitted(unit(known), max(1, min(CENTROIDS, math.ceil(math.sqrt(n / 2)), len(known))))
    books = spark.sparkContext.broadcast(index)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=books.value.cells(unit(_matrix(batch["vector"]))))

    placed = stored(entries.mapInPandas(indexed, "vec_id bigint, vector array<double>, cell int"), "ann-cells")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    full = MultiIndex(*index.books, counts)
    blocks, spread = cell_blocks(counts, BLOCK)
    wanted = max(math.ceil(share * n), min(n, LEAST * top))
    plan = spark.sparkContext.broadcast((full, blocks, wanted))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search, block_of, enough = plan.value
        for batch in batches:
            out = []
            if len(batch):
                matrix = unit(_matrix(batch["vector"]))
                for query, vector, a, b in zip(batch["vec_id"], batch["vector"], *search.halves(matrix), strict=True):
                    by_block: dict[int, list[int]] = {}
                    visited = search.visited(a, b, enough)
                    for cell in visited:
                        for block in block_of[cell]:
                            by_block.setdefault(block, []).append(cell)
                    out += [(block, visited[0], query, vector, cells) for block, cells in by_block.items()]
            yield pd.DataFrame(out, columns=["block", "home", "query_id", "vector", "cells"])

    queries = given.where("asks").select("vec_id", "vector").distinct()
    asked = queries.mapInPandas(
        routed, "block int, home int, query_id bigint, vector array<double>, cells array<int>"
    )
    # Queries of neighbouring home cells share a part, so a part meets few blocks that only some of it visit.
    per_block = Window.partitionBy("block").orderBy("home", "query_id")
    part = F.floor((F.row_number().over(per_block) - 1) / QUERIES).cast("int")
    asked = stored(asked.withColumn("part", part), "ann-queries")
    parts = asked.select(F.col("block").alias("wanted"), F.col("part").alias("asking")).distinct()
    # One row for each cell, CENTROIDS**2 at most.
    cells = [(cell, held[0], spread[cell]) for cell, held in blocks.items()]
    cells = F.broadcast(spark.createDataFrame(cells, "cell int, start int, spread int"))
    salt = F.pmod(F.xxhash64("vec_id"), F.col("spread"))
    dealt = placed.join(cells, "cell").withColumn("block", (F.col("start") + salt).cast("int"))
    dealt = dealt.join(parts, F.col("block") == F.col("wanted"))
    dealt = dealt.select("block", "asking", "vec_id", "vector", "cell")

    def compared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(left) and len(right):
            cell = right["cell"].to_numpy()
            allowed = np.zeros((len(left), int(cell.max()) + 1), bool)
            for k, cells in enumerate(left["cells"]):
                cells = np.asarray(cells)
                allowed[k, cells[cells < allowed.shape[1]]] = True
            matrix, ids = _matrix(right["vector"]), right["vec_id"].to_numpy()
            for at in range(0, len(left), 256):
                part = left.iloc[at : at + 256]
                out += nearest(
                    _matrix(part["vector"]),
                    part["query_id"].to_numpy(),
                    matrix,
                    ids,
                    allowed[at : at + 256][:, cell],
                    top,
                )
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.groupBy("block", "part").cogroup(dealt.groupBy("block", "asking")).applyInPandas(
        compared, "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def cell_blocks(counts: dict[int, int], size: int) -> tuple[dict[int, list[int]], dict[int, int]]:
    """Blocks of each cell, and how many: neighbouring small cells share a block, a large one has several."""
    blocks, spread, block, held = {}, {}, 0, 0
    for cell in sorted(counts):
        count = counts[cell]
        if held and held + count > size:
            block, held = block + 1, 0
        spread[cell] = max(1, math.ceil(count / size))
        blocks[cell] = list(range(block, block + spread[cell]))
        if spread[cell] > 1:
            block, held = block + spread[cell], 0
        else:
            held += count
    return blocks, spread
