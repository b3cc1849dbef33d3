"""Exact nearest neighbours by largest inner product: a block matrix join on int8 tiles.

Vectors become blocks of rows. A task holds one block of queries and reads its share of
the candidate blocks one after the other. Each pair of blocks is a tile: the product of
the two int8 matrices gives every inner product up to a bound, which follows from the
exact lengths of the two rounding errors (Cauchy-Schwarz). Only pairs whose upper bound
reaches the lower bound of the query's k-th best are computed again from the original
values, in double precision, and enter the query's heap. Heaps of the tasks that share a
query block meet in a window of k rows per query. No pair is lost, so recall is 1.

Defined cases: vectors that are null, empty, zero or hold null or non-finite values take
no part, as query or candidate, nor do rows without a vec_id; vectors are compared with
those of equal length only; of rows that share a vec_id one stays (the largest vector in
array order), and a query never meets its own vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.llm.common import stored

BLOCK_ROWS = 4096
_INT8 = 127

_BLOCKS = "dim int, n int, ids binary, vectors binary"
_BLOCK_TYPE = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
_HITS = "query_id long, vec_id long, score double"
_HIT_TYPE = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(rows: DataFrame) -> DataFrame:
    """One row per vec_id with a vector that can be compared: (vec_id, vector array<double>)."""
    vector = F.col("embedding").cast("array<double>")
    far = F.lit(float("inf"))
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < far))
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(fit, F.lit(False))
        & F.exists(vector, lambda x: x != 0)
    )
    return known.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def blocks(rows: DataFrame) -> DataFrame:
    """Rows gathered where they lie into blocks of one dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dim)
            return pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()),
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([np.concatenate(vectors).tobytes()], pa.binary()),
            ], schema=_BLOCK_TYPE)

        for batch in batches:
            ids = batch["vec_id"].to_numpy(zero_copy_only=False)
            lists = batch["vector"]
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            for number, (vec_id, end) in enumerate(zip(ids, ends)):
                vector = flat[ends[number - 1] if number else 0 : end]
                mine = held.setdefault(len(vector), ([], []))
                mine[0].append(vec_id)
                mine[1].append(vector)
                if len(mine[0]) >= BLOCK_ROWS:
                    yield block(len(vector))
        for dim in list(held):
            yield block(dim)

    return rows.select("vec_id", "vector").mapInArrow(work, _BLOCKS)


class Rounded:
    """A block's int8 form: whole numbers held as floats, row scales, and error lengths."""

    def __init__(self, vectors: np.ndarray):
        peak = np.abs(vectors).max(axis=1)
        # squares of these would leave the range of doubles: no bound, so their pairs go on to be exact
        self.unbounded = (peak < _LEAST) | (peak > _MOST)
        plain = np.where(self.unbounded[:, None], 0.0, vectors)
        self.scale = np.where(self.unbounded, 1.0, peak) / _INT8
        whole = np.rint(plain / self.scale[:, None])
        self.whole = whole.astype(np.int8)
        near = whole * self.scale[:, None]
        self.error = np.sqrt(((plain - near) ** 2).sum(axis=1))
        self.near_length = np.sqrt((near**2).sum(axis=1))
        self.length = np.sqrt((plain**2).sum(axis=1))


#: Largest components between which products and squares stay normal doubles.
_LEAST, _MOST = 1e-70, 1e70

#: Products of int8 rows are exact in single precision while their sum stays below 2**24.
_EXACT = (1 << 24) // (_INT8 * _INT8)


def tile(queries: Rounded, others: Rounded) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the rounded rows, and how far off they can be."""
    dim = queries.whole.shape[1]
    product = np.zeros((len(queries.whole), len(others.whole)))
    for at in range(0, dim, _EXACT):
        left = queries.whole[:, at : at + _EXACT].astype(np.float32)
        right = others.whole[:, at : at + _EXACT].astype(np.float32)
        product += left @ right.T
    product *= queries.scale[:, None]
    product *= others.scale[None, :]
    off = queries.error[:, None] * others.length[None, :]
    off += queries.near_length[:, None] * others.error[None, :]
    # what double precision itself may add
    off += 1e-12 * (queries.length[:, None] * others.length[None, :])
    off[queries.unbounded] = np.inf
    off[:, others.unbounded] = np.inf
    return product, off


def exact(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components."""
    total = np.zeros(len(queries))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(queries.shape[1]):
            total += queries[:, at] * others[:, at]
    return total


class Best:
    """Per query of a block, a heap of its k nearest; the root is the worst of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rounded = Rounded(vectors)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]

    def meet(self, ids: np.ndarray, vectors: np.ndarray, rows: int = 512) -> None:
        others = Rounded(vectors)
        for at in range(0, len(self.ids), rows):
            some = slice(at, at + rows)
            mine = object.__new__(Rounded)
            for name, held in vars(self.rounded).items():
                setattr(mine, name, held[some])
            near, off = tile(mine, others)
            own = self.ids[some][:, None] == ids[None, :]
            near[own] = -np.inf
            low = near - off
            k = min(self.k, low.shape[1])
            least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if k == self.k else np.full(len(low), -np.inf)
            full = [h[0][0] if len(h) == self.k else -np.inf for h in self.heaps[some]]
            least = np.maximum(least, full)
            query, other = np.nonzero((near + off >= least[:, None]) & ~own)
            for part in range(0, len(query), 1 << 18):
                q, o = query[part : part + (1 << 18)], other[part : part + (1 << 18)]
                scores = exact(self.vectors[at + q], vectors[o])
                for row, vec_id, score in zip((at + q).tolist(), ids[o].tolist(), scores.tolist()):
                    entry, heap = (score, -vec_id), self.heaps[row]
                    if len(heap) < self.k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)

    def hits(self) -> Iterator[tuple[int, int, float]]:
        for query, heap in zip(self.ids.tolist(), self.heaps):
            for score, minus in heap:
                yield query, -minus, score


def nearest(rows: DataFrame, is_query: Column, k: int = 20, strip_blocks: int = 8) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest among all rows but its own.

    A task reads about `strip_blocks` candidate blocks for one block of queries, so that
    memory is bounded and every core has work; both numbers of blocks follow the input.
    """
    spark = rows.sparkSession
    vectors = stored(usable(rows), "vectors")
    counts = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    strips = max(1, -(-counts[0] // (BLOCK_ROWS * strip_blocks)))
    query_blocks = max(1, -(-counts[1] // BLOCK_ROWS))
    strips = max(strips, min(parts, -(-counts[0] // BLOCK_ROWS)))
    spread = vectors.repartition(min(parts, -(-counts[0] // BLOCK_ROWS) or 1))
    number = F.monotonically_increasing_id()
    others = blocks(spread).withColumn(
        "strip", F.pmod(number + F.shiftrightunsigned(number, 33), F.lit(strips))
    )
    asked = blocks(vectors.filter(is_query).repartition(query_blocks)).withColumn(
        "query_block", F.monotonically_increasing_id()
    )
    asked = stored(asked, "query-blocks")
    others = stored(others, "vector-blocks")
    left = asked.select(
        "query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))).alias("strip"),
        F.lit(0).alias("side"), "dim", "n", "ids", "vectors",
    )
    # every block of candidates meets every block of queries: a stated query set in blocks
    numbers = asked.select("query_block", F.col("dim").alias("query_dim"))
    right = others.join(F.broadcast(numbers), F.col("dim") == F.col("query_dim")).select(
        "query_block", "strip", F.lit(1).alias("side"), "dim", "n", "ids", "vectors"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best = None, None

        def out():
            found = list(best.hits())
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*found), _HIT_TYPE)], schema=_HIT_TYPE
                )

        for batch in batches:
            for row in range(len(batch)):
                key = (batch["query_block"][row].as_py(), batch["strip"][row].as_py())
                ids = np.frombuffer(batch["ids"][row].as_py(), np.int64)
                vectors = np.frombuffer(batch["vectors"][row].as_py(), np.float64)
                vectors = vectors.reshape(len(ids), -1)
                if key != held:
                    if best is not None:
                        yield from out()
                    held, best = key, Best(ids, vectors, k)
                else:
                    best.meet(ids, vectors)
        if best is not None:
            yield from out()

    tiles = left.unionByName(right).repartition(max(parts, strips), "query_block", "strip")
    hits = tiles.sortWithinPartitions("query_block", "strip", "side").mapInArrow(work, _HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
