"""Exact nearest neighbours of a query set by a block matrix join on int8 codes.

Every vector is stored once in a block with its int8 code (the components over the largest magnitude, times 127), the length of
what the code leaves out, and its own values. Blocks of queries are dealt to stripes and blocks of candidates to columns; a
tile is a stripe with a column. In a tile the integer product of two blocks of codes gives all their distances up to the two
left-out lengths (triangle inequality), so each pair has a lower and an upper bound. A pair whose lower bound is beyond the
query's k-th distance so far, or beyond the k-th upper bound of the block, cannot win; the others are measured again on the
values in double precision and go to the query's heap. Heaps of one query from several columns are merged in the end. No
candidate is lost: the result equals a full comparison.

Plan. Tiles are rows of blocks, moved once: candidates once per stripe, queries once per column. A stripe has a bounded number
of bytes, so memory does not grow with the query set; a task reads a stripe, then the column's blocks one after another.
Products run on 32-bit floats over at most 1,024 components at a time, where sums of int8 products are whole numbers below
2^24 and so exact. Many equal vectors tie at distance nought and only smaller ids can still enter a heap, so they are not
measured again and again. Nothing is collected but the number of query bytes.

Rows. Vectors null, zero, empty or holding null or non-finite components, and rows without an id, take no part. Vectors of
different lengths are no candidates for each other. Every row is a candidate for every query but itself: of repeated rows each
is searched and each can be found. Ties go to the smaller id. Without queries or candidates the result is empty. Other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import partitions, stored

NEIGHBOURS = 10
BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 20
STRIPE_BYTES = 16 << 20
QUERIES_AT_ONCE = 2048
PAIRS_AT_ONCE = 1 << 15
EXACT_DEPTH = 1024  # components whose int8 products sum below 2^24
ROUNDING = 1e-7  # of both norms: covers what squares and roots in double precision can be off
QUERY, CANDIDATE = 0, 1

BLOCK = "kind int, size int, block long, ids binary, homes binary, rows binary, wide boolean, values binary, codes binary"
FOUND = "home long, row int, query_id long, vec_id long, score double"


def int8_codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale of each row, length of what the code leaves out of each row)."""
    values = values.astype(np.float64)
    scale = np.abs(values).max(axis=1) / 127
    codes = np.rint(values / scale[:, None]).astype(np.int8)
    left = values - codes * scale[:, None]
    return codes, scale, _lengths(left)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(rows).sum(axis=1))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer product of int8 codes, as doubles."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DEPTH):
        some = slice(at, at + EXACT_DEPTH)
        total += a[:, some].astype(np.float32) @ b[:, some].astype(np.float32).T
    return total


class Block:
    """Rows of one length: ids, where they live (block, row), values and codes with their scales and left-out lengths."""

    def __init__(self, ids, homes, rows, values, codes):
        self.ids, self.homes, self.rows, self.values, self.codes = ids, homes, rows, values, codes
        self.scale = np.abs(values).max(axis=1).astype(np.float64) / 127 if len(ids) else np.zeros(0)
        coded = codes * self.scale[:, None]
        self.norm, self.left = _lengths(coded), _lengths(values - coded)

    @classmethod
    def of(cls, rows: list[dict]) -> Block:
        join = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), dtype=kind)
        size = rows[0]["size"]
        values = np.concatenate(
            [np.frombuffer(r["values"], np.float64 if r["wide"] else np.float32).reshape(-1, size) for r in rows]
        )
        return cls(join("ids", np.int64), join("homes", np.int64), join("rows", np.int32), values, join("codes", np.int8).reshape(-1, size))


class Heaps:
    """The k best (distance, id) of each query, as heaps whose top is the worst kept."""

    def __init__(self, queries: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(queries)]
        self.worst = np.full(queries, np.inf)
        self.worst_id = np.full(queries, np.iinfo(np.int64).max)

    def push(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        open_ = (score < self.worst[query]) | ((score == self.worst[query]) & (ids < self.worst_id[query]))
        for q, s, i in zip(query[open_].tolist(), score[open_].tolist(), ids[open_].tolist()):
            heap = self.heaps[q]
            if len(heap) < self.k:
                heapq.heappush(heap, (-s, -i))
            else:
                heapq.heappushpop(heap, (-s, -i))
            if len(heap) == self.k:
                self.worst[q], self.worst_id[q] = -heap[0][0], -heap[0][1]


def meet(queries: Block, candidates: Block, heaps: Heaps) -> int:
    """Enter a block of candidates into the queries' heaps; the number of pairs that had to be measured on values."""
    measured = 0
    for at in range(0, len(queries.ids), QUERIES_AT_ONCE):
        some = slice(at, at + QUERIES_AT_ONCE)
        with np.errstate(over="ignore", invalid="ignore"):
            a, b = queries.norm[some, None], candidates.norm[None]
            dots = product(queries.codes[some], candidates.codes) * queries.scale[some, None] * candidates.scale[None]
            middle = np.sqrt(np.maximum(a * a + b * b - 2 * dots, 0))
            slack = queries.left[some, None] + candidates.left[None] + ROUNDING * (a + b)
            own = (queries.homes[some, None] == candidates.homes[None]) & (queries.rows[some, None] == candidates.rows[None])
            low, high = np.maximum(middle - slack, 0), np.where(own, np.inf, middle + slack)
        bound = heaps.worst[some].copy()
        if high.shape[1] > heaps.k:
            bound = np.fmin(bound, np.partition(high, heaps.k - 1, axis=1)[:, heaps.k - 1])
        tied = (low == heaps.worst[some, None]) & (candidates.ids[None] > heaps.worst_id[some, None])
        # What overflowed to no number has no bound and is measured.
        q, c = np.nonzero(~(low > bound[:, None]) & ~tied & ~own)
        measured += len(q)
        for start in range(0, len(q), PAIRS_AT_ONCE):
            qs, cs = q[start : start + PAIRS_AT_ONCE] + at, c[start : start + PAIRS_AT_ONCE]
            with np.errstate(over="ignore"):
                squares = np.square(queries.values[qs].astype(np.float64) - candidates.values[cs])
                apart = np.sqrt(np.add.accumulate(squares, axis=1)[:, -1])  # added component by component
            heaps.push(qs, apart, candidates.ids[cs])
    return measured


def _packer(wide: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = np.float64 if wide else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        blocks = 0

        def packed(what: int, size: int, rows: list[tuple]) -> pa.RecordBatch:
            ids, homes, places, vectors = zip(*rows)
            values = np.array(vectors, dtype=kind)
            row = (
                what, size, homes[0], np.array(ids, np.int64).tobytes(), np.array(homes, np.int64).tobytes(),
                np.array(places, np.int32).tobytes(), wide, values.tobytes(), int8_codes(values)[0].tobytes(),
            )
            return pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, row))], schema=SCHEMA)

        waiting: dict[tuple[int, int], list[tuple]] = {}
        homes: dict[int, int] = {}
        for batch in batches:
            offsets, flat = batch.column("values").offsets.to_numpy(), batch.column("values").values.to_numpy(zero_copy_only=False)
            for i, (id_, asks) in enumerate(zip(batch.column("id").to_pylist(), batch.column("asks").to_pylist())):
                vector = flat[offsets[i] : offsets[i + 1]]
                size = len(vector)
                mine = waiting.setdefault((CANDIDATE, size), [])
                if not mine:
                    homes[size] = first + blocks
                    blocks += 1
                entry = (id_, homes[size], len(mine), vector.copy())
                mine.append(entry)
                if asks:
                    waiting.setdefault((QUERY, size), []).append(entry)
                for what in (CANDIDATE, QUERY):
                    rows = waiting.get((what, size), ())
                    if len(rows) >= max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * size))):
                        yield packed(what, size, waiting.pop((what, size)))
        for (what, size), rows in waiting.items():
            if rows:
                yield packed(what, size, rows)

    return run


SCHEMA = pa.schema([
    ("kind", pa.int32()), ("size", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("homes", pa.binary()),
    ("rows", pa.binary()), ("wide", pa.bool_()), ("values", pa.binary()), ("codes", pa.binary()),
])


def _blocks(vectors: DataFrame, asks: Column, id_column: str, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`")
    wide = "float" not in vectors.schema[vector].dataType.simpleString()
    usable = F.col(f"`{id_column}`").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    rows = vectors.where(usable).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"),
        v.cast("array<double>" if wide else "array<float>").alias("values"),
    )
    return stored(rows.mapInArrow(_packer(wide), BLOCK), "vector-blocks")


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    rows = (row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def _searched(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tiles sorted by number, vector length and kind: queries first, then the candidates one block after another."""

    def emitted(queries: Block, heaps: Heaps) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(queries.ids), QUERIES_AT_ONCE):
            rows = [
                (int(queries.homes[q]), int(queries.rows[q]), int(queries.ids[q]), -i, -s)
                for q in range(at, min(at + QUERIES_AT_ONCE, len(queries.ids))) for s, i in heaps.heaps[q]
            ]
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["home", "row", "query_id", "vec_id", "score"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("tile", "size")):
            queries = heaps = None
            for kind, some in groupby(rows, key=lambda r: r["kind"]):
                if kind == QUERY:
                    queries = Block.of(list(some))
                    heaps = Heaps(len(queries.ids), k)
                elif queries is not None:
                    for row in some:
                        meet(queries, Block.of([row]), heaps)
            if queries is not None:
                yield from emitted(queries, heaps)

    return run


def _merged(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Heaps of one query from several columns, its rows together, to the k best in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("home", "row", "query_id", "score", "vec_id")))

        out = []
        for (_, _, query), found in groupby(rows(), key=lambda r: r[:3]):
            best = heapq.nsmallest(k, (r[3:] for r in found))
            out += [(query, n, i, s) for n, (s, i) in enumerate(best, 1)]
            if len(out) > 50_000:
                yield _ranked(out)
                out = []
        yield _ranked(out)

    return run


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], ["query_id", "rank", "vec_id", "score"]
    )


def nearest(
    vectors: DataFrame, asks: Column, k: int = NEIGHBOURS, id_column: str = "vec_id", vector: str = "embedding",
    stripe_bytes: int = STRIPE_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: of every row where ``asks`` holds, the k rows at the smallest Euclidean distance."""
    blocks = _blocks(vectors, asks, id_column, vector)
    spark = vectors.sparkSession
    size = blocks.where(F.col("kind") == QUERY).agg(F.sum(F.length("values") + F.length("codes"))).first()[0] or 0
    stripes = max(1, -(-size // stripe_bytes))
    columns = max(1, -(-2 * partitions(spark) // stripes))
    mine = F.xxhash64("block")
    here, across = (F.pmod(mine, F.lit(n)) for n in (stripes, columns))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = blocks.where(F.col("kind") == QUERY).select("*", every(columns).alias("column")).withColumn("stripe", here)
    held = blocks.where(F.col("kind") == CANDIDATE).select("*", every(stripes).alias("stripe")).withColumn("column", across)
    tiles = asked.unionByName(held).withColumn("tile", (F.col("stripe") * columns + F.col("column")).cast("int"))
    found = (
        tiles.repartitionById(stripes * columns, "tile").sortWithinPartitions("tile", "size", "kind", "block")
        .mapInArrow(_searched(k), FOUND)
    )
    by_query = found.repartition(partitions(spark), "home", "row").sortWithinPartitions("home", "row")
    return by_query.mapInArrow(_merged(k), "query_id long, rank int, vec_id long, score double")
