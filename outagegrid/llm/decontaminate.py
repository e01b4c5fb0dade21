"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``least`` words. Documents are scanned once: a fixed-size Bloom filter over the benchmark's seeds (two
megabytes whatever the benchmark's size) picks the documents that may hold one, and the exact equi-join of their seeds
with the benchmark's seed table gives (document, item) pairs. Each pair is then tiled: runs of at least ``least`` equal
words, neither side used twice, the longest first, found by Karp-Rabin hashes of windows that shrink from the item's
length to ``least``. An item counts as leaked when tiles cover at least ``coverage`` of its words, in whatever order its
passages come. Both texts are whole.

Words are lower-cased in A-Z and cut at ASCII punctuation and blanks. Cases: null texts are empty and clean; items of
fewer than ``least`` words cannot be told from chance and never match; several items: the best covered one is named, the
smaller item_id among equals; rows that share a doc_id are judged together, the best covered text decides; a null doc_id
is an id like any other; a repeated item_id counts as separate texts of one item; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import fresh, quoted, stored, text_or_empty
from outagegrid.llm.shingles import MEMO_WORDS, STEP, WordHashes, mixed

NO_ID = 2**63 - 1
FILTER_BITS = 24
BLOCK = 1 << 15  # bits in one row of a bitmap aggregate
PLAIN_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
BASE = np.uint64(0x100000001B3)


def plain_words(data: bytes) -> list[bytes]:
    return data.translate(PLAIN_BYTES).split()


def _hashed(data: bytes, memo: WordHashes) -> np.ndarray:
    if len(memo) > MEMO_WORDS:
        memo.clear()
    return np.array([memo[w] for w in plain_words(data)], dtype=np.uint64)


def _windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` tokens."""
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * BASE + tokens[k : k + n]
    return mixed(total + STEP)


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in doc, length), longest matches first."""
    used_i, used_d = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out: list[tuple[int, int, int]] = []
    size = min(len(item), len(doc))
    while size >= least:
        found, clipped = _matches(item, doc, used_i, used_d, size), False
        for length, i, d in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if used_i[i : i + length].any() or used_d[d : d + length].any():
                clipped = True
                continue
            used_i[i : i + length] = used_d[d : d + length] = True
            out.append((i, d, length))
        if clipped:
            continue  # what is left of clipped matches may still be long enough
        size = max(least, size // 2) if size > least else 0
    return out


def _matches(
    item: np.ndarray, doc: np.ndarray, used_i: np.ndarray, used_d: np.ndarray, size: int
) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``size`` unused words."""
    free = lambda used: np.flatnonzero(
        np.convolve(used, np.ones(size, np.int64), "valid") == 0
    )
    at_i, at_d = free(used_i), free(used_d)
    hash_i, hash_d = _windows(item, size)[at_i], _windows(doc, size)[at_d]
    here = np.isin(hash_d, hash_i)
    places: dict[int, list[int]] = {}
    for h, d in zip(hash_d[here].tolist(), at_d[here].tolist(), strict=True):
        places.setdefault(h, []).append(d)
    out = []
    for h, i in zip(hash_i.tolist(), at_i.tolist(), strict=True):
        for d in places.get(h, ()):
            if i and d and item[i - 1] == doc[d - 1] and not used_i[i - 1] and not used_d[d - 1]:
                continue  # part of a match that starts earlier
            room = min(len(item) - i, len(doc) - d)
            stop = (item[i : i + room] != doc[d : d + room]) | used_i[i : i + room] | used_d[d : d + room]
            length = int(stop.argmax()) if stop.any() else room
            if length >= size:
                out.append((length, i, d))
    return out


def _seed_rows(bench: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            ids, seeds = [], []
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = np.unique(_windows(_hashed(data, memo), least)).view(np.int64)
                ids.append(np.full(len(hashes), item, dtype=np.int64))
                seeds.append(hashes)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(seeds)), pa.array(np.concatenate(ids))], names=["seed", "item_id"]
                )

    return bench.mapInArrow(run, "seed long, item_id long")


def _slots(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    seed = seed.view(np.uint64)
    return seed & mask, (seed >> np.uint64(FILTER_BITS)) & mask


def _filter(seeds: DataFrame) -> bytes:
    """The Bloom filter's bits: 2^FILTER_BITS of them, whatever the number of seeds."""
    mask = (1 << FILTER_BITS) - 1
    slot = F.explode(
        F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", FILTER_BITS).bitwiseAND(mask))
    )
    blocks = (
        seeds.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / BLOCK).alias("block"))
        .agg(F.bitmap_construct_agg((F.col("slot") % BLOCK)).alias("bits"))
        .collect()
    )
    bits = bytearray(1 << (FILTER_BITS - 3))
    for row in blocks:
        at = row["block"] * (BLOCK // 8)
        bits[at : at + BLOCK // 8] = row["bits"]
    return bytes(bits)


def tiled_pairs(docs: DataFrame, bench: DataFrame, least: int = 5) -> DataFrame:
    """doc_id, item_id, covered, item_words, tiles for every document and item that share a seed."""
    spark = docs.sparkSession
    items = bench.select(
        F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)).alias("item_id"),
        text_or_empty().cast("binary").alias("item"),
    )
    seeds = stored(_seed_rows(items, least).distinct(), "seeds")
    bits = spark.sparkContext.broadcast(_filter(seeds))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, known = WordHashes(), np.frombuffer(bits.value, dtype=np.uint8)
        there = lambda slot: (known[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
        for batch in batches:
            keep, found = [], []
            for k, data in enumerate(batch.column(1).to_pylist()):
                hashes = np.unique(_windows(_hashed(data, memo), least)).view(np.int64)
                first, second = _slots(hashes)
                hits = hashes[(there(first) & there(second)).astype(bool)]
                if len(hits):
                    keep.append(k)
                    found.append(hits.tolist())
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text", "seeds"]
            )

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    # A row key of its own keeps rows apart that share an id.
    hits = stored(
        texts.mapInArrow(scan, "doc_id long, text binary, seeds array<long>").withColumn(
            "row", F.xxhash64("doc_id", "text")
        ).dropDuplicates(["row"]),
        "hits",
    )
    pairs = hits.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", "item_id").distinct()

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            out = []
            for doc_id, item_id, text, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a = _hashed(item, memo)
                got = tiles(a, _hashed(text, memo), least)
                out.append((doc_id, item_id, sum(t[2] for t in got), len(a), len(got)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "covered", "item_words", "tiles"]
            )

    return (
        pairs.join(hits.select("row", "doc_id", "text"), "row").join(items, "item_id")
        .select("doc_id", "item_id", "text", "item")
        .mapInArrow(tile, "doc_id long, item_id long, covered long, item_words long, tiles long")
    )


def leaks(docs: DataFrame, bench: DataFrame, least: int = 5, coverage: float = 0.5) -> DataFrame:
    """One row per doc_id: contaminated, item_id (the best covered leaked item, else null), covered, item_words, tiles of
    the best covered item, leaked_items."""
    share = F.col("covered") / F.col("item_words")
    leaked = share >= coverage
    best = tiled_pairs(docs, bench, least).groupBy("doc_id").agg(
        F.max(F.struct(share.alias("share"), (-F.col("item_id")).alias("neg"), "covered", "item_words", "tiles")).alias("m"),
        F.count_distinct(F.when(leaked, F.col("item_id"))).alias("leaked_items"),
    )
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")).distinct()
    flag = F.coalesce(F.col("m.share") >= coverage, F.lit(False))
    return ids.join(best, "doc_id", "left").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), flag.alias("contaminated"),
        F.when(flag & (F.col("m.neg") != -NO_ID), -F.col("m.neg")).alias("item_id"),
        F.coalesce("m.covered", F.lit(0)).cast("long").alias("covered"), F.col("m.item_words").alias("item_words"),
        F.coalesce("m.tiles", F.lit(0)).cast("long").alias("tiles"),
        F.coalesce("leaked_items", F.lit(0)).cast("long").alias("leaked_items"),
    )


def without_leaks(docs: DataFrame, bench: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    id_ = fresh(docs, "_id")
    gone = leaks(docs, bench, **settings).where("contaminated").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(id_))
    keyed = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    return keyed.join(gone, id_, "left_anti").select(*quoted(docs))
