"""Byte-level BPE: ranked merges folded over the distinct words of a chunk of documents, and decoding.

One narrow pass without a shuffle. Documents of a task are gathered into chunks of about ``chunk_bytes`` bytes of text. A
chunk lists its distinct words (matches of the split pattern) as arrays of byte tokens, merges are folded over all of them,
and documents are put together from their words' tokens. Decoding concatenates the binary pieces of the ids.

The rank map is one constant in displaced rows: ``table[place[left] + right]`` holds the merged token and, to tell rows
apart, ``left``. ``fold_words`` is the fold as Spark higher-order functions: while some neighbouring pair has a rank, the
first pair of the lowest rank becomes one token. It gives the same tokens but takes about 120 microseconds a word, more than
the whole job may cost (README); the main path (``merged``) therefore folds all words of a chunk side by side on arrays.

Cases: a null or empty text has no tokens; a very long text is its own chunk, never cut; rows stay rows, so repeated ids
and null ids are returned as they come; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import text_or_empty
from outagegrid.llm.units import units

SHIFT = 16  # token ids are below 2^16
NONE = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 piece and its rank on each line. Its size is that of a vocabulary, at most 2^SHIFT lines."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) > 1 << SHIFT or max(ranks.values()) >= 1 << SHIFT:
        raise ValueError(f"{path}: {len(ranks)} ranks; {1 << SHIFT} at most")
    return ranks


def displaced(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Every pair of pieces that joins to a piece, as rows by left piece laid over each other where gaps allow."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for piece, merged in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                rows.setdefault(left, []).append((right, merged))
    room = 1 << (4 * sum(map(len, rows.values()))).bit_length()
    used = np.zeros(room + (2 << SHIFT), bool)
    table = np.full(len(used), -1, dtype=np.int64)
    place = [0] * (max(ranks.values()) + 1)
    tries = np.arange(16)
    for left, row in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
        cells = np.array([r for r, _ in row])
        at = left * 40503 % room
        while True:
            free = ~used[cells[:, None] + (at + tries)[None, :]].any(axis=0)
            if free.any():
                at += int(free.argmax())
                break
            at = (at + len(tries)) % room
        used[cells + at] = True
        table[cells + at] = [(left << SHIFT) | merged for _, merged in row]
        place[left] = at
    return place, table[: int(np.flatnonzero(used).max()) + 1].tolist()


def merged(tokens: np.ndarray, ends: np.ndarray, place: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fold merges over words laid end to end (``ends``: n + 1 offsets, no word empty): the new tokens and offsets.

    Every round joins one pair in each word that still has one, the first pair of its lowest rank."""
    n = len(ends) - 1
    word = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends))
    lengths = np.zeros(n, dtype=np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(tokens):
        rank = np.full(len(tokens), NONE, dtype=np.int32)
        cell = table[place[tokens[:-1]] + tokens[1:]]
        joins = ((cell >> SHIFT) == tokens[:-1]) & (word[:-1] == word[1:])
        rank[:-1][joins] = (cell[joins] & ((1 << SHIFT) - 1)).astype(np.int32)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(tokens)])
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        ready = lowest == NONE
        if ready.any():
            done.append((word[ready], tokens[ready]))
            left = ~ready
            tokens, word, rank, lowest = tokens[left], word[left], rank[left], lowest[left]
            if not len(tokens):
                break
        at = np.flatnonzero(rank == lowest)
        at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
        tokens = tokens.copy()
        tokens[at] = lowest[at]
        stay = np.ones(len(tokens), bool)
        stay[at + 1] = False
        tokens, word = tokens[stay], word[stay]
    if not done:
        return tokens, np.zeros(n + 1, dtype=np.int64)
    words_, all_tokens = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(words_, kind="stable")
    lengths = np.bincount(words_, minlength=n)
    return all_tokens[order], np.r_[0, np.cumsum(lengths)]


def _encoder(pattern: str, ranks: dict[bytes, int], place: list[int], table: list[int], chunk_bytes: int):
    """mapInArrow function: (doc_id, text) to (doc_id, tokens, decoded)."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, at in ranks.items():
        pieces[at] = piece
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
    places, cells = np.array(place, dtype=np.int32), np.array(table + [-1] * (1 << SHIFT), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        numbers: dict[str, int] = {}
        memos: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
        ids: list[int | None] = []
        codes: list[np.ndarray] = []
        size = 0

        def coded(unit: str) -> list[int]:
            return [numbers.setdefault(w, len(numbers)) for w in split.findall(unit)]

        def flush() -> Iterator[pa.RecordBatch]:
            words = [w.encode() for w in numbers]
            ends = np.cumsum([0, *map(len, words)])
            tokens, ends = merged(byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)], ends, places, cells)
            raw, ends = tokens.astype("<u4").tobytes(), (ends * 4).tolist()
            of = [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            for at in range(0, len(ids), 1024):
                encoded = [b"".join([of[n] for n in c.tolist()]) for c in codes[at : at + 1024]]
                decoded = [b"".join([pieces[t] for t in np.frombuffer(e, "<u4").tolist()]) for e in encoded]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at : at + 1024], pa.int64()), pa.array(encoded, pa.binary()), pa.array(decoded, pa.binary())],
                    names=["doc_id", "tokens", "decoded"],
                )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first, rest = units(text)
                got: list[int] = []
                if first is not None:
                    if first not in memos[0]:
                        memos[0][first] = coded(first)
                    got += memos[0][first]
                memo = memos[1]
                for u in rest:
                    code = memo.get(u)
                    if code is None:
                        code = memo[u] = coded(" " + u)
                    got += code
                ids.append(doc_id)
                codes.append(np.array(got, dtype=np.uint32))
                size += len(text)
                if size >= chunk_bytes:
                    yield from flush()
                    for held in (numbers, *memos, ids, codes):
                        held.clear()
                    size = 0
        if ids:
            yield from flush()

    return run


def _merge_fold(word: Column, place: Column, table: Column) -> Column:
    """Tokens of a word given as byte tokens."""

    def rank(left: Column, right: Column) -> Column:
        cell = F.get(table, F.get(place, left) + right)
        return F.when(F.shiftright(cell, SHIFT) == left, cell.bitwiseAND((1 << SHIFT) - 1).cast("int")).otherwise(
            F.lit(NONE)
        )

    def merge(state: Column, at: Column) -> Column:
        """``at``: 1-based position of the pair to join."""
        tokens, ranks = state["tokens"], state["ranks"]
        merged = F.get(ranks, at - 1)
        none = F.array().cast("array<int>")
        return F.struct(
            F.concat(
                F.slice(tokens, 1, at - 1), F.array(merged), F.slice(tokens, at + 2, F.size(tokens))
            ).alias("tokens"),
            F.concat(
                F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))),
                F.when(at > 1, F.array(rank(F.get(tokens, at - 2), merged))).otherwise(none),
                F.when(at + 1 < F.size(tokens), F.array(rank(merged, F.get(tokens, at + 1)))).otherwise(none),
                F.slice(ranks, at + 2, F.size(ranks)),
            ).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        lowest = F.array_min(state["ranks"])
        return F.when(
            lowest < NONE,
            F.get(
                F.transform(
                    F.array(F.array_position(state["ranks"], lowest).cast("int")), lambda at: merge(state, at)
                ),
                F.lit(0),
            ),
        ).otherwise(state)

    first = F.transform(
        F.slice(word, 1, F.greatest(F.size(word) - 1, F.lit(0))), lambda x, i: rank(x, F.get(word, i + 1))
    )
    return F.aggregate(
        word, F.struct(word.alias("tokens"), first.alias("ranks")), step, lambda state: state["tokens"]
    )


def fold_words(words: DataFrame, path: str) -> DataFrame:
    """word (binary, not empty) to word, tokens, decoded, by higher-order functions alone."""
    ranks, place, table = _tables(path)
    byte_ids = [ranks[bytes([b])] for b in range(256)]
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, at in ranks.items():
        pieces[at] = piece
    maps = words.sparkSession.createDataFrame(
        pa.table({
            "bytes": pa.array([byte_ids], pa.list_(pa.int32())), "place": pa.array([place], pa.list_(pa.int32())),
            "table": pa.array([table], pa.list_(pa.int64())), "pieces": pa.array([pieces], pa.list_(pa.binary())),
        })
    )
    hexed = F.hex("word")
    values = F.transform(
        F.sequence(F.lit(1), F.length("word")),
        lambda i: F.get(F.col("bytes"), F.conv(F.substring(hexed, i * 2 - 1, F.lit(2)), 16, 10).cast("int")),
    )
    return (
        words.withColumns({c: maps.select(c).scalar() for c in maps.columns})
        .select("word", "place", "table", "pieces", values.alias("values"))
        .select("word", _merge_fold(F.col("values"), F.col("place"), F.col("table")).alias("tokens"), "pieces")
        .select(
            "word", "tokens",
            F.aggregate("tokens", F.lit(b""), lambda done, t: F.concat(done, F.get(F.col("pieces"), t))).alias("decoded"),
        )
    )


@lru_cache(maxsize=4)
def _tables(path: str) -> tuple[dict[bytes, int], list[int], list[int]]:
    ranks = read_ranks(path)
    return (ranks, *displaced(ranks))


def encode(docs: DataFrame, path: str, pattern: str, chunk_bytes: int = 12_000_000) -> DataFrame:
    """doc_id, tokens (little-endian unsigned 32-bit ids), decoded (the bytes that the ids stand for)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        _encoder(pattern, *_tables(path), chunk_bytes), "doc_id long, tokens binary, decoded binary"
    )
