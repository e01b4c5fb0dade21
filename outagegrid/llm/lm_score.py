"""Language-model scores by deleted interpolation.

Tokens are lower-cased words and one end per document. The model is a word bigram over all training words:

    P(w | h) = l2[b] c(h, w) / c(h) + l1[b] c(w) / N + l0[b] / (size + 2),       b = bucket of the context's count c(h)

Every training word has its own context and bigram counts; words that no training document holds are one class, OTHER. A
caller may ask for a class-based model instead: with ``vocabulary`` set, at most so many of the most frequent words have
their own counts, and OTHER holds all others. A word of OTHER is predicted as its class and then drawn from it:
(c(w) + 0.5) / (C + 0.5 (D + 1)), with C tokens and D distinct words of the class, so the text's probability is proper.
A tenth of the training documents is deleted (held out) from the counts; on its bigrams expectation-maximisation learns
the three weights of each bucket. Final counts use all training documents. The weights are found on a histogram of
(bucket, bigram estimate, unigram estimate) in steps of an eighth of a power of two, whose size does not grow.

How it runs: texts are read once and stored as blocks of token numbers, each block with the 64-bit hashes of its own
words. A block asks for the totals of its distinct words and bigrams (a bigram is a 64-bit hash of its words' hashes) in
sorted, compressed lists, one per range of hashed keys; each shuffle partition adds up the lists of its range and answers
every block in the order asked. So a block learns all counts of its own text and settles its documents alone. No table of
words or bigrams is held in one place, and a frequent key costs its partition one entry per block. Two of n distinct keys
share a hash with a chance of about n^2 / 2^65.

Cases: a null or empty text is one end token; rows that share a doc_id are one document, read one after another; a null
doc_id is an id of its own; without training documents all probabilities are uniform; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import fold, partitions, stored, text_or_empty, words
from outagegrid.llm.shingles import STEP, mixed

NO_ID = -(2**63)
BUCKETS = 24
STEPS = 8  # per power of two, in the histogram of estimates
LOWEST = -60 * STEPS
BLOCK_EVENTS = 1_000_000
END, START = 0, 1  # a block's first two token numbers; OTHER is behind its words
END_KEY, START_KEY, OTHER_KEY = np.array([1, 2, 3], dtype=np.uint64)
BLOCK, WORDS, BIGRAMS, LEVELS = range(4)
ROW = "kind int, block long, place int, shard int, a binary, b binary, c binary, d binary, e binary"


def _pack(values: np.ndarray) -> bytes:
    """Integers of one type, byte planes apart, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=keys.dtype.type(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.int64))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, part (0 training, 1 scored only, 2 deleted from the training counts), text as bytes."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    part = F.when(fold() == 1, 1).when(F.pmod(F.floor(hashed / 5), F.lit(10)) == 0, 2).otherwise(0).cast("int")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), part.alias("part"),
        text_or_empty().cast("binary").alias("text"),
    )


def _split_blocks(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions in ascending key order) for every shard that has keys."""
    shard = (mixed(keys.view(np.uint64)) % np.uint64(shards)).astype(np.int32)
    order = np.lexsort((keys, shard))
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if edges[s] < edges[s + 1]:
            yield s, order[edges[s] : edges[s + 1]]


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 0) + 1).astype(np.int64), BUCKETS - 1)


def _level(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.maximum(np.floor(np.log2(p) * STEPS + 0.5), LOWEST).astype(np.int64)


def weights_by_em(cells: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Rows of (bucket, bigram level, unigram level, count) to mixture weights, bucket x (bigram, unigram, uniform). Each
    component gets a pseudo-count of one, the bigram none where no context has been seen."""
    out = np.tile([0.3, 0.6, 0.1], (BUCKETS, 1))
    out[0] = [0.0, 0.9, 0.1]
    for b in np.unique(cells[:, 0]):
        rows = cells[cells[:, 0] == b]
        estimate = np.where(rows[:, 1:3] <= LOWEST, 0.0, 2.0 ** (rows[:, 1:3] / STEPS))
        p = np.column_stack([estimate, np.full(len(rows), uniform)])
        n, w = rows[:, 3].astype(float), out[b].copy()
        for _ in range(rounds):
            share = p * w
            share *= (n / share.sum(axis=1))[:, None]
            w = share.sum(axis=0) + (w > 0)
            w /= w.sum()
        out[b] = w
    return out


def _log_mix(chw, context, word, c, total, weights, size) -> np.ndarray:
    before = c[context]
    w = weights[_bucket(before)]
    p = w[:, 2] / (size - 1)
    p = p + w[:, 1] * c[word] / total if total else p
    with np.errstate(divide="ignore", invalid="ignore"):
        bigram = np.where(before > 0, chw / before, 0.0)
    return np.log10(p + w[:, 0] * bigram)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in ROW.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 5
    columns = zip(*[(*r, *[None] * (len(names) - len(r))) for r in rows], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + START + 1
        return n


def token_blocks(rows: DataFrame, shards: int, block_events: int) -> DataFrame:
    """Rows of kind BLOCK: ids, parts, lengths in tokens, hashes of the block's words, token numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId(), 0
        ids, parts, found, size, number = [], [], [], 0, _Numbers()

        def block() -> pa.RecordBatch:
            keys = np.array([xxhash.xxh3_64_intdigest(w) for w in number], dtype=np.uint64)
            row = (
                _pack(np.array(ids, np.int64)), _pack(np.array(parts, np.uint8)),
                _pack(np.array([len(f) for f in found], np.uint32)), _pack(keys), _pack(np.concatenate(found)),
            )
            return _batch([(BLOCK, (task << 32) + turn, (task + 7 * turn) % shards, -1, *row)])

        for batch in batches:
            for doc_id, part, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                listed = words(data)
                t = np.zeros(len(listed) + 1, np.uint32)
                t[:-1] = np.fromiter(map(number.__getitem__, listed), np.uint32, len(listed))
                ids.append(doc_id), parts.append(part), found.append(t)
                size += len(t)
                if size > block_events:
                    yield block()
                    turn += 1
                    ids, parts, found, size, number = [], [], [], 0, _Numbers()
        if found:
            yield block()

    return rows.mapInArrow(run, ROW)


class _Totals(NamedTuple):
    """What a block needs to know of the whole corpus: training and deleted documents, the least level of words with
    counts of their own, and tokens and deleted tokens of all other training words."""

    docs: int
    deleted_docs: int
    least: int
    other: int
    other_deleted: int


class _Block:
    def __init__(self, row: dict):
        self.name = row["block"], row["place"]
        self.ids, self.parts = _unpack(row["a"], np.int64), _unpack(row["b"], np.uint8)
        self.lengths = _unpack(row["c"], np.uint32).astype(np.int64)
        self.keys, self.tokens = _unpack(row["d"], np.uint64), _unpack(row["e"], np.uint32).astype(np.int64)
        self.part = np.repeat(self.parts, self.lengths)
        self.other = len(self.keys) + START + 1
        self.number = np.arange(self.other)

    def learn(self, replies: dict, totals: _Totals, shards: int) -> None:
        """Counts of the block's words: ``seen`` of each word itself, ``c`` and ``d`` by token number of the model."""
        kept, deleted = _answered(self.keys, replies[WORDS], shards)
        ends = [totals.docs] * 2
        self.seen = np.r_[ends, kept + deleted]
        self.inside = np.r_[True, True, (self.seen[2:] > 0) & (_count_level(self.seen[2:]) >= totals.least)]
        if totals.least:
            self.number = np.where(self.inside, self.number, self.other)
        self.c = np.r_[self.seen, totals.other]
        self.d = np.r_[[totals.deleted_docs] * 2, deleted, totals.other_deleted]

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Contexts, words and keys of the distinct bigrams, and the bigram of every token."""
        t = self.number[self.tokens]
        context = np.r_[START, t[:-1]]
        context[1:][t[:-1] == END] = START
        pairs, at = np.unique(context * (self.other + 1) + t, return_inverse=True)
        context, word = pairs // (self.other + 1), pairs % (self.other + 1)
        h = np.r_[END_KEY, START_KEY, self.keys, OTHER_KEY]
        return context, word, mixed(mixed(h[context]) * STEP + h[word]), at

    def counted(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        """Training and deleted tokens by ``at``."""
        return [np.bincount(at[self.part == p], minlength=size) for p in (0, 2)]

    def asks(self, kinds, shards: int) -> list[tuple]:
        out = []
        for kind in kinds:
            if kind == WORDS:
                keys, (kept, deleted) = self.keys, (x[2:] for x in self.counted(self.tokens, self.other))
            else:
                _, _, keys, at = self.bigrams()
                kept, deleted = self.counted(at, len(keys))
            for s, p in _split_blocks(keys.view(np.int64), shards):
                lists = _pack_sorted(keys.view(np.int64)[p]), _pack(kept[p]), _pack(deleted[p])
                out.append((kind, *self.name, s, *lists))
        return out


def _answered(keys: np.ndarray, replies: dict[int, tuple[bytes, bytes]], shards: int) -> tuple[np.ndarray, np.ndarray]:
    kept, deleted = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for s, p in _split_blocks(keys.view(np.int64), shards):
        kept[p], deleted[p] = (_unpack(x, np.int64) for x in replies[s])
    return kept, deleted


def _count_level(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1)) * 16).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, dict]]:
    """The blocks of a shuffle partition, each with its replies by kind and shard."""
    blocks, replies = [], {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == BLOCK:
                blocks.append(row)
            else:
                of = replies.setdefault(row["block"], {WORDS: {}, BIGRAMS: {}})
                of[row["kind"]][row["shard"]] = row["a"], row["b"]
    while blocks:  # a block that is done is let go
        row = blocks.pop()
        yield _Block(row), replies.pop(row["block"], {WORDS: {}, BIGRAMS: {}})


def _totals_of(asked: DataFrame, shards: int) -> DataFrame:
    """Replies to all asks, training and deleted tokens in the order asked, and a row of kind LEVELS per shard: level of a
    word's count, and words, tokens and deleted tokens at that level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORDS: [], BIGRAMS: []}
        for batch in batches:
            for r in batch.to_pylist():
                lists = _unpack_sorted(r["a"]), _unpack(r["b"], np.int64), _unpack(r["c"], np.int64)
                held[r["kind"]].append(((r["kind"], r["block"], r["place"], r["shard"]), *lists))
        for kind, rows in held.items():
            if not rows:
                continue
            keys, at = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
            kept, deleted = (
                np.bincount(at, weights=np.concatenate([r[k] for r in rows]), minlength=len(keys)).astype(np.int64) for k in (2, 3)
            )
            start = 0
            for name, asked_keys, _, _ in rows:
                mine = at[start : start + len(asked_keys)]
                start += len(asked_keys)
                yield _batch([(*name, _pack(kept[mine]), _pack(deleted[mine]))])
            if kind == WORDS:
                c = kept + deleted
                levels, where = np.unique(_count_level(c[c > 0]), return_inverse=True)
                sums = [np.bincount(where, weights=x, minlength=len(levels)) for x in (c[c > 0] > 0, c[c > 0], deleted[c > 0])]
                yield _batch([(LEVELS, -1, 0, 0, np.array([levels, *sums]).astype(np.int64).tobytes())])

    return asked.repartitionById(shards, "shard").mapInArrow(run, ROW)


def score(
    docs: DataFrame, vocabulary: int | None = None, hot_share: float = 1e-6, block_events: int = BLOCK_EVENTS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per doc_id. Runs jobs. ``hot_share``
    is taken from callers of an earlier form and changes nothing: a frequent bigram is one entry per block."""
    rows = _rows(docs)
    shards = partitions(docs.sparkSession)
    blocks = stored(token_blocks(rows, shards, block_events), "blocks")

    def ask(source: DataFrame, *kinds: int, totals: _Totals | None = None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, replies in _gathered(batches):
                if totals is not None:
                    block.learn(replies, totals, shards)
                asked = block.asks(kinds, shards)
                if asked:
                    yield _batch(asked)

        return stored(_totals_of(source.mapInArrow(run, ROW), shards), "totals")

    def gathered(*replies: DataFrame) -> DataFrame:
        out = blocks
        for r in replies:
            out = out.unionByName(r.where(F.col("kind") != LEVELS))
        return out.repartitionById(shards, "place")

    replies = [ask(blocks, WORDS, BIGRAMS) if vocabulary is None else ask(blocks, WORDS)]
    levels = [np.frombuffer(r["a"], np.int64).reshape(4, -1) for r in replies[0].where(F.col("kind") == LEVELS).select("a").collect()]
    level, n, c, d = np.concatenate([*levels, np.zeros((4, 0), np.int64)], axis=1)
    distinct, word_tokens, deleted_tokens = int(n.sum()), int(c.sum()), int(d.sum())
    # All words of a count class are in or out together.
    least = 0
    if vocabulary is not None and distinct > vocabulary:
        least = int(level.max()) + 1
        while least > 0 and n[level >= least - 1].sum() <= vocabulary:
            least -= 1
    listed = int(n[level >= least].sum())
    ends = rows.select("part").agg(F.count_if(F.col("part") != 1), F.count_if(F.col("part") == 2)).first()
    n_docs, n_deleted = int(ends[0]), int(ends[1])
    totals = _Totals(n_docs, n_deleted, least, int(c[level < least].sum()), int(d[level < least].sum()))
    if vocabulary is not None:
        replies.append(ask(gathered(*replies), BIGRAMS, totals=totals))
    total = word_tokens + n_docs
    kept_total = max(1, total - deleted_tokens - n_deleted)
    kinds = distinct + int(n_docs > 0)
    size = listed + 3

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in _gathered(batches):
            block.learn(found, totals, shards)
            context, word, keys, at = block.bigrams()
            weight = block.counted(at, len(keys))[1]
            on = weight > 0
            before = (block.c - block.d)[context[on]]
            with np.errstate(divide="ignore", invalid="ignore"):
                p2 = np.where(before > 0, _answered(keys, found[BIGRAMS], shards)[0][on] / before, 0.0)
            p1 = (block.c - block.d)[word[on]] / kept_total
            codes, where = np.unique((_bucket(before) * 1024 - _level(p2)) * 1024 - _level(p1), return_inverse=True)
            n = np.bincount(where, weights=weight[on], minlength=len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    cells = gathered(*replies).mapInArrow(evidence, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n_cell = (cells.column(k).to_numpy() for k in range(2))
    cells = np.column_stack([code >> 20, -(code >> 10 & 1023), -(code & 1023), n_cell]).astype(np.int64)
    weights = weights_by_em(cells[np.lexsort(cells.T[::-1])], 1.0 / (size - 1))
    spread = math.log10(totals.other + 0.5 * (distinct - listed + 1))
    whole = math.log10(total + 0.5 * (kinds + 1))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in _gathered(batches):
            block.learn(found, totals, shards)
            context, word, keys, at = block.bigrams()
            kept, deleted = _answered(keys, found[BIGRAMS], shards)
            of = np.repeat(np.arange(len(block.ids)), block.lengths)
            by_doc = lambda x: np.bincount(of, weights=x[block.tokens], minlength=len(block.ids))  # noqa: E731, B023
            logs = _log_mix(kept + deleted, context, word, block.c, total, weights, size)
            base = np.log10(block.seen + 0.5)
            drawn = np.where(block.inside, 0.0, base - spread)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids), pa.array(block.lengths), pa.array(by_doc(block.seen > 0).astype(np.int64)),
                    pa.array(by_doc(base)), pa.array(by_doc(drawn) + np.bincount(of, weights=logs[at], minlength=len(block.ids))),
                ],
                names=["doc_id", "n_tokens", "n_known", "base", "score"],
            )

    parts = gathered(*replies).mapInArrow(settle, "doc_id long, n_tokens long, n_known long, base double, score double")
    per_doc = parts.groupBy("doc_id").agg(*[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")])
    ids = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return per_doc.select(
        ids.alias("doc_id"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"), "score",
    ).select("doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
