"""Spelling variants of a corpus: words one letter apart, the commoner form of each, and the root its forms lead to.

One inserted or deleted letter changes one coordinate of a word's letter counts by one, one replaced letter changes two, so
words near each other are at most 1 (lengths differ) or 2 (same length) apart in L1. Letter counts of the words of one length
are split by a k-d tree: a node asks whether a letter occurs at least t times and sends words left or right. A word searches
the tree of its own length within 2 and the tree of the next length within 1, leaving every box that is further away; what is
left passes a bound on the parities of the counts and is then verified letter by letter. Letters are folded to ``CLASSES``
coordinates and counts end at 255: both can only bring words nearer, so no pair is lost.

Plan. Words are counted by Spark functions with partial aggregation. The upper levels of every tree are fitted on a bounded
sample of the distinct words (``SAMPLE``; it moves borders between shards, never a result) and reach every task as part of
its code. A word goes once to the shard of its box and as a visitor to the few shards its search reaches, each pair of shards
only in one direction; a shard grows its own lower levels and reports, per word, a count and the best form, so a word with
many near words is never a list. Forms are followed by doubling, each round a join and stored.

Rows. A null or empty text has no words; a null doc_id counts as an empty id. Repeated rows count as often as they are
there. Without words the result is empty. Very long runs of letters are words like others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import lower_ascii, stored, text_or_empty

RUN = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
DELETE_ONE_IN = 31
TIMES = 10
CLASSES = 192  # a-z and the letters of Latin-1 keep a coordinate each
SAMPLE = 65_536
SAMPLE_LEAF = 32
SHARD_WORDS, SHARD_LETTERS = 4096, 1 << 22
LEAF = 16
SEARCHES_AT_ONCE = 1024
LETTERS_AT_ONCE = 1 << 22
HOME, SAME, SHORTER = 0, 1, 2


def words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, some of them with a letter deleted by a hash of document and run."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
        F.explode(F.regexp_extract_all(text_or_empty(), F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"),
    ).select("d", lower_ascii(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (
        hashed.select(F.when(F.col("h") % DELETE_ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


def letters(texts: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(texts), -1)


def counts(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), CLASSES), dtype=np.int64)
    classes, rows = codes % CLASSES, np.arange(len(codes))
    for k in range(codes.shape[1]):
        out[rows, classes[:, k]] += 1
    return np.minimum(out, 255).astype(np.uint8)


def parities(vectors: np.ndarray) -> np.ndarray:
    """The counts' last bits, folded into 64: vectors at L1 distance r differ in r bits at most."""
    odd = np.bitwise_xor.reduce((vectors & 1).reshape(len(vectors), CLASSES // 64, 64), axis=1)
    return np.packbits(odd, axis=1).view(np.uint64)[:, 0]


class Tree:
    """A k-d tree over letter counts. Inner nodes hold the letter, the count that goes right, and the range of that letter's
    counts in their box; leaves are numbered from left to right."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.letter, self.least, self.low, self.high, self.left, self.right, self.leaf = ([] for _ in range(7))
        self.members: list[np.ndarray] = []
        self._grow(vectors, np.arange(len(vectors)), {}, leaf)
        for name in ("letter", "least", "low", "high", "left", "right", "leaf"):
            setattr(self, name, np.array(getattr(self, name), dtype=np.int64))
        self.start = np.concatenate([[0], np.cumsum([len(m) for m in self.members])]).astype(np.int64)
        self.members = np.concatenate(self.members).astype(np.int64)

    @property
    def leaves(self) -> int:
        return len(self.start) - 1

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, box: dict[int, tuple[int, int]], leaf: int) -> int:
        node = len(self.letter)
        for name in (self.letter, self.least, self.low, self.high, self.left, self.right):
            name.append(0)
        split = self._split(vectors[rows]) if len(rows) > leaf else None
        if split is None:
            self.leaf.append(len(self.members))
            self.members.append(rows)
            return node
        self.leaf.append(-1)
        letter, least = split
        low, high = box.get(letter, (0, 255))
        right = vectors[rows, letter] >= least
        self.letter[node], self.least[node], self.low[node], self.high[node] = letter, least, low, high
        self.left[node] = self._grow(vectors, rows[~right], box | {letter: (low, least - 1)}, leaf)
        self.right[node] = self._grow(vectors, rows[right], box | {letter: (least, high)}, leaf)
        return node

    @staticmethod
    def _split(vectors: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that halve the words best; None where all counts are equal."""
        best = (0, 0, 0)
        for least in range(1, int(vectors.max(initial=0)) + 1):
            there = (vectors >= least).sum(axis=0)
            even = np.minimum(there, len(vectors) - there)
            k = int(even.argmax())
            best = max(best, (int(even[k]), k, least))
        return best[1:] if best[0] else None

    def home(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), dtype=np.int64)
        while (inner := np.flatnonzero(self.leaf[node] < 0)).size:
            at = node[inner]
            right = vectors[inner, self.letter[at]] >= self.least[at]
            node[inner] = np.where(right, self.right[at], self.left[at])
        return self.leaf[node]

    def search(self, vectors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (row, leaf) whose box is within ``radius``."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        far = np.zeros(len(vectors), dtype=np.int64)
        rows, leaves = [], []
        while row.size:
            done = self.leaf[node] >= 0
            rows.append(row[done])
            leaves.append(self.leaf[node[done]])
            row, node, far = row[~done], node[~done], far[~done]
            v, least = vectors[row, self.letter[node]].astype(np.int64), self.least[node]
            low, high = self.low[node], self.high[node]
            before = far - np.maximum(0, np.maximum(low - v, v - high))
            left = before + np.maximum(0, np.maximum(low - v, v - least + 1))
            right = before + np.maximum(0, np.maximum(least - v, v - high))
            go_left, go_right = left <= radius, right <= radius
            row, node, far = (
                np.concatenate([a[go_left], b[go_right]])
                for a, b in ((row, row), (self.left[node], self.right[node]), (left, right))
            )
        return np.concatenate(rows), np.concatenate(leaves)


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one replaced letter or, where b is longer by one, one inserted one."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(axis=1) == 1
    same, shifted = a == b[:, :size], (a == b[:, 1:])[:, ::-1]
    prefix = np.where(same.all(axis=1), size, same.argmin(axis=1))
    suffix = np.where(shifted.all(axis=1), size, shifted.argmin(axis=1))
    return prefix + suffix >= size


class Shard:
    """Words of one length under a tree of their own."""

    def __init__(self, texts: list[str]):
        self.codes = letters(texts)
        self.vectors = counts(self.codes)
        self.bits = parities(self.vectors)
        self.tree = Tree(self.vectors, LEAF)
        order = self.tree.members
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))

    def near(self, codes: np.ndarray, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(searching row, near word of the shard); ``own``: the rows are the shard's words, every pair comes once."""
        radius = 2 if codes.shape[1] == self.codes.shape[1] else 1
        for at in range(0, len(codes), SEARCHES_AT_ONCE):
            some = codes[at : at + SEARCHES_AT_ONCE]
            vectors = counts(some)
            bits = parities(vectors)
            row, leaf = self.tree.search(vectors, radius)
            size = self.tree.start[leaf + 1] - self.tree.start[leaf]
            total = np.concatenate([[0], np.cumsum(size)])
            step = max(1, LETTERS_AT_ONCE // max(1, codes.shape[1]))
            # Leaves in runs of bounded numbers of pairs.
            cuts = np.unique(np.minimum(np.searchsorted(total, np.arange(0, total[-1] + step, step)), len(size)))
            for first, last in zip(cuts[:-1], cuts[1:]):
                sizes = size[first:last]
                r = np.repeat(row[first:last], sizes)
                inside = np.arange(len(r)) - np.repeat(total[first:last] - total[first], sizes)
                m = self.tree.members[np.repeat(self.tree.start[leaf[first:last]], sizes) + inside]
                keep = np.bitwise_count(bits[r] ^ self.bits[m]) <= radius
                if own:
                    keep &= m > r + at
                r, m = r[keep], m[keep]
                for p in range(0, len(r), step):
                    rs, ms = r[p : p + step], m[p : p + step]
                    ok = one_apart(some[rs], self.codes[ms])
                    yield rs[ok] + at, ms[ok]


class Best:
    """Per word: how many near words, and the one with the largest n, ties to the first in code-point order."""

    def __init__(self, texts: list[str], n: np.ndarray):
        self.n, self.texts = n, texts
        self.count = np.zeros(len(texts), dtype=np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def hear(self, mine: np.ndarray, other: Best, theirs: np.ndarray) -> None:
        np.add.at(self.count, mine, 1)
        for i, j, n in zip(mine.tolist(), theirs.tolist(), (-other.n[theirs]).tolist()):
            found = (n, other.texts[j])
            if i not in self.best or found < self.best[i]:
                self.best[i] = found

    def rows(self, all_: bool) -> Iterator[tuple]:
        for i in range(len(self.texts)) if all_ else np.flatnonzero(self.count).tolist():
            less, form = self.best.get(i, (None, None))
            yield self.texts[i], int(self.n[i]), int(self.count[i]), less, form


FOUND = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("less", pa.int64()), ("form", pa.string())])


def _in_shard(group: pa.Table) -> pa.Table:
    kinds = group.column("kind").to_numpy()
    parts = []
    for kind in (HOME, SAME, SHORTER):
        some = group.filter(pa.array(kinds == kind))
        parts.append(Best(some.column("word").to_pylist(), some.column("n").to_numpy()))
    home = parts[HOME]
    if home.texts:
        shard = Shard(home.texts)
        for kind, best in enumerate(parts):
            if best.texts:
                for mine, theirs in shard.near(shard.codes if kind == HOME else letters(best.texts), kind == HOME):
                    best.hear(mine, home, theirs)
                    home.hear(theirs, best, mine)
    rows = [r for kind, best in enumerate(parts) for r in best.rows(kind == HOME)]
    columns = zip(*rows) if rows else [()] * 5
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)


def shard_words(length: int) -> int:
    """Distinct words a shard should hold: fewer where words are long."""
    return max(LEAF, min(SHARD_WORDS, SHARD_LETTERS // length))


def _upper_trees(table: DataFrame, sample: int) -> dict[int, Tree]:
    share = max(1, -(-table.count() // sample))
    rows = table.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").collect()
    by_length: dict[int, list[str]] = {}
    for r in sorted(rows):
        by_length.setdefault(len(r.word), []).append(r.word)
    # A shard's share of the sample, but no split of a handful of sampled words.
    leaf = lambda size: max(shard_words(size) // share, SAMPLE_LEAF if share > 1 else LEAF)
    return {size: Tree(counts(letters(some)), leaf(size)) for size, some in by_length.items()}


def _routed(trees: dict[int, Tree]):
    """Every word to the shard of its box, and as a visitor to the shards its searches reach."""
    schema = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = np.array(batch.column("word").to_pylist(), dtype=object), batch.column("n").to_numpy()
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                for at in range(0, len(mine), max(1, LETTERS_AT_ONCE // max(size, CLASSES))):
                    some = mine[at : at + max(1, LETTERS_AT_ONCE // max(size, CLASSES))]
                    vectors = counts(letters(texts[some].tolist()))
                    tree = trees.get(size)
                    home = tree.home(vectors) if tree else np.zeros(len(some), dtype=np.int64)
                    sent = [(HOME, size, np.arange(len(some)), home)]
                    if tree:
                        row, leaf = tree.search(vectors, 2)
                        sent.append((SAME, size, row[leaf > home[row]], leaf[leaf > home[row]]))
                    longer = trees.get(size + 1)
                    row, leaf = longer.search(vectors, 1) if longer else (np.arange(len(some)), np.zeros(len(some), dtype=np.int64))
                    sent.append((SHORTER, size + 1, row, leaf))
                    for kind, length, row, leaf in sent:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array((length << 32) + leaf), pa.array(np.full(len(row), kind), pa.int32()),
                                pa.array(texts[some[row]], pa.string()), pa.array(n[some[row]], pa.int64()),
                            ],
                            schema=schema,
                        )

    return run


def near_words(table: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(word, n) with distinct words to word, n, n_near, best_n, best: near words and the one that occurs most. Runs jobs."""
    trees = _upper_trees(table, sample)
    routed = table.mapInArrow(_routed(trees), "shard long, kind int, word string, n long")
    found = routed.groupBy("shard").applyInArrow(_in_shard, "word string, n long, n_near long, less long, form string")
    best: Column = F.min(F.when(F.col("form").isNotNull(), F.struct("less", "form")))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last. n grows tenfold a step, so rounds are few."""
    reached = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while reached.where("moved").limit(1).count():
        onward = reached.select(F.col("word").alias("via"), F.col("root").alias("next"))
        reached = stored(
            reached.join(onward, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "forms",
        )
    return reached.select("word", "root")


def variants(docs: DataFrame, times: int = TIMES, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of documents. Runs jobs."""
    table = stored(words(docs), "words")
    found = near_words(table, sample)
    common = F.col("best_n") >= times * F.col("n")
    near = stored(
        found.select("word", "n", "n_near", F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")),
        "near-words",
    )
    last = roots(near.where(F.col("form").isNotNull()))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
