"""Toxicity by noisy-channel deobfuscation and a word model on the restored text.

1. A character language model (orders 1 to 4 over 28 symbols, Witten-Bell interpolation) is counted over the training
   rows' whole texts; its table has a fixed size, 28^4 cells.
2. Disguised spans become character lattices: words with digits or symbols in any place, letters drawn out three times
   or more, words whose parts are set apart by other characters, and runs of parts of up to four characters set apart by
   blanks. Each written character may stand for itself, for a letter it resembles, or for nothing, a star inside a word for
   any letter, and what sets parts apart may be deleted. The best path under channel and language model, found by Viterbi
   search, is the restored text. Where parts are joined, and where a word has no plain letter, the written parts count as
   words beside the restored ones. Other words pass unchanged.
3. Words of restored texts are weighed against ``labels.toxic``: each word's document counts by label (equal texts count
   once) give a likelihood-ratio statistic G2. All words above ``least_g2`` whose false-discovery rate (Benjamini-Hochberg
   over the words in three or more rows) is at most ``discovery`` enter a ridge logistic regression fitted on patterns of
   those words; the ridge shrinks weak ones. Every labelled training row takes part in the counts and in the fit, which
   is Spark's own learner over all patterns.

The label model sees restored words only: ids, languages, sources and labels are never inputs of a score.

Cases: null and empty texts get the score of a text without any weighed word; without labelled rows that is the prior of
``toxic`` of one in a hundred; labels that are null are unlabelled rows; a document labelled more than once counts once
per label; runs of one character are read as three of them, and words of any length are restored; repeated ids and null ids are
scored row by row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import LOWER_BYTES, fold, fresh, quoted, stored, text_or_empty

# Which letters a written character may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il"}
SYMBOLS = b"@$!+|"

KEPT = set(range(97, 123)) | set(range(48, 58)) | set(SYMBOLS) | set(range(128, 256))
CLEAN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b in KEPT else 32 for b in range(256))
ORDER, SIZE = 4, 28  # symbols: 0 blank, 1-26 letters, 27 any other letter
SYMBOL_BYTES = bytes(b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else 27 if b >= 128 else 0 for b in range(256))
STARRED = bytes(42 if b == 42 else c for b, c in enumerate(CLEAN_BYTES))  # with the stars left
STAR = re.compile(rb"(?<=[a-z0-9@$!+|])\*+(?=[a-z0-9@$!+|])")
# Parts of up to four bytes, set apart by blanks.
APART = re.compile(rb"(?<![^ ])[a-z0-9@$!+|]{1,4}(?: +[a-z0-9@$!+|]{1,4})+(?![^ ])")
RUN = re.compile(rb"(.)\1{3,}", re.DOTALL)
DRAWN_OUT = re.compile(rb"([a-z])\1\1")
DOUBLED = re.compile(rb"([a-z])\1")
REPEATED = re.compile(rb"([a-z])\1+")
ONLY_LETTERS = re.compile(rb"[a-z]+")
BLANKS = re.compile(rb" +")
HEAD = 12  # letters of a weighed word that a span must hold to be decoded
PARTS = re.compile(rb"[a-z]+(?: [a-z]+)+")
INSIDE = re.compile(rb"[a-z0-9@$!+|\x80-\xff][^a-z0-9@$!+|\x80-\xff]+[a-z0-9@$!+|\x80-\xff]")
LETTER_BYTES = [bytes([b]) for b in range(256)]
LETTERS, STRANGE = re.compile(rb"[a-z]"), re.compile(rb"[0-9@$!+|]")
# Channel log-probabilities: a letter disguised, a written character that stands for nothing, a blank inside a word.
DISGUISED, NOTHING, JOINED = math.log(0.3), math.log(0.2), math.log(0.5)
ANY = DISGUISED


def character_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all 4-symbol windows over a column of bytes, as an array of 28^4 cells."""
    cells = SIZE**ORDER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        codes, held = [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                s = np.frombuffer(data.translate(SYMBOL_BYTES), dtype=np.uint8)
                s = np.r_[np.zeros(ORDER - 1, np.uint8), s, np.uint8(0)].astype(np.int32)
                s = s[np.r_[True, True, True, (s[3:] > 0) | (s[2:-1] > 0)]]
                n = len(s) - ORDER + 1
                code = s[:n]
                for k in range(1, ORDER):
                    code = code * SIZE + s[k : k + n]
                codes.append(code)
                held += n
                if held > cells:
                    total += np.bincount(np.concatenate(codes), minlength=cells)
                    codes, held = [], 0
        if codes:
            total += np.bincount(np.concatenate(codes), minlength=cells)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 50_000):
            part = at[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["code", "n"])

    # At most 28^4 rows, whatever the corpus.
    rows = texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells, dtype=np.float64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | three symbols before), Witten-Bell interpolated down to the uniform distribution."""
    lower = np.full(SIZE, 1.0 / SIZE)
    for order in range(1, ORDER + 1):
        c = counts.reshape(-1, SIZE**order).sum(axis=0).reshape(-1, SIZE)
        total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(lower.reshape(-1, SIZE), (len(c) // max(1, lower.size // SIZE), 1)) if order > 1 else lower[None, :]
        mixed = np.where(total > 0, (c + kinds * shorter) / np.maximum(total + kinds, 1), shorter)
        lower = mixed.reshape(-1)
    return np.log(lower).astype(np.float32)


def decode(written: bytes, model: np.ndarray) -> bytes:
    """The likeliest clean text for a disguised span."""
    steps: list[list[tuple[int, float]]] = []  # per character: (symbol or -1 for nothing, channel log-probability)
    before = ""
    for c in written.decode("utf-8", "replace"):
        if c == " ":
            options = [(-1, JOINED), (0, JOINED)]
        elif "a" <= c <= "z":
            options = [(ord(c) - 96, 0.0)]
            if c == before:
                options.append((-1, NOTHING))
        elif c == "*":
            options = [(x, ANY) for x in range(1, 27)] + [(0, JOINED), (-1, NOTHING)]
        elif c in LOOKALIKES:
            options = [(ord(x) - 96, DISGUISED) for x in LOOKALIKES[c]] + [(-1, 2 * NOTHING)]
        else:
            options = [(27, 0.0)]
        before = c
        steps.append(options)
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # state: (score, path as linked symbols)
    top = SIZE ** (ORDER - 1)
    for options in [*steps, [(0, 0.0)]]:
        then: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for symbol, cost in options:
                if symbol < 0:
                    to, total, out = state, score + cost, path
                else:
                    at = state * SIZE + symbol
                    to, total, out = at % top, score + cost + float(model[at]), (path, symbol)
                held = then.get(to)
                if held is None or total > held[0]:
                    then[to] = (total, out)
        best = then
    path, symbols = max(best.values(), key=lambda x: x[0])[1], []
    while path is not None:
        path, symbol = path
        symbols.append(32 if symbol == 0 else symbol + 96 if symbol < 27 else 63)
    return bytes(symbols[::-1]).strip()


class PartSymbols(dict):
    """The symbols of a part of a-z; none for a single letter or one with a letter doubled, which leave more paths."""

    def __missing__(self, part: bytes) -> bytes:
        if len(self) > 100_000:
            self.clear()
        symbols = self[part] = b"" if len(part) < 2 or DOUBLED.search(part) else part.translate(SYMBOL_BYTES)
        return symbols


def decode_parts(span: bytes, model: list[float], known: PartSymbols) -> bytes:
    """``decode`` for parts of a-z set apart by single blanks. Mostly one path is left, or two that differ in the third
    symbol from the end: these meet again on the first letter after a blank, or by the blank itself. Sums and ties are those
    of ``decode``."""
    top, last_two = SIZE ** (ORDER - 1), SIZE ** (ORDER - 2)
    paths: dict[int, tuple[float, bytes]] = {0: (0.0, b"")}  # state: (score, text)
    state, score, text = 0, 0.0, b""  # the first of them, and ``state2`` the second, while ``ways`` is 1 or 2
    state2, score2, text2 = 0, 0.0, b""
    ways, first = 0, True
    for part in span.split(b" "):
        symbols = known[part] if ways else b""
        if symbols:
            at = state * SIZE
            joined, apart, tail = score + JOINED, score + JOINED + model[at], text
            if ways == 2:
                at2 = state2 * SIZE
                more = score2 + JOINED + model[at2]
                if more > apart:
                    apart, tail = more, text2
            blank = at % top * SIZE + symbols[0]
            at += symbols[0]
            joined, apart = joined + model[at], apart + model[blank]
            if ways == 2:
                more = score2 + JOINED + model[at2 + symbols[0]]
                if more > joined:
                    joined, text = more, text2
            at, blank = at % top * SIZE + symbols[1], blank % top * SIZE + symbols[1]
            joined, apart = joined + model[at], apart + model[blank]
            if len(symbols) == 2:
                ways, state, state2 = 2, at % top, blank % top
                score, text, score2, text2 = joined, text + part, apart, tail + b" " + part
                continue
            at, blank = at % top * SIZE + symbols[2], blank % top * SIZE + symbols[2]
            joined, apart = joined + model[at], apart + model[blank]
            ways, state = 1, at % top
            score, text = (apart, tail + b" " + part) if apart > joined else (joined, text + part)
            for c in symbols[3:]:
                at = state * SIZE + c
                state, score = at % top, score + model[at]
            continue
        if ways:
            paths = {state: (score, text)}
            if ways == 2:
                paths[state2] = (score2, text2)
        if not first:
            paths = _over_blank(paths, model)
        first = False
        before = -1
        for c in part:
            then: dict[int, tuple[float, bytes]] = {}
            letter = LETTER_BYTES[c]
            for s, (total, out) in paths.items():
                at = s * SIZE + c - 96
                to, more = at % top, total + model[at]
                held = then.get(to)
                if held is None or more > held[0]:
                    then[to] = (more, out + letter)
                if c == before:
                    held = then.get(s)
                    if held is None or total + NOTHING > held[0]:
                        then[s] = (total + NOTHING, out)
            paths, before = then, c
        ways = 0
        if len(paths) < 3:
            (state, (score, text)), *second = paths.items()
            if not second:
                ways = 1
            elif second[0][0] % last_two == state % last_two:
                ways = 2
                state2, (score2, text2) = second[0]
    if ways == 1:
        return text
    if ways == 2:
        paths = {state: (score, text), state2: (score2, text2)}
    ends: dict[int, tuple[float, bytes]] = {}
    for s, (total, out) in paths.items():
        to, total = s * SIZE % top, total + model[s * SIZE]
        held = ends.get(to)
        if held is None or total > held[0]:
            ends[to] = (total, out)
    return max(ends.values(), key=lambda x: x[0])[1]


def _over_blank(paths: dict[int, tuple[float, bytes]], model: list[float]) -> dict[int, tuple[float, bytes]]:
    """Paths that leave a blank out, and paths that write it."""
    then: dict[int, tuple[float, bytes]] = {}
    for s, (total, out) in paths.items():
        total += JOINED
        held = then.get(s)
        if held is None or total > held[0]:
            then[s] = (total, out)
        to, more = s * SIZE % SIZE ** (ORDER - 1), total + model[s * SIZE]
        held = then.get(to)
        if held is None or more > held[0]:
            then[to] = (more, out + b" ")
    return then


def _once(letters: bytes) -> bytes:
    """Letters without blanks, each run of one letter as a single one."""
    joined = letters.replace(b" ", b"")
    return REPEATED.sub(rb"\1", joined) if DOUBLED.search(joined) else joined


def _any_of(words: set[bytes]) -> bytes:
    """A pattern for texts that hold one of ``words``, which branches letter by letter."""
    if b"" in words:
        return b""
    heads: dict[bytes, set[bytes]] = {}
    for word in words:
        heads.setdefault(word[:1], set()).add(word[1:])
    return b"(?:" + b"|".join(re.escape(head) + _any_of(tails) for head, tails in sorted(heads.items())) + b")"


class Restored(dict):
    """A written word to its clean words, remembered within a task up to a number of words; those that pass unchanged are in
    ``plain``, runs of plain parts are not remembered. With ``wanted``, clean words outside it may be left out."""

    def __init__(self, model: np.ndarray, wanted: Collection[bytes] | None = None):
        super().__init__()
        # Decoding plain parts drops blanks and repeated letters only: the letters of each word it gives stand in the span in
        # a row, but for these.
        heads = {_once(w)[:HEAD] for w in wanted or () if ONLY_LETTERS.fullmatch(w)}
        self.hold = None if wanted is None else re.compile(_any_of(heads) if heads else rb"(?!)")
        self.model: list[float] = model.tolist()
        self.plain: set[bytes] = set()
        self.symbols = PartSymbols()

    def __missing__(self, word: bytes) -> tuple[bytes, ...]:
        if len(self) > 500_000:
            self.clear()
        if b" " in word or b"*" in word:  # parts set apart: what is joined counts beside what is written
            out = tuple(decode(RUN.sub(rb"\1\1\1", word), self.model).split())
        elif DRAWN_OUT.search(word) or STRANGE.search(word):
            out = tuple(decode(RUN.sub(rb"\1\1\1", word), self.model).split())
            if not LETTERS.search(word):
                out += (word,)
        else:
            out = (word,)
        self[word] = out
        return out

    def words(self, written: set[bytes]) -> set[bytes]:
        """Clean words of words without blanks."""
        if len(self.plain) > 500_000:
            self.plain.clear()
        found = set(written)
        others = []
        for word in written - self.plain:
            if word not in self and not (DRAWN_OUT.search(word) or STRANGE.search(word)):
                self.plain.add(word)
            else:
                others.append(word)
        found.difference_update(others)
        for word in others:
            found.update(self[word])
        return found

    def parts(self, span: bytes) -> list[bytes] | tuple[bytes, ...]:
        """Clean words of parts set apart by single blanks."""
        if PARTS.fullmatch(span):
            if self.hold is not None and not self.hold.search(_once(span)):
                return ()
            return decode_parts(RUN.sub(rb"\1\1\1", span), self.model, self.symbols).split()
        return self[span]


def restored_words(data: bytes, memo: Restored) -> set[bytes]:
    """Distinct clean words of a whole text."""
    clean = data.translate(CLEAN_BYTES)
    written = set(clean.split())
    found = memo.words(written)
    for span in set(APART.findall(clean)):
        found.update(memo.parts(re.sub(rb" +", b" ", span) if b"  " in span else span))
    # Parts of one written word, set apart by characters that are neither blank nor kept; stars inside it. A word of kept
    # characters only is in ``written``.
    for word in set(data.translate(LOWER_BYTES).split()) - written:
        if INSIDE.search(word):
            span = b" ".join(STAR.sub(b"\0", word.translate(STARRED)).replace(b"*", b" ").replace(b"\0", b"*").split())
            found.update(memo.parts(span))
    return found


def _bytes_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text"))


def labelled_words(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> DataFrame:
    """One row per distinct (text, label) of the training rows: toxic, words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Restored(shared.value)
        for batch in batches:
            words = [sorted(restored_words(t, memo)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.binary()))], names=["toxic", "words"]
            )

    marked = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    training = docs.where(fold() != 0)
    # Of equal texts with one label the smallest id is read: decided on hashes, before any text moves.
    hashes = training.select("doc_id", F.xxhash64(text_or_empty()).alias("h"))
    chosen = (
        hashes.join(marked, "doc_id").groupBy("h", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")
    )
    # The same plan at every size: texts move once, to their labels.
    rows = _bytes_of(training).join(chosen.hint("merge"), "doc_id")
    return rows.select("toxic", "text").mapInArrow(run, "toxic int, words array<binary>")


def fit(
    docs: DataFrame, labels: DataFrame, least_g2: float = 20.0, discovery: float = 0.05
) -> tuple[np.ndarray, dict[bytes, float], float]:
    """(character model, word weights, bias). Runs jobs."""
    model = character_model(character_counts(_bytes_of(docs.where(fold() != 0)).select("text")))
    rows = stored(labelled_words(docs, labels, model), "labelled")
    n, positive = (x or 0 for x in rows.agg(F.count(F.lit(1)), F.sum("toxic")).first())
    prior = (positive + 0.5) / (n + 1.0) if n else 0.01
    bias = math.log(prior / (1 - prior))
    if not 0 < positive < n:
        return model, {}, bias
    k, m = F.col("k").cast("double"), F.col("n").cast("double")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = positive / n
    g2 = 2 * (
        part(k, m * share) + part(m - k, m * (1 - share)) + part(positive - k, (n - m) * share)
        + part((n - positive) - (m - k), (n - m) * (1 - share))
    )
    tested = stored(
        rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
        .agg(F.sum("toxic").alias("k"), F.count(F.lit(1)).alias("n")).where("n >= 3")
        .select("word", F.when((F.col("k") >= 3) & (k / m > share), g2).otherwise(0.0).alias("g2")),
        "tested",
    )
    level = F.floor(F.log2("g2") * 64)
    levels = tested.where(F.col("g2") >= least_g2).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least = _discovery_level([(r["level"], r["n"]) for r in levels], tested.count(), discovery)
    chosen = tested.where((F.col("g2") >= least_g2) & (level >= F.lit(float(least)))).select("word").orderBy("word").collect()
    chosen = [bytes(r["word"]) for r in chosen]
    if not chosen:
        return model, {}, bias
    wanted = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(chosen)})

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = wanted.value
        for batch in batches:
            found = [sorted(number[w] for w in words if w in number) for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "words"])

    patterns = stored(
        rows.select("toxic", "words").mapInArrow(numbered, "toxic int, words array<int>")
        .groupBy("words").agg(F.sum("toxic").alias("k"), F.count(F.lit(1)).alias("n")),
        "patterns",
    )
    weights, bias = _ridge_logistic(patterns, len(chosen), bias)
    return model, dict(zip(chosen, weights.tolist(), strict=True)), bias


def _discovery_level(levels: list[tuple[int, int]], tested: int, rate: float) -> float:
    """The least level (64 to a power of two) from which all G2 above it keep the false-discovery rate."""
    least, above = math.inf, 0
    for level, n in sorted(levels, reverse=True):
        above += n
        if math.erfc(math.sqrt(2.0 ** (level / 64) / 2)) * tested <= rate * above:
            least = level
    return least


def _ridge_logistic(patterns: DataFrame, width: int, bias: float, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and bias of the ridge logistic regression on rows of (words, k toxic of n), by Spark's own learner on sparse
    vectors: a pattern is one row of label 1 that weighs k and one of label 0 that weighs n - k. The penalty is per row there
    and per table here. ``bias`` is what remains without any weight."""
    vector = F.udf(lambda words: Vectors.sparse(width, words, [1.0] * len(words)), VectorUDT())
    sides = F.explode(F.array(
        F.struct(F.lit(1.0).alias("y"), F.col("k").cast("double").alias("w")),
        F.struct(F.lit(0.0).alias("y"), (F.col("n") - F.col("k")).cast("double").alias("w")),
    ))
    rows = patterns.select(vector("words").alias("x"), sides.alias("s")).select("x", "s.y", "s.w").where("w > 0")
    total = patterns.agg(F.sum("n")).first()[0]
    if not total:
        return np.zeros(width), bias
    model = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="w", regParam=ridge / total, standardization=False, maxIter=1000, tol=1e-12,
    ).fit(rows)
    return model.coefficients.toArray(), float(model.intercept)


def with_score(docs: DataFrame, labels: DataFrame, name: str = "score", **settings) -> DataFrame:
    """All columns of ``docs`` and the score, row by row."""
    model, weights, bias = fit(docs, labels, **settings)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    @F.pandas_udf("double")
    def score_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo, known = Restored(*shared.value), shared.value[1]
        for part in texts:
            z = [bias + sum(sorted(known[w] for w in restored_words(t, memo) if w in known)) for t in part]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -40, 40))))

    return docs.withColumn(name, score_of(text_or_empty().cast("binary")))


def score(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    return with_score(docs.select("doc_id", "text"), labels, **settings).select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    name = fresh(docs, "_toxic_score")
    return with_score(docs, labels, name, **settings).where(F.col(name) < 0.5).select(*quoted(docs))
