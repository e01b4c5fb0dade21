"""Short codes for vectors: integer product quantisation whose nearest entries are searched on Walsh-Hadamard coefficients.

A component x becomes floor(1024 * x), a vector is cut into equal consecutive parts, and each part position has a codebook.
It starts as that part of the vectors with the smallest ids; every round assigns all parts to their nearest entries (squared
Euclidean distance, ties to the lower index) and replaces each entry by the floored mean of its parts.

Nearest entries. Parts and entries are padded with zeros to a power of two, n, and taken through the integer Walsh-Hadamard
transform, additions and subtractions only. It multiplies every squared distance by exactly n and gathers most of it in the
coefficients of low sequency. Squared differences are summed in that order; after a few coefficients the nearest entry so far
is measured whole, and entries whose partial sum is larger go, since the sum can only grow. Entries that tie stay to the end.
All of it is in 64-bit integers, so results are exact.

Plan. A round is one pass over the vectors: each task sums its parts by entry, Spark adds the sums up, and the driver holds
the codebooks and nothing else: ``entries`` times the vector's length, whatever the number of vectors. Sums by label are
combined before they move and joined to salted labels, so a hot label is no single task.

Rows. A vector that is null or holds a null or non-finite component is dropped. One length is coded, the commonest (ties:
the longer); it is padded with zeros to a multiple of the number of parts. A vector of another length, or with a component
so large that sums could pass 64 bits (magnitude 2^20 for vectors of 64), is returned with null code and error. Repeated
rows are coded each; among rows of one id the smaller vector comes first, a null id comes last. With fewer vectors than
entries there are fewer entries; without vectors the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outagegrid.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
AT_ONCE = 1024  # parts measured side by side in a task
FIRST = 2  # coefficients summed for all entries before any goes
SALTS = 16


@dataclass(frozen=True)
class Codebooks:
    """``parts`` arrays of entries by width, the length they are for, and what makes integers of components."""

    books: tuple[np.ndarray, ...]
    length: int
    scale: int

    @property
    def width(self) -> int:
        return -(-self.length // len(self.books))

    @property
    def limit(self) -> int:
        """Integers below it leave room for all sums: n * n * (2 * limit)^2 stays under 2^63."""
        return 2**30 // padded(self.width)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def padded(width: int) -> int:
    return 1 << max(width - 1, 0).bit_length()


def sequency_order(n: int) -> np.ndarray:
    """Rows of the natural-order transform by their number of sign changes: the Gray code of the number, bits reversed."""
    s = np.arange(n)
    gray, out = s ^ (s >> 1), np.zeros(n, dtype=np.int64)
    for _ in range(n.bit_length() - 1):
        out = (out << 1) | (gray & 1)
        gray >>= 1
    return out


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """Coefficients of integer rows, padded to a power of two, in sequency order."""
    count, width = rows.shape
    n = padded(width)
    a = np.zeros((count, n), dtype=np.int64)
    a[:, :width] = rows
    half = 1
    while half < n:
        a = a.reshape(count, n // (2 * half), 2, half)
        a = np.concatenate([a[:, :, :1] + a[:, :, 1:], a[:, :, :1] - a[:, :, 1:]], axis=2)
        half *= 2
    return a.reshape(count, n)[:, sequency_order(n)]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part: transformed parts against transformed entries, exact, ties to the lower."""
    n = parts.shape[1]
    sums = np.zeros((len(parts), len(book)), dtype=np.int64)
    for c in range(min(FIRST, n)):
        sums += np.square(parts[:, c, None] - book[None, :, c])
    guess = book[sums.argmin(axis=1)]
    bound = np.square(parts - guess).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    total = sums[row, entry]
    at, step = FIRST, 2
    while at < n:
        for c in range(at, min(at + step, n)):
            total += np.square(parts[row, c] - book[entry, c])
        stay = total <= bound[row]
        row, entry, total = row[stay], entry[stay], total[stay]
        at, step = at + step, step * 2
    starts = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(total, starts)
    first = np.full(len(parts), len(book), dtype=np.int64)
    at_least = total == least[row]
    np.minimum.at(first, row[at_least], entry[at_least])
    return first, least // n


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def _integers(vectors: DataFrame, vector: str, columns: list[str], scale: int) -> DataFrame:
    """``columns`` of the kept rows under neutral names, and the vector's integers."""
    names = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]
    v = F.col(f"`{vector}`")
    return vectors.where(_usable(v)).select(
        *names, F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, length: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have ``length`` components below ``limit``, those rows as integers)."""
    sizes = np.diff(column.offsets.to_numpy())
    fits = sizes == length
    flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(int(fits.sum()), length)
    small = ((flat < limit) & (flat > -limit)).all(axis=1)
    fits[np.flatnonzero(fits)[~small]] = False
    return fits, flat[small]


def _cut(rows: np.ndarray, parts: int, width: int) -> np.ndarray:
    wide = np.zeros((len(rows), parts * width), dtype=np.int64)
    wide[:, : rows.shape[1]] = rows
    return wide.reshape(len(rows), parts, width)


def _assigned(books: Codebooks, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: which rows are coded, their parts, entries (rows by parts) and squared distances."""
    fits, rows = _matrix(column, books.length, books.limit)
    parts = _cut(rows, len(books.books), books.width)
    entries, errors = (np.zeros(parts.shape[:2], dtype=np.int64) for _ in range(2))
    for p, book in enumerate(books.books if len(rows) else ()):
        table = walsh_hadamard(book)
        for at in range(0, len(rows), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            entries[some, p], errors[some, p] = nearest(walsh_hadamard(parts[some, p]), table)
    return fits, parts, entries, errors


def _updated(ints: DataFrame, books: Codebooks) -> Codebooks:
    """One round: all parts assigned, entries replaced by the floored means of their parts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros_like(b) for b in books.books]
        count = [np.zeros(len(b), dtype=np.int64) for b in books.books]
        for batch in batches:
            _, parts, entries, _ = _assigned(books, batch.column("v"))
            for p in range(len(total)):
                np.add.at(total[p], entries[:, p], parts[:, p])
                count[p] += np.bincount(entries[:, p], minlength=len(count[p]))
        rows = [
            (p, e, int(count[p][e]), total[p][e].tolist()) for p in range(len(total)) for e in np.flatnonzero(count[p]).tolist()
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())])],
            ["p", "e", "n", "sums"],
        )

    partial = ints.select("v").mapInArrow(sums, "p int, e int, n long, sums array<long>")
    added = partial.select("p", "e", "n", F.posexplode("sums").alias("at", "x")).groupBy("p", "e", "at").agg(
        F.sum("n").alias("n"), F.sum("x").alias("x")
    )
    new = [b.copy() for b in books.books]
    for r in added.collect():  # at most entries x length rows
        new[r.p][r.e, r.at] = r.x // r.n
    return Codebooks(tuple(new), books.length, books.scale)


def train(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of a table of vectors, None without any vector. Runs 2 + ``rounds`` jobs."""
    ints = _integers(vectors, vector, [id_column], scale)
    size = F.size("v")
    common = ints.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return None
    empty = Codebooks(tuple(np.zeros((0, -(-common["size"] // parts)), dtype=np.int64) for _ in range(parts)), common["size"], scale)
    small = F.forall("v", lambda x: (x < empty.limit) & (x > -empty.limit))
    seeds = ints.where((size == empty.length) & small).orderBy(F.col("c0").asc_nulls_last(), "v").limit(entries).collect()
    if not seeds:
        return empty
    rows = np.array([r.v for r in seeds], dtype=np.int64).reshape(len(seeds), empty.length)
    cut = _cut(rows, parts, empty.width)
    books = Codebooks(tuple(cut[:, p].copy() for p in range(parts)), empty.length, scale)
    for _ in range(rounds):
        books = _updated(ints, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, columns: list[str], vector: str = "embedding") -> DataFrame:
    """``columns`` of every kept row, its code (two hex digits a part for up to 256 entries) and squared error."""
    source = _integers(vectors, vector, columns, books.scale)
    usable = all(len(b) for b in books.books)
    digits = max(2, len(f"{max((len(b) for b in books.books), default=1) - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.full(batch.num_rows, None, dtype=object), np.full(batch.num_rows, None, dtype=object)
            if usable:
                fits, _, entries, errors = _assigned(books, batch.column("v"))
                code[fits] = ["".join(f"{e:0{digits}x}" for e in row) for row in entries.tolist()]
                error[fits] = errors.sum(axis=1).tolist()
            carried = [batch.column(f"c{k}") for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(code, pa.string()), pa.array(error, pa.int64())], [*batch.schema.names[: len(columns)], "code", "error"]
            )

    schema = T.StructType([*source.schema.fields[: len(columns)], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = source.mapInArrow(run, schema)
    return coded.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "code", "error")


def decode(books: Codebooks, code: str) -> list[int]:
    """The integers a code stands for."""
    digits = len(code) // len(books.books)
    wide = [x for p, b in enumerate(books.books) for x in b[int(code[p * digits : (p + 1) * digits], 16)].tolist()]
    return wide[: books.length]


def compress(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", **settings) -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together), codebooks_sha256. Runs jobs."""
    books = train(vectors, id_column, vector, **settings)
    if books is None:
        books = Codebooks((np.zeros((0, 0), dtype=np.int64),), 0, settings.get("scale", SCALE))
    rows = stored(
        encode(vectors, books, [id_column, label], vector).toDF("vec_id", "label", "code", "error")
        .withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))),
        "codes",
    )
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    spread = totals.select(
        F.col("label").alias("of"), "label_error", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("at")
    )
    return rows.join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("at")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
