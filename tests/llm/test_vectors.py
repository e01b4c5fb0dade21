"""Neighbour search and vector codes against plain loops, and on rows that are hard to take."""

import hashlib
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from outagegrid.llm import block_search, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, score double, n int, v string, c0 int, code string"


@pytest.fixture(scope="module")
def table(spark):
    def build(rows, kind="float"):
        df = spark.createDataFrame([(*r, 0.5, 7, "x", 3, "y") for r in rows], SCHEMA)
        return df.withColumn("embedding", df.embedding.cast(f"array<{kind}>")).repartition(3)

    return build


def some(count, size=8, seed=1, digits=1):
    r = random.Random(seed)
    return [(i, [round(r.uniform(-1, 1), digits) for _ in range(size)], r.choice([0, 1, None])) for i in range(count)]


NAN, INF = float("nan"), float("inf")
HARD = [
    (1, None, 1), (2, [], 1), (3, [0.0] * 8, 1), (4, [1.0] * 7 + [None], 1), (5, [NAN] + [1.0] * 7, None), (6, [INF] * 8, 2),
    (100, [0.5] * 8, None), (100, [0.5] * 8, None), (200, [0.5] * 8, 2), (None, [0.25] * 8, 2), (300, [1.0, 2.0], 2),
    (301, [1.0, 2.5], None), (400, [3e38] * 8, 1), (401, [-3e38] * 8, 1), (-100, [-0.5] * 8, 1),
]


def plain_search(rows, k=10):
    ok = [(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    # Floats as the table holds them.
    ok = [(i, [float(np.float32(x)) for x in v]) for i, v in ok]
    out = []
    for at, (q, a) in enumerate(ok):
        if q % 100:
            continue
        far = [(math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))), i) for j, (i, b) in enumerate(ok) if j != at and len(b) == len(a)]
        out += [(q, n, i, s) for n, (s, i) in enumerate(sorted(far)[:k], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert all(x[3] == pytest.approx(y[3], rel=1e-12) for x, y in zip(a, b))


@pytest.mark.parametrize(
    "rows, stripe", [(some(1201), 100), (some(1201, 3, digits=0), 1 << 20), (some(701, 1500)[::50] + some(7, 1500), 50_000)],
    ids=["plain", "ties", "long"],
)
def test_search_equals_all_pairs(table, rows, stripe):
    same(got(block_search.nearest(table(rows), F.col("vec_id") % 100 == 0, stripe_bytes=stripe)), plain_search(rows))


def test_search_in_double(table):
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in some(301)]
    same(got(block_search.nearest(table(rows, "double"), F.col("vec_id") % 100 == 0)), plain_search(rows))


def test_search_hard_rows(table):
    same(got(block_search.nearest(table(HARD), F.col("vec_id") % 100 == 0)), plain_search(HARD))
    assert got(block_search.nearest(table(HARD).where("false"), F.col("vec_id") % 100 == 0)) == []
    assert got(block_search.nearest(table(HARD[6:7]), F.col("vec_id") % 100 == 0)) == []


def test_bounds_spare_most_pairs_and_equal_vectors():
    r = np.random.default_rng(3)
    middle = r.normal(size=(8, 32))
    values = (middle[r.integers(0, 8, 512)] + r.normal(scale=0.2, size=(512, 32))).astype(np.float32)
    values[300:] = values[0]

    def block(v, at):
        return block_search.Block(np.arange(at, at + len(v)), np.full(len(v), at), np.arange(len(v)), v, block_search.int8_codes(v)[0])

    heaps = block_search.Heaps(4, 10)
    first = block_search.meet(block(values[:4], 10_000), block(values, 0), heaps)
    again = block_search.meet(block(values[:4], 10_000), block(values, 1000), heaps)
    assert first < 4 * 512 / 3 and again < 100


def test_products_are_whole():
    a = np.full((2, 5000), 127, dtype=np.int8)
    assert (block_search.product(a, -a) == -5000 * 127 * 127).all()


# Vector codes.


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """The definition with Python's whole numbers, for vectors of one length divisible by ``parts``."""
    kept = [(i, k, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, k in rows]
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((apart(cut(v, p), e), n) for n, e in enumerate(books[p])) for p in range(parts)] for _, _, v in kept]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, _, v), a in zip(kept, at) if a[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    at = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(d for d, _ in a) for a in at]
    by_label = {}
    for (_, k, _), e in zip(kept, error):
        by_label[k] = by_label.get(k, 0) + e
    key = lambda t: tuple(map(str, t))
    return sorted(((i, "".join(f"{e:02x}" for _, e in a), x, by_label[k], sha) for (i, k, _), a, x in zip(kept, at, error)), key=key)


def coded(df, **settings):
    out = vector_codes.compress(df, **settings)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=lambda t: tuple(map(str, t)))


@pytest.mark.parametrize("size, entries", [(8, 256), (12, 5), (4, 3), (36, 20)])
def test_codes_equal_the_definition(table, size, entries):
    rows = some(300, size, digits=2) + some(20, size, seed=1, digits=2)
    assert coded(table(rows), entries=entries) == plain_codes(rows, entries=entries)


def test_codes_of_few_and_tied(table):
    rows = [(i % 3, [float(i % 2)] * 8, 1) for i in range(10)]
    assert coded(table(rows)) == plain_codes(rows)


def test_codes_hard_rows(table):
    found = {(r[0], r[1] is None) for r in coded(table(HARD))}
    # Null, non-finite and null components go; other lengths and components beyond the exact range have no code.
    assert found == {(2, True), (3, False), (100, False), (200, False), (None, False), (300, True), (301, True), (400, True), (401, True), (-100, False)}
    fits = [r for r in HARD if r[0] in (3, 100, 200, None, -100)]
    assert [r[:3] for r in coded(table(HARD)) if r[1]] == [r[:3] for r in plain_codes(fits)]
    assert coded(table(HARD).where("false")) == [] and coded(table(HARD[:1])) == []
    assert len(coded(table(HARD[-3:-1]))) == 2


def test_lengths_not_divisible(table):
    rows = some(40, 6)
    wide = [(i, [*v[:2], *v[2:4], *v[4:6], 0.0, 0.0], k) for i, v, k in rows]
    assert [r[1:4] for r in coded(table(rows))] == [r[1:4] for r in coded(table(wide))]


def test_transform_keeps_distances_in_sequency_order():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 8, 13, 16):
        a, b = (r.integers(-1000, 1000, (5, width)) for _ in range(2))
        n = vector_codes.padded(width)
        assert (np.square(vector_codes.walsh_hadamard(a) - vector_codes.walsh_hadamard(b)).sum(1) == n * np.square(a - b).sum(1)).all()
        rows = vector_codes.walsh_hadamard(np.eye(n, dtype=np.int64)).T
        assert [(np.diff(row) != 0).sum() for row in rows] == list(range(n))


def test_decode(table):
    rows = some(50, 10)
    books = vector_codes.train(table(rows), entries=64)
    out = vector_codes.encode(table(rows), books, ["vec_id"]).collect()
    ints = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows}
    assert all(sum((a - b) ** 2 for a, b in zip(vector_codes.decode(books, r.code), ints[r.vec_id])) == r.error for r in out)
