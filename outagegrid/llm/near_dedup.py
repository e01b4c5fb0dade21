"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of ``rows`` keys are computed per document, each key made of ``band`` minhashes. Table (i, j) is
keyed by the pair (u_i, v_j): ``rows``^2 tables for 2 x ``rows`` x ``band`` minhashes, the square root of what separate
tables would need. Two documents of similarity s meet in some table with probability (1 - (1 - s^band)^rows)^2.
``rows`` follows from the threshold, so that at most ``MOST_MISSED`` of the pairs exactly at it stay apart: 8 rows (7e-5) at
0.85, 10 rows (7e-5) at 0.80.

Documents with equal sets are one node from the start, by a 128-bit digest of the set. Each node is checked on full shingle
sets against one node first, the smallest id of all its tables, which settles most of a large group with a pair per node.
In tables that still hold two components, nodes are checked against a few of the table's nodes of another component (the
smallest id and the smallest under two hashes). What is left in tables that still hold nodes of different components is
divided into families of nodes that look somewhat alike. Inside a family nodes meet by what they differ in from a text of
the family (``_pairs_inside``, without any loss). Only tables that hold several families are enumerated pair by pair, for
pairs of different families, within the length bound that the threshold implies and a sketch of 1024 one-bit minhashes (a
pair at the threshold is dropped six standard deviations away, once in 10^9). There is no cap on tables, partners or
candidates.

Cases: a null text is empty; texts without words have an empty set and link with nothing; rows that share an id are one
node, linked when any of them is; a null doc_id counts as an id larger than all others; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outagegrid.llm.common import fresh, quoted, spent, stored, text_or_empty
from outagegrid.llm.components import components
from outagegrid.llm.shingles import STEP, WordHashes, mixed, shingle_hashes

NO_ID = 2**63 - 1
SKETCH_WORDS = 16
SKETCH_SIGMAS = 6.0
CENTERS = 3
FAMILY = 0.3  # how alike, by their sketches, the nodes of a family are step by step; results do not depend on it
REFERENCES = 15  # nodes that a large family's reference is made of; results do not depend on it
MOST_MISSED = 1e-4  # of the pairs exactly at the threshold, those that share no table
MOST_ROWS = 64  # 4,096 tables


def _minhashes(sets: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """One row per set, ``n`` minimum hashes each. Sets are not empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n), dtype=np.uint64)
    keys = mixed(np.arange(1, n + 1, dtype=np.uint64) * STEP + np.uint64(seed))
    for k in range(n):
        out[:, k] = np.minimum.reduceat(mixed(flat ^ keys[k]), starts)
    return out


def _band_keys(minhashes: np.ndarray, band: int, salt: int) -> np.ndarray:
    grouped = minhashes.reshape(len(minhashes), -1, band)
    total = np.full(grouped.shape[:2], salt, dtype=np.uint64)
    for k in range(band):
        total = mixed(total * STEP + grouped[:, :, k])
    return total.view(np.int64)


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """The lowest bits of 64 x SKETCH_WORDS minimum hashes of one set."""
    n = 64 * SKETCH_WORDS
    keys = mixed(np.arange(1, n + 1, dtype=np.uint64) * STEP + np.uint64(3))
    low = np.full(n, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 256):
        low = np.minimum(low, mixed(shingles[at : at + 256, None] ^ keys[None, :]).min(axis=0))
    return np.packbits((low & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), values.reshape(-1))


SKETCHES = "doc_id long, n long, set_a long, set_b long, u array<long>, v array<long>"


def sketches(docs: DataFrame, width: int, band: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("u", "v")]
        )
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_hashes(t, memo, width) for t in part.column(1).to_pylist()]
                digests = np.array(
                    [(lambda d: (d >> 64, d & (2**64 - 1)))(xxhash.xxh128_intdigest(s.tobytes())) for s in sets],
                    dtype=np.uint64,
                ).reshape(-1, 2).view(np.int64)
                # An empty set gets a placeholder that never reaches a table.
                full = [s if len(s) else np.zeros(1, dtype=np.uint64) for s in sets]
                u = _band_keys(_minhashes(full, band * rows, 1), band, 1)
                v = _band_keys(_minhashes(full, band * rows, 2), band, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]), _lists(u), _lists(v),
                    ],
                    schema=schema,
                )

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(ids.alias("doc_id"), text_or_empty().cast("binary").alias("text")).mapInArrow(run, SKETCHES)


def _tables(nodes: DataFrame) -> DataFrame:
    """One row per node and table: key, id, n."""
    each = F.flatten(F.transform("u", lambda a, i: F.transform("v", lambda b, j: F.xxhash64(a, b, i, j))))
    return nodes.select(F.explode(each).alias("key"), "id", "n")


def _shared_tables(nodes: DataFrame) -> DataFrame:
    """Rows of ``_tables`` whose key has two nodes or more, with the key's centers."""
    # Dealt by key once, for the centers and for the join with them.
    tables = _tables(nodes).repartition("key")
    orders = [F.col("id")] + [F.xxhash64("id", F.lit(k)) for k in range(1, CENTERS)]
    centers = tables.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.min(F.struct(o.alias("o"), F.col("id").alias("id"), F.col("n").alias("n"))).alias(f"c{k}") for k, o in enumerate(orders)],
    ).where("size > 1")
    listed = F.array_distinct(F.array(*[F.struct(F.col(f"c{k}.id").alias("a"), F.col(f"c{k}.n").alias("m")) for k in range(CENTERS)]))
    return stored(tables.join(centers.select("key", listed.alias("centers")).hint("merge"), "key"), "shared", "zstd")


def _full_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """id, shingles (sorted 64-bit hashes) of the nodes ``ids``. Texts move once, by the same plan at every size."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_hashes(t, memo, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    texts = docs.select(doc_id.alias("id"), text_or_empty().cast("binary").alias("text"))
    return stored(texts.join(ids.hint("merge"), "id", "left_semi").mapInArrow(run, "id long, shingles binary"), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) pairs those whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    with_sets = (
        pairs.select("a", "b")
        .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).hint("merge"), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")).hint("merge"), "b")
        .select("a", "b", "x", "y")
    )
    return stored(with_sets.mapInArrow(confirm, "a long, b long").distinct(), "links")


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of tables that hold nodes of more than one component, with their nodes' components."""
    labelled = shared.join(labels, "id", "left").select(*shared.columns, F.coalesce("label", "id").alias("label"))
    open_keys = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    return stored(labelled.join(stored(open_keys, "open-keys"), "key"), "open", "zstd")


def _sketches_of(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """id, sketch of the nodes ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sketch(np.frombuffer(s, np.uint64)) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(np.array(found, dtype=np.int64).reshape(-1, SKETCH_WORDS))], names=["id", "sketch"]
            )

    return stored(sets.join(ids, "id", "left_semi").mapInArrow(run, "id long, sketch array<long>").distinct(), "sketch")


def _differing(x: str, y: str):
    return sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(SKETCH_WORDS)), F.lit(0))


def _families(left: DataFrame, sketch: DataFrame) -> DataFrame:
    """id, family of the nodes of open tables: nodes are of one family if steps between a node and a table's smallest id lead
    from one to the other, each between nodes that look ``FAMILY`` alike."""
    steps = left.select("id", F.col("centers")[0]["a"].alias("a")).where("id != a").distinct()
    alike = (
        steps.join(sketch, "id").join(sketch.select(F.col("id").alias("a"), F.col("sketch").alias("other")), "a")
        .where(_differing("sketch", "other") <= int(64 * SKETCH_WORDS * (1 - FAMILY) / 2)).select("a", F.col("id").alias("b"))
    )
    found = components(stored(alike.distinct(), "alike")).withColumnRenamed("label", "family")
    ids = left.select("id", "label").distinct()
    return stored(ids.join(found, "id", "left").select("id", "label", F.coalesce("family", "id").alias("family")), "families")


def _pairs_across(left: DataFrame, families: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that share a table and may be linked, but are neither known to be in one component nor of one family."""
    with_family = left.select("key", "id", "n", "label").join(families.select("id", "family"), "id")
    mixed_keys = with_family.groupBy("key").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x < y").select("key")
    both = stored(with_family.join(mixed_keys, "key"), "mixed", "zstd").join(sketch, "id")
    s, bits = percent / 100.0, 64 * SKETCH_WORDS
    p = (1 - s) / 2
    most = int(bits * p + SKETCH_SIGMAS * math.sqrt(bits * p * (1 - p)))
    x, y = both.alias("x"), both.alias("y")
    return x.join(
        y,
        (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.family") != F.col("y.family"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent) & (_differing("x.sketch", "y.sketch") <= most),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _references(sets: DataFrame, families: DataFrame) -> DataFrame:
    """family, reference: the shingles that most of some of its nodes have (any set will do, see ``_pairs_inside``)."""
    first = lambda k: F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("o"), F.col("id").alias("id"))).alias(f"r{k}")
    some = families.groupBy("family").agg(F.count(F.lit(1)).alias("size"), *[first(k) for k in range(REFERENCES)])
    several = F.array_distinct(F.array(*[F.col(f"r{k}.id") for k in range(REFERENCES)]))
    read = some.select(
        "family", F.explode(F.when(F.col("size") > REFERENCES, several).otherwise(F.array("r0.id"))).alias("id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for each in batch.column(1).to_pylist():
                values, count = np.unique(np.concatenate([np.frombuffer(s, np.uint64) for s in each]), return_counts=True)
                found.append(values[2 * count > len(each)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["family", "reference"])

    of_family = sets.join(read, "id").groupBy("family").agg(F.collect_list("shingles").alias("shingles"))
    return stored(of_family.mapInArrow(run, "family long, reference binary"), "references")


def _pairs_inside(sets: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """(a, b): what can be linked of the nodes of one family and different components, by their differences from one set.

    With d the size of a node's difference from the family's reference, n that of its set, and shared the size of what two
    differences have in common, two sets differ in d + d' - 2 shared places, so nodes are linked if and only if
    e + e' <= 2 (100 + percent) shared, where e = (100 + percent) d - (100 - percent) n. Nodes with e + e' <= 0 need nothing in
    common; all such are linked with the node of least e. Of any other pair one node is ``far`` (not linked that way with the
    least), and both differences hold a shingle in common that still has enough behind it, in an order that begins with what
    few nodes differ in. So copies of one text meet by a rare change they share, and not by what all have in common."""
    inner = families.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("family")
    families = stored(families.join(inner, "family"), "inner")
    per_d, per_n = 100 + percent, 100 - percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ, e, which = [], [], []
            for s, reference in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                own = np.frombuffer(s, np.uint64)
                differ.append(np.setxor1d(own, np.frombuffer(reference, np.uint64), assume_unique=True).view(np.int64))
                e.append(per_d * len(differ[-1]) - per_n * len(own))
                which.append(xxhash.xxh64_intdigest(s) >> 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(which, pa.int64()), pa.array(e, pa.int64()), pa.array(differ, pa.list_(pa.int64()))],
                names=["family", "id", "label", "which", "e", "differ"],
            )

    # Rows that share an id may have several sets, told apart by ``which``.
    members = sets.join(families, "id").join(_references(sets, families), "family")
    members = stored(
        members.select("family", "id", "label", "shingles", "reference")
        .mapInArrow(run, "family long, id long, label long, which long, e long, differ array<long>"),
        "members",
    )
    plain = members.select("family", "id", "label", "which", "e")
    least = plain.groupBy("family").agg(F.min(F.struct("e", "id", "label")).alias("least"))
    judged = stored(plain.join(least, "family").withColumn("far", F.col("e") + F.col("least.e") > 0), "judged")
    to_least = judged.where(~F.col("far") & (F.col("id") != F.col("least.id")) & (F.col("label") != F.col("least.label")))
    to_least = to_least.select(F.least("id", "least.id").alias("a"), F.greatest("id", "least.id").alias("b"))
    far = judged.where("far").groupBy("family").agg(F.min("e").alias("least_far"))
    bounds = judged.join(far, "family").select("family", "id", "which", "label", "e", "far", F.col("least.e").alias("least"), "least_far")
    same = Window.partitionBy("family", "shingle")
    own = Window.partitionBy("family", "id", "which")
    placed = (
        members.select("family", "id", "which", F.explode("differ").alias("shingle"))
        .withColumn("n", F.count(F.lit(1)).over(same)).where("n > 1")  # what one node alone differs in is shared with none
        .withColumn("behind", F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("n", "shingle")) + 1)
        .select("family", "id", "which", "shingle", (2 * per_d * F.col("behind")).alias("room"))
        .join(bounds, ["family", "id", "which"])
    )
    placed = stored(placed.where((F.col("e") + F.least("least", "least_far") <= F.col("room"))), "placed", "zstd")
    x = placed.where(F.col("e") + F.col("least_far") <= F.col("room")).alias("x")
    y = placed.where("far").alias("y")
    met = x.join(
        y,
        (F.col("x.family") == F.col("y.family")) & (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.id") != F.col("y.id")) & (F.col("x.label") != F.col("y.label"))
        & (~F.col("x.far") | (F.col("x.id") < F.col("y.id")))
        & (F.col("x.e") + F.col("y.e") <= F.least("x.room", "y.room")),
    ).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    return to_least.unionByName(met)


def _remaining_pairs(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that share an open table and may be linked, but are not known to be in one component."""
    sketch = _sketches_of(sets, left.select("id").distinct())
    families = _families(left, sketch)
    return _pairs_across(left, families, sketch, percent).unionByName(_pairs_inside(sets, families, percent)).distinct()


def rows_for(percent: int, band: int, most_missed: float = MOST_MISSED) -> int:
    """The fewest rows a side for which a pair at ``percent`` shares no table with a probability of ``most_missed`` at most."""
    rows, apart = 1, 1 - (percent / 100) ** band
    while 1 - (1 - apart**rows) ** 2 > most_missed and rows < MOST_ROWS:
        rows += 1
    return rows


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, band: int = 2, rows: int | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept, copy_of (the node that stands
    for all documents with the same set). Documents are linked when 100 x intersection >= ``percent`` x union of their
    ``width``-word shingle sets. Runs jobs while it is called."""
    rows = rows_for(percent, band) if rows is None else rows
    members = stored(sketches(docs, width, band, rows), "sketches")
    nodes = stored(
        members.where("n > 0").groupBy("set_a", "set_b", "n").agg(
            F.min("doc_id").alias("id"), F.first("u").alias("u"), F.first("v").alias("v")
        ),
        "nodes",
    )
    shared = _shared_tables(nodes)
    sets = _full_sets(shared.select("id").distinct(), docs, width)
    close = F.least("n", "c.m") * 100 >= F.greatest("n", "c.m") * percent
    pair = [F.least("id", "c.a").alias("a"), F.greatest("id", "c.a").alias("b")]
    to_centers = lambda rows: rows.select("*", F.explode("centers").alias("c")).where((F.col("id") != F.col("c.a")) & close)
    # One pair a node settles most of a large group: the smallest id of all its tables.
    first = stored(
        to_centers(shared.select("id", "n", "centers")).where(F.col("c.a") < F.col("id")).groupBy("id")
        .agg(F.min("c.a").alias("a")).select("a", F.col("id").alias("b")),
        "first",
    )
    links = _linked(first, sets, percent)
    labels = components(links)
    all_shared, shared = shared, _open(shared, labels)
    spent(all_shared)  # first, links, sets and the open tables are stored
    center = labels.select(F.col("id").alias("a"), F.col("label").alias("center_label"))
    stars = stored(
        to_centers(shared.select("id", "n", "label", "centers")).select("id", "n", "label", "c", F.col("c.a").alias("a"))
        .join(center, "a", "left").where(F.col("label") != F.coalesce("center_label", "a")).select(*pair).distinct()
        .join(first, ["a", "b"], "left_anti"),
        "stars",
    )
    links = stored(links.unionByName(_linked(stars, sets, percent)), "links")
    labels = components(links)
    tried = first.unionByName(stars)
    left = _open(shared.drop("label"), labels)
    rest = stored(_remaining_pairs(left, sets, percent).join(tried, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        labels = components(links.unionByName(_linked(rest, sets, percent)))
    standing = nodes.join(labels, "id", "left").select(
        "set_a", "set_b", "n", F.col("id").alias("copy_of"), F.coalesce("label", "id").alias("component_id")
    )
    found = members.select("doc_id", "n", "set_a", "set_b").join(standing, ["set_a", "set_b", "n"], "left")
    missing = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(
        missing("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("copy_of", "doc_id").alias("copy_of"),
        (F.col("doc_id") == F.coalesce("component_id", "doc_id")).alias("kept"),
    ).withColumns({c: missing(c) for c in ("component_id", "copy_of")})


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near duplicates the one with the smallest doc_id."""
    id_ = fresh(docs, "_id")
    gone = near_duplicates(docs, **settings).where("not kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(id_))
    keyed = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    return keyed.join(gone, id_, "left_anti").select(*quoted(docs))
