"""Removal of repeated byte strings by sharded suffix arrays.

Every byte goes that lies in a string of ``least`` bytes which also starts earlier: in a document with a smaller id, or
earlier in the same one. Strings are judged on the input as it is, overlaps count, and no match crosses documents.

1. **Shards by content.** Each window of ``least`` bytes has a key, the smallest hash of its ``gram``-byte strings, so
   equal windows have equal keys wherever they stand. Windows that follow each other mostly share their key; such a run is
   a segment. Documents are read in narrow tasks; only keys leave them, once per key and block, and come back if they
   occur twice or more anywhere. Segments with a key that occurs once cannot repeat and are never moved.
2. **Copies first.** Whole equal documents are told by digest: all but the first go entirely (if they hold a window at
   all). Equal segments are combined before the shuffle; all but the first of them are repeats from end to end.
3. **Suffix arrays.** Distinct segments meet in the shard of their key, in blocks of about ``block_bytes`` bytes. A block's
   suffix array is built by induced sorting (``suffix_array``), permuted common prefixes give the runs of suffixes that
   share ``least`` bytes, and in each run all windows but the earliest are repeats.
4. A key with more than ``most_segments`` distinct segments (a common line in ever other surroundings) would grow in one
   task; its windows are instead told apart by their 128-bit digests, one row per window, combined before the shuffle.
5. Repeats are united per document, and the rest of its bytes is hashed.

Cases: a null text is empty, an empty or short text loses nothing; rows that share an id are texts of their own, ordered
by a hash of the text; rows that repeat both id and text are one document; a null id comes before all others; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import partitions, stored, text_or_empty
from outagegrid.llm.shingles import mixed
from outagegrid.llm.suffix_array import permuted_common_prefixes, suffix_array

NO_ID = -(2**63)
BLOCK_KEYS = 400_000
BASE = 0x100000001B3


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    out, done = values, 1
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    if done < width:
        n = len(values) - width + 1
        out = pick(out[:n], out[width - done : width - done + n])
    return out


def _grams(data: bytes, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes, by doubling."""
    h = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    n, done, power, rest, total, offset = len(data) - gram + 1, 1, BASE, gram, None, 0
    while True:
        if rest & 1:
            part = h[offset : offset + n]
            total = part if total is None else total * np.uint64(power) + part
            offset += done
        rest >>= 1
        if not rest:
            return mixed(total)
        h = h[:-done] * np.uint64(power) + h[done:]
        done, power = 2 * done, power * power & (2**64 - 1)


def window_keys(data: bytes, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of every window of ``least`` bytes, key at every place that gives one)."""
    if len(data) < least:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    grams, width = _grams(data, gram), least - gram + 1
    low = _sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, dtype=np.uint64)
    # A place gives a key if it is as small as the largest key of the windows around it.
    chosen = grams[_sliding(np.r_[edge, low, edge], width, np.maximum) == grams]
    return low.view(np.int64), chosen.view(np.int64)


def segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, last window) of every run of equal keys."""
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], edge, np.r_[edge[1:], len(keys)][: len(edge)] - 1


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("tie"), text_or_empty().cast("binary").alias("text"),
    )


def repeated_keys(rows: DataFrame, least: int, gram: int, without: DataFrame | None = None) -> DataFrame:
    """doc_id, tie, keys (binary, 64-bit): the keys of a document that occur elsewhere too, one row per document that is not
    in ``without`` (doc_id, tie). A shard answers with a row per group of documents, whatever their number."""
    shards = partitions(rows.sparkSession)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int, int]] = []
        keys: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            flat, at = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            values, first, count = np.unique(flat, return_index=True, return_counts=True)
            many = count > 1
            ids = np.array(docs, dtype=np.int64)
            # Known here already: rows that pass the shuffle as they are, spread over shards.
            again = np.isin(flat, values[many])
            mine, theirs = at[again], flat[again]
            edges = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else []
            out = []
            for a, b in zip(edges, [*edges[1:], len(mine)], strict=True):
                doc = int(mine[a])
                out.append((doc % shards, np.unique(theirs[a:b]).tobytes(), ids[doc].tobytes(), b""))
            shard = (mixed(values.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in range(shards):
                p = order[edges[s] : edges[s + 1]]
                if len(p):
                    owner = ids[at[first[p]]]
                    out.append((s, values[p].tobytes(), owner.tobytes(), many[p].astype(np.uint8).tobytes()))
            docs.clear(), keys.clear()
            a, *rest = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int32()), *[pa.array(x, pa.binary()) for x in rest]], names=["shard", "keys", "owner", "many"]
            )

        for batch in batches:
            for doc_id, tie, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = window_keys(data, least, gram)[1]
                if len(found):
                    docs.append((doc_id, tie)), keys.append(found)
                    size += len(found)
                if size > BLOCK_KEYS:
                    yield from flush()
                    size = 0
        if keys:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, many = [], [], []
        for batch in batches:
            passed = []
            for _, k, o, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if m:
                    keys.append(np.frombuffer(k, np.int64)), owners.append(np.frombuffer(o, np.int64).reshape(-1, 2))
                    many.append(np.frombuffer(m, np.uint8))
                else:
                    doc_id, tie = np.frombuffer(o, np.int64).tolist()
                    passed.append(((doc_id ^ tie) % shards, doc_id, tie, None, k))
            if passed:
                yield _group_rows(passed)
        if not keys:
            return
        keys, owners, many = np.concatenate(keys), np.concatenate(owners), np.concatenate(many)
        _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
        wanted = (count[at] > 1) & (many == 0)
        keys, owners = keys[wanted], owners[wanted]
        group = (owners[:, 0] ^ owners[:, 1]) % shards
        order = np.argsort(group, kind="stable")
        keys, owners, group = keys[order], owners[order], group[order]
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist() if len(keys) else []
        if edges:
            yield _group_rows([
                (int(group[a]), None, None, owners[a:b].tobytes(), keys[a:b].tobytes())
                for a, b in zip(edges, [*edges[1:], len(keys)], strict=True)
            ])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, gone = [], [], set()
        for batch in batches:
            for _, doc_id, tie, o, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k is None:
                    gone.add((doc_id, tie))
                    continue
                keys.append(np.frombuffer(k, np.int64))
                owners.append(np.broadcast_to((doc_id, tie), (len(keys[-1]), 2)) if o is None else np.frombuffer(o, np.int64).reshape(-1, 2))
        if not keys:
            return
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((owners[:, 1], owners[:, 0]))
        keys, owners = keys[order], owners[order]
        edges = np.flatnonzero(np.r_[True, (owners[1:] != owners[:-1]).any(axis=1)])
        stops = np.r_[edges[1:], len(keys)]
        for at in range(0, len(edges), 10_000):
            first, last = edges[at : at + 10_000], stops[at : at + 10_000]
            found = [
                (*owner, keys[a:b].tobytes())
                for owner, a, b in zip(map(tuple, owners[first].tolist()), first.tolist(), last.tolist(), strict=True)
                if owner not in gone
            ]
            if found:
                yield _key_rows(found)

    blocks = rows.mapInArrow(collect, "shard int, keys binary, owner binary, many binary")
    groups = "part int, doc_id long, tie long, owners binary, keys binary"
    wanted = blocks.repartitionById(shards, "shard").mapInArrow(merge, groups)
    if without is not None:
        none = F.lit(None).cast("binary")
        part = F.pmod(F.col("doc_id").bitwiseXOR(F.col("tie")), F.lit(shards)).cast("int")
        wanted = wanted.unionByName(without.select(part.alias("part"), "doc_id", "tie", none.alias("owners"), none.alias("keys")))
    return wanted.repartitionById(shards, "part").mapInArrow(gather, "doc_id long, tie long, keys binary")


def _group_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=["part", "doc_id", "tie", "owners", "keys"],
    )


def _key_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["doc_id", "tie", "keys"]
    )


def _segments_of(least: int, gram: int):
    """mapInArrow function: (doc_id, tie, text, wanted keys) to one row per segment with such a key."""
    names = ["key", "doc_id", "tie", "start", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, tie, data, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted = np.frombuffer(keys, np.int64)
                key, first, last = segments(window_keys(data, least, gram)[0])
                here = np.isin(key, wanted)
                for k, a, b in zip(key[here].tolist(), first[here].tolist(), last[here].tolist(), strict=True):
                    out.append((k, doc_id, tie, a, data[a : b + least]))
                if len(out) > 20_000:
                    yield _segment_rows(out, names)
                    out = []
            if out:
                yield _segment_rows(out, names)

    return run


def _segment_rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    *numbers, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in numbers], pa.array(data, pa.binary())], names=names)


def repeats_in_block(rows: list[tuple[int, int, int, bytes]], least: int) -> list[tuple[int, int, int, int]]:
    """Distinct segments (doc_id, tie, start, bytes), each with its earliest place, to repeats (doc_id, tie, start, end)."""
    if len(rows) < 2 and not any(len(r[3]) > least for r in rows):
        return []
    places = np.array([r[:3] for r in rows], dtype=np.int64)
    by_place = np.lexsort(places.T[::-1])
    rows, places = [rows[i] for i in by_place.tolist()], places[by_place]
    lengths = np.array([len(r[3]) for r in rows])
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    text = np.frombuffer(b"\0".join(r[3] for r in rows) + b"\0", dtype=np.uint8).astype(np.int16) + 2
    text[ends - 1] = 1  # behind every segment, and no byte's symbol
    text[-1] = 0
    which = np.repeat(np.arange(len(rows)), lengths + 1)
    place = np.arange(len(text)) - begins[which]
    whole = place + least <= lengths[which]
    sa = suffix_array(text)
    shared = permuted_common_prefixes(text, sa)
    sa = sa[whole[sa]]
    # Suffixes between two whole ones share with both what these share; the minimum is over a run without gaps.
    together = shared[sa] >= least
    # Earliest: smaller document, then smaller start.
    documents, starts = places[:, :2], places[:, 2]
    new = np.r_[True, (documents[1:] != documents[:-1]).any(axis=1)]
    rank = np.cumsum(new) - 1
    order = (rank[which[sa]] << 40) | (starts[which[sa]] + place[sa])
    edges = np.flatnonzero(~together)
    if not len(edges) or edges[0] != 0:
        edges = np.r_[0, edges]
    first = np.repeat(np.minimum.reduceat(order, edges), np.diff(np.r_[edges, len(order)]))
    late = np.sort(order[order > first])
    if not len(late):
        return []
    document, start = late >> 40, late & ((1 << 40) - 1)
    cut = np.flatnonzero(np.r_[True, (document[1:] != document[:-1]) | (start[1:] > start[:-1] + least)])
    stop = np.r_[cut[1:], len(late)] - 1
    unique = documents[new]
    return [
        (int(unique[d, 0]), int(unique[d, 1]), int(a), int(b) + least)
        for d, a, b in zip(document[cut], start[cut], start[stop], strict=True)
    ]


def _suffix_blocks(least: int, block_bytes: int):
    """mapInArrow function over segments ordered by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            found = repeats_in_block(held, least)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["doc_id", "tie", "start", "end"]
                )

        for batch in batches:
            for key, doc_id, tie, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > block_bytes and key != last:
                    yield from flush()
                    held, size = [], 0
                held.append((doc_id, tie, start, data))
                size += len(data)
                last = key
        if held:
            yield from flush()

    return run


def repeats(docs: DataFrame, least: int = 100, gram: int = 32, block_bytes: int = 2_000_000, most_segments: int = 20_000) -> DataFrame:
    """doc_id, tie, start, end: byte ranges to remove, not yet united. Runs jobs."""
    spark = docs.sparkSession
    rows = _documents(docs)
    digests = stored(
        rows.select("doc_id", "tie", F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").alias("n")), "digests"
    )
    firsts = digests.groupBy("digest").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    copies = stored(
        digests.join(firsts, "digest").where(F.struct("doc_id", "tie") != F.col("first"))
        .select("doc_id", "tie", "n").distinct(),
        "copies",
    )
    # Copies go where a document's keys are gathered: an anti-join would move all keys once more.
    keys = repeated_keys(rows, least, gram, copies.select("doc_id", "tie"))
    found = (
        rows.join(stored(keys, "keys"), ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie"])
        .select("doc_id", "tie", "text", "keys")
        .mapInArrow(_segments_of(least, gram), "key long, doc_id long, tie long, start long, bytes binary")
        .withColumn("digest", F.unhex(F.md5("bytes")))
    )
    found = stored(found, "segments", "zstd")
    distinct = stored(
        found.groupBy("key", "digest").agg(
            F.min(F.struct("doc_id", "tie", "start")).alias("first"), F.first("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("times"),
        ),
        "distinct", "zstd",
    )
    # Segments that are equal from end to end, but for the first.
    again = distinct.where("times > 1").select("key", "digest", "first")
    equal = (
        found.select("key", "digest", "doc_id", "tie", "start", F.length("bytes").alias("n")).join(again, ["key", "digest"])
        .where(F.struct("doc_id", "tie", "start") != F.col("first"))
        .select("doc_id", "tie", "start", (F.col("start") + F.col("n")).alias("end"))
    )
    # Keys with one distinct segment of one window hold nothing more; crowded keys take another way.
    per_key = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("bytes")).alias("most"))
    per_key = stored(per_key.where((F.col("n") > 1) | (F.col("most") > least)), "per_key")
    crowded = per_key.where(F.col("n") > most_segments).select("key")
    usual = distinct.join(per_key.where(F.col("n") <= most_segments).select("key"), "key").select(
        "key", F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie"), F.col("first.start").alias("start"), "bytes"
    )
    sorted_out = usual.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(
        _suffix_blocks(least, block_bytes), "doc_id long, tie long, start long, end long"
    )
    windows = (
        distinct.join(crowded, "key")
        .select("first", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - least)).alias("at"))
        .select(
            F.unhex(F.md5(F.substring("bytes", F.col("at") + 1, F.lit(least)))).alias("window"),
            F.struct(
                F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie"),
                (F.col("first.start") + F.col("at")).alias("start"),
            ).alias("place"),
        )
    )
    earliest = windows.groupBy("window").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded_out = windows.join(earliest, "window").where(F.col("place") != F.col("earliest")).select(
        "place.doc_id", "place.tie", "place.start", (F.col("place.start") + least).alias("end")
    )
    zero = F.lit(0).cast("long")
    whole = copies.where(F.col("n") >= least).select("doc_id", "tie", zero.alias("start"), F.col("n").cast("long").alias("end"))
    return whole.unionByName(equal).unionByName(sorted_out).unionByName(crowded_out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to the united spans and the digest of what is left."""
    for batch in batches:
        out = []
        for doc_id, data, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            removed = n_spans = at = 0
            kept = hashlib.sha256()
            united: list[list[int]] = []
            for s in sorted((s["start"], s["end"]) for s in spans or ()):
                if united and s[0] <= united[-1][1]:
                    united[-1][1] = max(united[-1][1], s[1])
                else:
                    united.append(list(s))
            for a, b in united:
                kept.update(data[at:a])
                removed, n_spans, at = removed + b - a, n_spans + 1, b
            kept.update(data[at:])
            out.append((doc_id, len(data), removed, n_spans, kept.hexdigest(), [x for s in united for x in s]))
        if out:
            a, b, c, d, e, f = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in (a, b, c, d)], pa.array(e), pa.array(f, pa.list_(pa.int64()))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )


def remove_repeats(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (start, end, start, end ... of the removed runs)."""
    spans = repeats(docs, **settings).groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = _documents(docs).join(stored(spans, "spans"), ["doc_id", "tie"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"
    return rows.mapInArrow(_cut, schema).withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
