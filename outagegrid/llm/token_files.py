"""Token ids in shard files with a shared zstandard dictionary.

A data set is a folder with two Parquet tables. ``dictionary`` has one row: hash and bytes of a zstandard dictionary that
is trained on serialized id arrays. ``shards`` has one row per shard, written in ascending doc_id order:

=========== =======================================================================================================
part, seq   place of the shard: range partition, number inside it
first, last smallest and largest doc_id (null ids come first, as the smallest)
before      tokens of earlier shards of the same part
tokens      tokens in the shard
dictionary  sha256 of the dictionary its frames need; empty for none
index       one record per document: doc_id, whether it is null, offset and length of its frame, tokens
body        zstandard frames, one per document, each readable on its own
=========== =======================================================================================================

So one short document costs reading one index and decompressing one frame. Parquet holds the bytes so that files are
committed once whatever tasks are lost or repeated, in any store that Spark reaches. The dictionary is trained on a
bounded sample, at most ``sample_docs`` documents of at most ``sample_chars`` characters, taken by hash; every document is
written in full.

Cases: a null or empty text is written as the end id alone; null and repeated doc_ids are documents of their own, equal ids
in an order of their texts' hashes; too few samples give a raw-content dictionary, none gives no dictionary; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outagegrid.llm.common import partitions, text_or_empty
from outagegrid.llm.token_ids import read_definition, shared_encoder

DICTIONARY_BYTES = 112_640
INDEX = np.dtype([("doc_id", "<i8"), ("null", "?"), ("offset", "<u4"), ("length", "<u4"), ("tokens", "<u4")])
SHARDS = (
    "part int, seq int, first long, last long, before long, tokens long, dictionary string, index binary, body binary"
)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(samples)[-size:] if sum(map(len, samples)) >= 64 else b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, sample_docs: int = 2_000, sample_chars: int = 16_384,
    shard_bytes: int = 4_000_000, level: int = 3,
) -> None:
    """Encode all ``docs`` with the tokenizer file, append ``end_id`` to each, and write them below ``path``."""
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(tokenizer))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    end = np.array([end_id], dtype="<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(definition.value)
        for batch in batches:
            ids = [x + end for x in encoder.encode(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    sample = (
        rows.where(F.length("text").between(1, sample_chars)).orderBy(F.xxhash64("doc_id", "text")).limit(sample_docs)
        .select("text").mapInArrow(encode, "ids binary")
    )
    data = train_dictionary(sorted(bytes(r["ids"]) for r in sample.collect()))
    name = hashlib.sha256(data).hexdigest() if data else ""
    spark.createDataFrame([(name, bytearray(data))], "hash string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(definition.value)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(data))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        index: list[tuple] = []
        body = bytearray()

        def shard() -> pa.RecordBatch:
            nonlocal seq, before, body, index
            table = np.array(index, dtype=INDEX)
            ids = [None if n else i for i, n in zip(table["doc_id"].tolist(), table["null"].tolist(), strict=True)]
            tokens = int(table["tokens"].sum())
            row = [part, seq, ids[0], ids[-1], before, tokens, name, table.tobytes(), bytes(body)]
            types = [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in SHARDS.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)
            seq, before, body, index = seq + 1, before + tokens, bytearray(), []
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                slice_ = batch.slice(at, 512)
                ids = encoder.encode(slice_.column(1).to_pylist())
                for doc_id, x in zip(slice_.column(0).to_pylist(), ids, strict=True):
                    frame = compressor.compress(x + end)
                    index.append((doc_id or 0, doc_id is None, len(body), len(frame), len(x) // 2 + 1))
                    body += frame
                    if len(body) >= shard_bytes:
                        yield shard()
        if index:
            yield shard()

    ordered = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(pack, SHARDS).write.parquet(f"{path}/shards")


def _frames(batch_row: dict, decompressor: zstandard.ZstdDecompressor) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, tokens, raw ids) of a shard."""
    body = memoryview(batch_row["body"])
    for record in np.frombuffer(batch_row["index"], dtype=INDEX):
        frame = body[record["offset"] : int(record["offset"]) + int(record["length"])]
        yield None if record["null"] else int(record["doc_id"]), int(record["tokens"]), decompressor.decompress(frame)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    kept = spark.read.parquet(f"{path}/dictionary").first()
    name, data = kept["hash"], bytes(kept["data"])
    # One row per range partition, as many as the write had.
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("from")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"shard {row['part']}-{row['seq']} needs dictionary {row['dictionary']}, not {name}")
                out, start = [], row["from"] + row["before"]
                for doc_id, tokens, raw in _frames(row, decompressor):
                    out.append((doc_id, start, tokens, np.frombuffer(raw, "<u2").astype("<u4").tobytes()))
                    start += tokens
                for at in range(0, len(out), 1024):
                    columns = list(zip(*out[at : at + 1024], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()], strict=True)],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return shards.join(parts, "part").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id: shards are picked by their range, frames by the index, nothing else is
    decompressed."""
    data = bytes(spark.read.parquet(f"{path}/dictionary").first()["data"])
    near = (F.col("last") >= doc_id) & (F.coalesce("first", F.lit(-(2**63))) <= doc_id)
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
    out = []
    for row in spark.read.schema(SHARDS).parquet(f"{path}/shards").where(near).orderBy("part", "seq").toLocalIterator():
        index, body = np.frombuffer(row["index"], dtype=INDEX), bytes(row["body"])
        for r in index[(index["doc_id"] == doc_id) & ~index["null"]]:
            frame = body[int(r["offset"]) : int(r["offset"]) + int(r["length"])]
            out.append(np.frombuffer(decompressor.decompress(frame), "<u2").tolist())
    return out
