"""Exact deduplication on streaming state.

Fingerprints (digest, id, locator) are fed to a Structured Streaming aggregation without a watermark, so that its keyed
state never expires. The state lives in RocksDB on the executors' disks and in the shared folder, and holds per digest
the identifier that stays, where its content lies and how many rows were seen. A later run with the same ``state``
folder adds new rows to the groups it knows. Digests are not trusted: the normalised bytes of every group of two or more
rows are compared, and a group whose bytes differ is split by its full bytes.

Everything is DataFrame code. Copies of one text are combined before each shuffle (``max``, ``count``, ``min`` of equal
bytes), so a group with a third of all rows costs each task one row; the join that hands results back is a plain
equi-join, which adaptive execution may split.

Cases: a null text counts as empty; a null doc_id loses against every id, and a group of null ids only keeps its null
row; rows that repeat both id and text are one document, so they share one result row and are all counted in
``group_size``; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid.llm.common import fresh, lower_ascii, quoted, text_or_empty, with_settings
from outagegrid.session import scratch_path

NO_ID = -(2**63)
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # Else every partition of the state reserves megabytes of disk for its logs, however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def fingerprints(docs: DataFrame, digest: Callable[[Column], Column] = sha256_bytes) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(lower_ascii(text_or_empty())).alias("digest"),
        F.input_file_name().alias("locator"),
    )


def update_state(spark: SparkSession, prints: str, state: str) -> DataFrame:
    """Add all fingerprint files below ``prints`` that ``state`` has not seen, and return the state as a table:
    digest, keep_id, locator, n."""
    schema = spark.read.parquet(prints).schema

    def run():
        grouped = (
            spark.readStream.schema(schema).parquet(prints).groupBy("digest")
            .agg(
                F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"),
                F.max_by("locator", "doc_id").alias("locator"),
            )
        )
        grouped.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(
            availableNow=True
        ).start().awaitTermination()
        held = spark.read.format("statestore").load(state)
        parts = held.schema["value"].dataType.names
        return held.select(
            F.col("key.digest").alias("digest"), F.col("value")[parts[0]].alias("keep_id"),
            F.col("value")[parts[1]].alias("n"), F.col("value")[parts[2]].alias("locator"),
        )

    return with_settings(spark, STATE_SETTINGS, run)


def decide(
    docs: DataFrame, state: str | None = None, digest: Callable[[Column], Column] = sha256_bytes, prints: str | None = None
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, locator (of the row that stays) and digest for every document.

    Runs jobs while it is called: it writes fingerprints and state to the shared folder.
    """
    spark = docs.sparkSession
    prints, held = prints or scratch_path(spark, "prints"), scratch_path(spark, "state")
    fingerprints(docs, digest).write.parquet(prints)
    update_state(spark, prints, state or scratch_path(spark, "dedup")).write.parquet(held)
    groups, rows = spark.read.parquet(held), spark.read.parquet(prints).drop("locator")

    norm = lower_ascii(text_or_empty())
    bytes_seen = docs.select(digest(norm).alias("digest"), norm.alias("norm")).groupBy("digest").agg(
        F.min("norm").alias("low"), F.max("norm").alias("high")
    )
    mixed_path = scratch_path(spark, "mixed")
    bytes_seen.where(F.col("low") != F.col("high")).select("digest").write.parquet(mixed_path)
    mixed = spark.read.parquet(mixed_path)
    ids = rows.distinct()
    known = groups.select("digest", "keep_id", F.col("n").alias("group_size"), "locator")
    if mixed.isEmpty():
        return _finish(ids.join(known, "digest"))
    clean = ids.join(mixed, "digest", "left_anti").join(known, "digest")
    split = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), digest(norm).alias("digest"), norm.alias("norm"),
            F.input_file_name().alias("locator"),
        )
        .join(mixed, "digest", "left_semi")
    )
    by_bytes = split.groupBy("digest", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("locator", "doc_id").alias("locator"),
    )
    regrouped = split.select("doc_id", "digest", "norm").distinct().join(by_bytes, ["digest", "norm"]).drop("norm")
    return _finish(clean.unionByName(regrouped))


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "locator", "digest"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the row with the largest doc_id. Of rows that repeat both, one stays,
    the largest by all columns."""
    spark = docs.sparkSession
    id_, digest = fresh(docs, "_id"), fresh(docs, "_digest")
    prints = scratch_path(spark, "prints")
    key = [F.coalesce("doc_id", F.lit(NO_ID)).alias(id_), F.col("digest").alias(digest)]
    gone = decide(docs, prints=prints).where("not kept").select(*key)
    repeated = spark.read.parquet(prints).groupBy(*key).count().where(F.col("count") > 1).select(id_, digest)
    stay = docs.withColumns({
        id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), digest: sha256_bytes(lower_ascii(text_or_empty())),
    }).join(gone, [id_, digest], "left_anti")
    if repeated.isEmpty():
        return stay.select(*quoted(docs))
    twice = stay.join(repeated, [id_, digest], "left_semi").groupBy(id_, digest).agg(F.max(F.struct(*quoted(docs))).alias(id_ + "row"))
    return stay.join(repeated, [id_, digest], "left_anti").select(*quoted(docs)).unionByName(twice.select(id_ + "row.*"))
