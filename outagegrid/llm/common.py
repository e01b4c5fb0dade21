"""What several operators share: text as bytes, words, folds, stored intermediate tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid.session import scratch_path

# Lower-cases A-Z and nothing else; applied to UTF-8 bytes, it never touches a byte of a longer character.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a missing id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def words(data: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: maximal runs of bytes other than blank and \\x09-\\x0D."""
    return data.translate(LOWER_BYTES).split()


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.stored_at = path
    return out


def spent(df: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more; what was made of it has to be stored."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df`` as they are named, dots and all."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_settings(spark: SparkSession, settings: dict[str, str], action):
    """Run ``action()`` under session settings and put the old ones back."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return action()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
