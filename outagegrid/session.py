"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# What the plans rely on. Everything else is left to the cluster's own defaults.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "outagegrid") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to a session somebody else started."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _own_folder() -> str:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own, which ends with the process, is used only where that setting is absent on a single machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _own_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def use_checkpoint_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "rounds"))


_kept: list[tuple[SparkSession, str]] = []


def _forget() -> None:
    """Delete what ``keep`` has written below a shared folder, as far as the session still lives."""
    for spark, path in _kept:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session is gone, and with it the way to the store
            return


def keep(df: DataFrame) -> DataFrame:
    """Store an intermediate result as columns in the shared folder, so that rounds neither repeat earlier rounds nor depend
    on executors that may be lost, and readers of a few columns read no others. It goes with the process."""
    spark = df.sparkSession
    path = scratch_path(spark, "kept")
    df.write.parquet(path)
    if spark.conf.get("spark.checkpoint.dir", None):
        if not _kept:
            atexit.register(_forget)
        _kept.append((spark, path))
    return spark.read.parquet(path)
