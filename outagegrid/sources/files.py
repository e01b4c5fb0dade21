"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes
from outagegrid.functions.codes import voltage_class

OUTAGE_COLUMNS = {"fips_code": "int", "state": "string", "sum": "double", "run_start_time": "string"}
STORM_COLUMNS = {
    "CZ_TYPE": "string", "EVENT_TYPE": "string", "BEGIN_DATE_TIME": "string", "END_DATE_TIME": "string",
    "STATE_FIPS": "int", "CZ_FIPS": "int", "STATE": "string",
}


def or_none(read) -> DataFrame | None:
    """The frame a reader returns, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def first_available(*readers) -> DataFrame:
    """The first source of a fallback chain that exists."""
    for read in readers:
        found = or_none(read)
        if found is not None:
            return found
    raise FileNotFoundError("none of the sources exists")


def _typed(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    """Columns by header name in fixed types. Whole numbers may be written with a decimal point."""
    return [
        (F.col(c).cast("double").cast("int") if kind == "int" else F.col(c).cast(kind)).alias(c)
        for c, kind in columns.items()
    ]


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files or folders that match, in order: one entry per year."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or ())


def _yearly(spark: SparkSession, pattern: str, columns: dict[str, str], kind: str, **options) -> DataFrame:
    """Every yearly file is read by its own header, so columns may stand in another order each year."""
    paths = _paths(spark, pattern)
    if not paths:
        return spark.read.option("header", True).csv(pattern)  # raises what a missing path raises
    frames = []
    for path in paths:
        raw = spark.read.options(header=True, **options).csv(path)
        frames.append(raw.select(*_typed(raw, columns), codes.year_of_file(F.col("_metadata.file_path"), kind).alias("year")))
    return reduce(lambda a, b: a.unionByName(b), frames)


def scan_outage_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of all yearly files; the year comes from the file name."""
    return _yearly(spark, f"{folder}/{fixed.OUTAGE_FILES}", OUTAGE_COLUMNS, "outage")


def scan_storm_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Storm events of all yearly files. Narrative fields may hold quoted line breaks."""
    return _yearly(spark, f"{folder}/{fixed.STORM_FILES}", STORM_COLUMNS, "storm", multiLine=True, escape='"')


def land_parquet(df: DataFrame, path: str, by: str = "year") -> None:
    """Write partitions of ``by``; only partitions present in ``df`` are replaced. The rebalance hint groups rows of a
    partition into well-sized files and splits one that is too large for a task."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        by
    ).parquet(path)


def scan_parquet(spark: SparkSession, path: str, columns: list[str], years: list[int] | None = None) -> DataFrame:
    """Column-projected read. Years are a partition filter; a year without data is skipped."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("year").isin(years))
    return df.select(*columns)


def discover_years(spark: SparkSession, path: str, first: int = fixed.FIRST_STORM_YEAR) -> DataFrame:
    """The years landed below ``path``, from ``first`` on, read from partition names only: no file is opened."""
    years = sorted({int(p.rsplit("year=", 1)[1]) for p in _paths(spark, f"{path}/year=*") if p.rsplit("year=", 1)[1].isdigit()})
    return spark.createDataFrame([(y,) for y in years if y >= first], "year int")


def write_table(df: DataFrame, path: str) -> None:
    """Storm pivot, thresholds and county priorities: one table each."""
    df.write.mode("overwrite").parquet(path)


def with_row_number(df: DataFrame, name: str = "ord") -> DataFrame:
    """Consecutive numbers in file order without moving the rows: each scan task numbers its own rows, and only the row
    count per task is accumulated."""
    local = F.monotonically_increasing_id()
    rows = df.withColumn("_id", local).withColumns(
        {"_task": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = df.select(F.shiftright(local, 33).alias("_task")).groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    # One row per scan task, whatever the number of rows, so the broadcast is small and the rows stay where they are.
    return rows.join(F.broadcast(starts), "_task").withColumn(name, F.col("_start") + F.col("_at")).drop(
        "_id", "_task", "_at", "_start"
    )


def read_substation_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = with_row_number(spark.read.option("header", True).csv(path))
    has = set(raw.columns)
    voltage = F.coalesce("voltage", F.lit(fixed.DEFAULT_VOLTAGE)) if "voltage" in has else F.lit(fixed.DEFAULT_VOLTAGE)
    return raw.select(
        F.concat(F.lit("sub_"), F.col("ord")).alias("node_id"), "name", voltage.alias("voltage"),
        (F.col("subtype") if "subtype" in has else F.lit("distribution")).alias("subtype"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "ord",
    )


def facility_rows(raw: DataFrame, node_type: str) -> DataFrame:
    """Numbered rows of one facility table to node rows. Rows without a place are dropped after numbering, so ids keep
    the original row numbers; all columns stay available in ``props``."""
    data = [c for c in raw.columns if c != "ord"]
    node_id = F.concat(F.lit(f"{node_type}_"), F.col("ord"))
    name = F.coalesce("name", node_id) if "name" in data else node_id
    present = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(c) for c in data]), F.array(*[F.col(c).cast("string") for c in data])),
        lambda _, v: v.isNotNull(),
    )
    return raw.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        node_id.alias("node_id"), F.lit(node_type).alias("node_type"), name.alias("name"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), present.alias("props"),
        "ord",
    )


def read_facilities(spark: SparkSession, folder: str) -> DataFrame | None:
    """All facility tables that exist, in the fixed type order; None where there is none."""
    files = {"hospital": "hospitals.csv", "fire_station": "fire_stations.csv", "school": "schools.csv"}
    out = None
    for position, (node_type, file) in enumerate(files.items()):
        raw = or_none(lambda: spark.read.option("header", True).csv(f"{folder}/{file}"))
        if raw is None:
            continue
        rows = facility_rows(with_row_number(raw), node_type)
        rows = rows.withColumn("ord", F.col("ord") + (position + 1) * (1 << 40))  # keeps types in order
        out = rows if out is None else out.unionByName(rows)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """Queue and alert exports, with a header, in the column order given."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def sample_grid(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Invented substations (20) and facilities (15 hospitals, 15 fire stations, no school) for demonstrations."""
    subs = spark.range(20).select(
        F.concat(F.lit("sub_"), "id").alias("node_id"), F.concat(F.lit("Station "), "id").alias("name"),
        F.when(F.col("id") % 3 == 0, "138").otherwise("69").alias("voltage"),
        (F.lit(40.6) + (F.col("id") % 5) * 0.06).alias("lat"), (F.lit(-73.7) + F.floor(F.col("id") / 5) * 0.2).alias("lon"),
        F.col("id").alias("ord"),
    ).withColumn("subtype", voltage_class(F.col("voltage")))
    facilities = None
    for node_type, shift in (("hospital", 0.01), ("fire_station", 0.02)):
        raw = spark.range(15).select(
            F.concat(F.lit(f"{node_type} "), "id").alias("name"), ((F.col("id") % 7) * 50).alias("beds"),
            (F.lit(40.6) + (F.col("id") % 5) * 0.06 + shift).alias("lat"),
            (F.lit(-73.7) + F.floor(F.col("id") / 4) * 0.2 + shift).alias("lon"), F.col("id").alias("ord"),
        )
        rows = facility_rows(raw, node_type)
        facilities = rows if facilities is None else facilities.unionByName(rows)
    return subs, facilities


def empty_schools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "name string, lat double, lon double, county string, enrollment int")
