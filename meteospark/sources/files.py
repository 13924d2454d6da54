"""Readers: station CSV, tables, reanalysis grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meteospark.catalog import CSV_COLUMNS
from meteospark.functions import cleaning, times


def read_station_csv(spark: SparkSession, path, columns: dict[str, str] = CSV_COLUMNS) -> DataFrame:
    """All monthly station files: known columns renamed, the rest dropped.

    Stations add and drop sensors, so files are grouped by their header and each header is one scan;
    a column that a file lacks is NULL. Columns are read as text; measures that are no number become
    NULL. `period` is the YYYY-MM of the file name, `file` its path.
    """
    parts = [_csv_part(spark, files, header, columns) for header, files in _files_by_header(spark, path, columns)]
    if not parts:
        raise FileNotFoundError(f"no file under {path} begins with a line of known columns")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    typed = {}
    for name in [c for c in out.columns if c not in ("period", "file")]:
        if name == "ts_label":
            typed[name] = F.col(name).try_cast("timestamp_ntz")
        elif name == "epoch_timestamp":
            typed[name] = F.col(name).try_cast("bigint")
        else:
            typed[name] = cleaning.to_number(name)
    return out.withColumns(typed)


def _files_by_header(spark: SparkSession, path, columns: dict[str, str]) -> list[tuple[str, list[str]]]:
    """Distinct header lines, those that name a known column first or second, and their files."""
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    names = F.transform(F.slice(F.split("value", ","), 1, 2), lambda c: F.trim(F.regexp_replace(c, "[\"\ufeff]", "")))
    headers = lines.where(F.arrays_overlap(names, F.array(*[F.lit(c) for c in columns])))
    rows = headers.groupBy(F.regexp_replace("value", "\r$", "").alias("header")).agg(F.collect_set("file").alias("files"))
    return sorted((r.header, sorted(r.files)) for r in rows.collect())


def _csv_part(spark: SparkSession, files: list[str], header: str, columns: dict[str, str]) -> DataFrame:
    raw = spark.read.csv(files, header=True, inferSchema=False, enforceSchema=False)
    known = {src: dst for src, dst in columns.items() if src in raw.columns}
    return raw.select(
        *[F.col(f"`{src}`").alias(dst) for src, dst in known.items()],
        F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2})[^/]*$", 1).alias("period"),
        F.input_file_name().alias("file"),
    )


def telemetry_from_csv(csv: DataFrame, station_id) -> DataFrame:
    """Adds station and UTC minute; the epoch is the source of truth."""
    station = F.lit(station_id) if isinstance(station_id, str) else station_id
    return csv.withColumn("station_id", station).withColumn(
        "ts", times.epoch_to_minute(F.col("epoch_timestamp"))
    )


def read_range(spark: SparkSession, path: str, columns, begin, end, at: str = "ts") -> DataFrame:
    """Columns of a month-partitioned table within [begin, end].

    The bounds reach the scan as pushed filters; with a `month` partition column other months
    are not opened.
    """
    df = spark.read.parquet(path)
    lo, hi = times.instant(begin), times.instant(end)
    rows = df.where(F.col(at).between(lo, hi))
    if "month" in df.columns:
        rows = rows.where(F.col("month").between(str(begin)[:7], str(end)[:7]))
    return rows.select(*columns)


def read_grid(spark: SparkSession, path: str, fallback: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Long-form grid of a period; a fallback path is used when the first does not exist."""
    chosen = path if fallback is None or path_exists(spark, path) else fallback
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).schema(GRID_SCHEMA)
    return cleaning.nan_to_null(reader.load(chosen))


GRID_SCHEMA = T.StructType(
    [T.StructField("valid_time", T.TimestampNTZType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("latitude", "longitude", "t2m", "d2m", "sp", "u10", "v10", "ssrd", "tp")
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)
