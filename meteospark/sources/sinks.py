"""Keyed writes on Parquet tables partitioned by month, or by month and a bucket of stations.

A changed partition is rewritten as a whole through dynamic partition overwrite: Spark stages the
new files and moves them in when the job commits, so the table may be read by the same job and
a lost executor leaves the old files in place. Untouched months are neither read nor written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meteospark.functions import times
from meteospark.operators import staging
from meteospark.session import run_folder
from meteospark.sources.files import path_exists


#: The partition of a new table's file without rows, and that of rows without a time.
EMPTY, TIMELESS = "none", "__HIVE_DEFAULT_PARTITION__"


def _with_month(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn("month", times.month_of(F.col(at)))


def _with_parts(df: DataFrame, at: str, buckets: int | None) -> DataFrame:
    """The partition columns: the month and, with buckets, a hash of the station."""
    df = _with_month(df, at)
    return df if buckets is None else df.withColumn("bucket", F.pmod(F.xxhash64("station_id"), F.lit(buckets)).cast("int"))


def _by(buckets: int | None) -> list[str]:
    return ["month"] if buckets is None else ["month", "bucket"]


def _write(df: DataFrame, path: str, mode: str = "overwrite", by=("month",)) -> None:
    """Writes the partitions of the rows. A new table, and one that gets new columns, first gets a file
    without rows that has all columns (see `read_table`)."""
    _keep_columns(df, path, by)
    out = df.write.mode(mode).partitionBy(*by)
    if mode == "overwrite":
        out = out.option("partitionOverwriteMode", "dynamic")
    out.parquet(path)


def _write_empty(df: DataFrame, path: str, part=(EMPTY,), mode: str = "append") -> None:
    """A file without rows in a partition, given by its month and bucket."""
    names = [f"{c}={TIMELESS if v is None else v}" for c, v in zip(("month", "bucket"), part)]
    df.drop("month", "bucket").write.mode(mode).parquet("/".join([path, *names]))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table lies there; a folder that a failed first write has left is none."""
    if not path_exists(spark, path):
        return False
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(location)
    return any(s.isDirectory() and s.getPath().getName().startswith("month=") for s in found)


def _keep_columns(df: DataFrame, path: str, by) -> None:
    """Writes a file without rows with the table's and the update's columns, unless there is one."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name not in by]
    if table_exists(spark, path):
        known = read_table(spark, path).schema
        new = [f for f in fields if f.name not in known.names]
        if not new and path_exists(spark, f"{path}/month={EMPTY}"):
            return
        fields = [f for f in known.fields if f.name not in by] + new
    _write_empty(spark.createDataFrame([], T.StructType(fields)), path, (EMPTY, 0)[: len(by)])


def read_table(spark: SparkSession, path: str, months: list[str | None] | None = None) -> DataFrame:
    """The table with every column that any update has brought, or only these months of it.

    Its columns are those of the files without rows in one folder, so no footers of data are read for
    them, however many files there are. A table that others have written has none; then footers tell.
    """
    reader, seed = spark.read, f"{path}/month={EMPTY}"
    if path_exists(spark, seed):
        schema = spark.read.option("mergeSchema", True).option("basePath", path).parquet(seed).schema
        df = reader.schema(schema).parquet(path)
    else:
        df = reader.option("mergeSchema", True).parquet(path)
    return df if months is None else df.where(in_months(months))


def in_months(months: list[str | None]):
    """Rows of these months; None stands for rows without a time."""
    known = F.col("month").isin([m for m in months if m is not None])
    return known | F.col("month").isNull() if None in months else known


def touched_parts(df: DataFrame, by) -> list[tuple]:
    """Partitions present in an update; one row for each month and bucket."""
    return [tuple(r) for r in df.select(*by).distinct().collect()]


def in_parts(parts: list[tuple]):
    """Rows of these partitions, as a filter that the scan prunes folders by."""
    if not parts or len(parts[0]) == 1:
        return in_months([p[0] for p in parts])
    buckets: dict = {}
    for month, bucket in parts:
        buckets.setdefault(month, []).append(bucket)
    return reduce(lambda a, b: a | b, [in_months([m]) & F.col("bucket").isin(found) for m, found in buckets.items()])


def append_new(spark: SparkSession, new: DataFrame, path: str, key, order, at: str = "ts", months=None) -> None:
    """Insert or ignore: appends the first row of each key the table does not hold; a null key is a key.

    Only the months of the new rows are read; `months` names them where they are known, and then the
    update is not stored first.
    """
    new = _with_month(new, at)
    if months is None and table_exists(spark, path):
        new = _staged(new, "append")
        months = touched_months(new)
    fresh = staging.first_row(new, [*key, "month"], order)
    if table_exists(spark, path):
        held = read_table(spark, path, months).select(*key, "month")
        fresh = fresh.join(held, _same([*key, "month"], fresh, held), "left_anti")
    _write(fresh, path, "append")


def _same(key, left: DataFrame, right: DataFrame):
    """Equal keys, null and null as well."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])


def _staged(df: DataFrame, name: str) -> DataFrame:
    """An update as a table of the shared folder: its months and its rows come from one computation."""
    return materialise(df, run_folder(df.sparkSession), name)


def touched_months(df: DataFrame) -> list[str | None]:
    """Months present in an update; one short string per calendar month."""
    return [r["month"] for r in df.select("month").distinct().collect()]


def merge_rows(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """Last write wins: a row of the update sets every column the update has, to NULL as well.

    Both sides have one row a key; null keys are keys like others.
    """
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]
    o, n = old.alias("o"), new.withColumn("_given", F.lit(True)).alias("n")
    merged = o.join(n, reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]), "full")

    def pick(c):
        if c not in old.columns:
            return F.col(f"n.{c}")
        if c not in new.columns:
            return F.col(f"o.{c}")
        return F.when(F.col("n._given"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    keys = [F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in key]
    return merged.select(*keys, *[pick(c).alias(c) for c in values])


def upsert(
    spark: SparkSession, new: DataFrame, path: str, key, at: str = "ts", order=(), months=None, unique: bool = False, buckets: int | None = None, gather: bool = False
) -> None:
    """Keyed upsert; columns that the update lacks keep their value. Only its months are rewritten, and with
    `buckets` (for a table always the same number) of these only the buckets its stations lie in.

    Of rows of one key in the update the last by `order` counts, then the one with the largest values, so
    an update applied again changes nothing. Null keys are keys like others. `unique`: the update has one
    row a key. `months`: those it may have, where they are known; then it is not stored first. `gather`: a
    shuffle brings the rows of a partition together first, for updates of many months; else each task writes
    a file for each month it has rows of.
    """
    by = _by(buckets)
    new = _with_parts(new, at, buckets)
    if not unique:
        new = staging.last_row(new, [*key, *by], order)
    if table_exists(spark, path):
        if months is None or buckets is not None:
            new = _staged(new, "upsert")
            parts = touched_parts(new, by)
        else:
            parts = [(m,) for m in months]
        new = merge_rows(_parts_of(spark, path, by, parts), new, [*key, *by])
    _write(new.hint("rebalance", *by) if gather else new, path, by=by)


def _parts_of(spark: SparkSession, path: str, by, parts: list[tuple] | None = None) -> DataFrame:
    """The table, or some partitions of it; it must lie by month, or by month and bucket, as asked for."""
    df = read_table(spark, path)
    if ("bucket" in df.columns) != ("bucket" in by):
        raise ValueError(f"{path} {'has' if 'bucket' in df.columns else 'has no'} buckets")
    return df if parts is None else df.where(in_parts(parts))


def write_staged(spark: SparkSession, raw: DataFrame, path: str, ranges: dict, minimum: int | None = None) -> dict[str, int]:
    """Stages raw telemetry into a table by month and checks it on the way: one scan, one shuffle, one job.

    Rows without a station or time are counted and left out. Returns the metrics of `quality.staged_metrics`.
    """
    from meteospark.operators import quality

    counted = staging.counted_stage(raw)
    values = [c for c in counted.columns if c not in ("station_id", "ts", "_copies")]
    _keep_columns(_with_month(counted.drop("_copies"), "ts"), path, ("month",))
    rows, seen = quality.observed(counted, quality.staged_metrics(ranges, values, minimum))
    keyed = F.col("station_id").isNotNull() & F.col("ts").isNotNull()
    rows = _with_month(rows.where(keyed).drop("_copies"), "ts")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return seen.get


def replace_range(
    spark: SparkSession, new: DataFrame, path: str, begin, end, at: str = "ts", stations: list[str] | None = None, buckets: int | None = None
) -> None:
    """Deletes [begin, end], of these stations or of all, and inserts the new rows of that range.

    With `buckets` only the stations' buckets are rewritten. Partitions left without rows are emptied after
    the others are written; until then a reader sees their old rows beside the new ones of other months.
    """
    by = _by(buckets)
    inside = F.col(at).between(times.instant(begin), times.instant(end))
    if stations is not None:
        inside = inside & F.col("station_id").isin(stations)
    new = _with_parts(new.where(inside), at, buckets)
    if not table_exists(spark, path):
        _write(new, path, by=by)
        return
    where = F.col("month").between(*[times.month_of(times.instant(x)) for x in (begin, end)])
    if stations is not None and buckets is not None:
        named = spark.range(1).select(F.explode(F.array(*[F.lit(x).cast("string") for x in stations])).alias("station_id"))
        where = where & F.col("bucket").isin([r[0] for r in named.select(F.pmod(F.xxhash64("station_id"), F.lit(buckets)).cast("int")).distinct().collect()])
    old = _parts_of(spark, path, by).where(where)
    rest = old.where(~F.coalesce(inside, F.lit(False)))
    emptied = _emptied(old, rest.select(*by).unionByName(new.select(*by)), by)
    _write(rest.unionByName(new, allowMissingColumns=True), path, by=by)
    _empty_parts(old, path, emptied)


def replace_rows(spark: SparkSession, path: str, gone: DataFrame | None, new: DataFrame, key, at: str = "ts") -> None:
    """Takes rows out by key and month and puts new ones in; only months of either are rewritten.

    Months left without rows are emptied last, as in `replace_range`.
    """
    new = _staged(_with_month(new, at), "replace")
    if gone is None or not table_exists(spark, path):
        _write(new, path)
        return
    gone = _staged(gone.select(*key, "month").distinct(), "gone")
    months = list({*touched_months(gone), *touched_months(new)})
    old = read_table(spark, path, months)
    kept = old.join(gone, _same([*key, "month"], old, gone), "left_anti")
    rest = _staged(kept.unionByName(new, allowMissingColumns=True), "rest")
    _write(rest, path)
    left = touched_months(rest)
    _empty_parts(old, path, [(m,) for m in months if m not in left])


def delete_range(spark: SparkSession, path: str, begin, end, at: str = "ts", zone: str | None = None) -> None:
    """Removes rows in [begin, end]; with a zone the range is local time. No table, nothing to remove.

    Months left without rows are emptied last, as in `replace_range`.
    """
    from meteospark.operators.maintenance import keep_outside

    if not table_exists(spark, path):
        return
    lo, hi = times.instant(begin), times.instant(end)
    if zone:
        lo, hi = times.to_utc(lo, zone), times.to_utc(hi, zone)
    old = read_table(spark, path)
    # a zone moves the range by a day at most
    day = F.expr("INTERVAL '1' DAY")
    near = F.col("month").between(times.month_of(times.instant(begin) - day), times.month_of(times.instant(end) + day))
    hit = old.where(near & F.col(at).between(lo, hi))
    old = old.where(in_months(touched_months(hit)))
    rest = keep_outside(old, begin, end, at, zone)
    emptied = _emptied(old, rest.select("month"))
    _write(rest, path)
    _empty_parts(old, path, emptied)


def _emptied(before: DataFrame, after: DataFrame, by=("month",)) -> list[tuple]:
    left = set(touched_parts(after, by))
    return [p for p in touched_parts(before, by) if p not in left]


def _empty_parts(df: DataFrame, path: str, parts: list[tuple]) -> None:
    """A dynamic overwrite leaves partitions without new rows alone; these lost all of theirs.

    Each gets a file without rows in the place of its old ones: no folder is deleted, so a lost driver
    leaves a partition as it was or empty, never half.
    """
    for part in parts:
        _write_empty(df.limit(0), path, part, "overwrite")


def publish_snapshot(df: DataFrame, root: str, version: str) -> str:
    """Writes a full snapshot next to earlier ones; it counts once its job has committed."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed snapshot."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted(s.getPath().toString() for s in fs.listStatus(location) if s.isDirectory())
    done = [v for v in versions if path_exists(spark, f"{v}/_SUCCESS")]
    return spark.read.parquet(done[-1])


def write_csv_months(df: DataFrame, path: str, at: str = "ts") -> None:
    """CSV checkpoint with one folder per month."""
    _with_month(df, at).write.mode("overwrite").partitionBy("month").option("header", True).csv(path)


def write_samples(samples: DataFrame, path: str) -> None:
    """x, y and reference time of a sample in one row, so they cannot lose alignment."""
    _write(_with_month(samples, "ts_ref"), path)


def for_database(df: DataFrame) -> DataFrame:
    """NaN to NULL, timestamps to text, as the serving database stores them."""
    from meteospark.functions.cleaning import nan_to_null

    text = {
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, t in df.dtypes if t in ("timestamp", "timestamp_ntz")
    }
    return nan_to_null(df).withColumns(text) if text else nan_to_null(df)


def merge_statement(target: str, stage: str, columns, key) -> str:
    """One set-based upsert from a staging table: all columns but the key are updated."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = excluded.{c}" for c in columns if c not in key)
    return (
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage} "
        f"ON CONFLICT ({', '.join(key)}) DO UPDATE SET {updates}"
    )


def publish_jdbc(
    df: DataFrame, url: str, target: str, key, properties: dict[str, str], writers: int = 8
) -> None:
    """Executors load a staging table in parallel, then one statement merges it into the target."""
    rows = for_database(df)
    stage = f"{target}_stage"
    rows.repartition(writers).write.mode("overwrite").jdbc(url, stage, properties=properties)
    jvm = df.sparkSession.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().executeUpdate(merge_statement(target, stage, rows.columns, key))
    finally:
        connection.close()


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back.

    For tables that several later steps read: it is computed once, later scans prune columns
    and rows, and lost executors cost no recomputation.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a table of this run that no one reads any more."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
