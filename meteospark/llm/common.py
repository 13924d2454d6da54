"""Helpers the operators share: stored tables, seeded order and ranks without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteospark.session import run_folder

#: Rows that one window of a rank holds, about, and such slices that are summed at once.
BUCKET_ROWS, _COARSE = 500, 1_024
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the table into the folder all executors share and reads it back: computed once, lineage cut."""
    path = f"{run_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the table is called so (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def seeded(*columns: Column | str | int) -> Column:
    """A uniform number in 0 .. 2^52 - 1, the same on every run."""
    parts = [F.lit(c) if isinstance(c, int) else F.col(c) if isinstance(c, str) else c for c in columns]
    return F.shiftrightunsigned(F.xxhash64(*parts), 12)


def group_key(column: str) -> Column:
    """A text without null for a group column: null is a group of its own."""
    return F.when(F.col(column).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(column).cast("string")))


def cumulated(
    df: DataFrame,
    by: Sequence[str],
    position: Column,
    order: Sequence[str],
    total_rows: int | Column,
    amount: str | None = None,
    out: str = "rank",
    group_total: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Adds `out`, the sum of `amount` (1 where None) over the rows of the same `by` up to and with this one.

    total_rows: the rows of the table, or a column with the rows of the group.
    group_total: a column for the sum over the whole group, if wanted.

    position: a number in [0, 1) that rises with the order, about evenly spread over all rows of a
    group. It cuts each group into slices; one task holds a slice, never a group. What lies in earlier
    slices comes from a table of one row per group and slice.
    """
    rows = F.lit(total_rows) if isinstance(total_rows, int) else total_rows
    slices = F.greatest(F.lit(1), F.ceil(rows / bucket_rows))
    cut = df.withColumn("_slice", F.least(F.floor(position * slices), slices - 1))
    weight = F.lit(1).cast("long") if amount is None else F.col(amount)
    keys = [*by, "_slice"]
    sums = cut.groupBy(*keys).agg(F.sum(weight).alias("_sum"))
    # earlier slices are summed in two steps, so not even the slices of one group need meet in one task
    sums = sums.withColumn("_coarse", F.floor(F.col("_slice") / _COARSE))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    near = sums.select(*keys, "_coarse", F.sum("_sum").over(upto.partitionBy(*by, "_coarse")).alias("_near"))
    upto = Window.partitionBy(*by).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_sum").over(Window.partitionBy(*by)).alias(group_total)] if group_total else []
    far = sums.groupBy(*by, "_coarse").agg(F.sum("_sum").alias("_sum"))
    far = far.select(*by, "_coarse", F.sum("_sum").over(upto).alias("_far"), *extra)
    before = (F.coalesce("_near", F.lit(0)) + F.coalesce("_far", F.lit(0))).alias("_before")
    sums = near.join(far, [*by, "_coarse"]).select(*keys, before, *([group_total] if group_total else []))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_inside", F.sum(weight).over(inside))
        .join(sums, keys)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_slice", "_inside", "_before")
    )
