"""Ordered operators that never need one task per station.

A window partitioned by station alone puts a station's whole history into one task. Here each
history is cut into spans (a month of hours, a day of minutes, a slice of values). Windows run
inside (keys, span); what has to cross a span border travels through a table with one row per
span, which is small and is joined back on (keys, span) - the partitioning that the windows
need anyway, so the large side is shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SPAN = "_span"


def by_month(at: str = "ts") -> Column:
    return F.trunc(F.col(at), "MM")


def by_day(at: str = "ts") -> Column:
    return F.to_date(at)


def local(keys, at: str, descending: bool = False):
    order = F.col(at).desc() if descending else F.col(at).asc()
    return W.partitionBy(*keys, SPAN).orderBy(order)


def _earlier(keys):
    return W.partitionBy(*keys).orderBy(SPAN).rowsBetween(W.unboundedPreceding, -1)


def with_carry(df: DataFrame, keys, at: str, cols=(), parts: int | None = None) -> DataFrame:
    """Adds to every row what its span has to know about the spans around it.

    `_before_at`: last position of any earlier span, `_after_at`: first position of any later
    span, and for each column the nearest earlier / later non-NULL value with its position.

    The rows are dealt by keys and span, into `parts` partitions or as many as their size asks for, and
    joined where they lie: neither are they broadcast nor does the small table of spans say how many
    partitions they get.
    """
    # stated for both uses of df, or the join would state it for one and df were computed twice
    df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*keys, SPAN)]))
    df = df.repartition(*([] if parts is None else [parts]), *keys, SPAN)
    aggs = [F.max(at).alias("_last_at"), F.min(at).alias("_first_at")]
    for c in cols:
        seen = f"IF({c} IS NULL, NULL, {at})"
        aggs += [
            F.expr(f"max_by({c}, {seen}) AS _{c}_last"),
            F.expr(f"max({seen}) AS _{c}_last_at"),
            F.expr(f"min_by({c}, {seen}) AS _{c}_first"),
            F.expr(f"min({seen}) AS _{c}_first_at"),
        ]
    edges = df.groupBy(*keys, SPAN).agg(*aggs)
    by = f"PARTITION BY {', '.join(keys)} ORDER BY {SPAN}"
    back = f"({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ahead = f"({by} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = [f"last(_last_at, true) OVER {back} AS _before_at", f"last(_first_at, true) OVER {ahead} AS _after_at"]
    for c in cols:
        for at_part in ("", "_at"):
            carried += [
                f"last(_{c}_last{at_part}, true) OVER {back} AS _before_{c}{at_part}",
                f"last(_{c}_first{at_part}, true) OVER {ahead} AS _after_{c}{at_part}",
            ]
    return df.hint("merge").join(edges.selectExpr(*keys, SPAN, *carried), [*keys, SPAN])


def with_neighbours(df: DataFrame, keys, at: str, cols) -> DataFrame:
    """Adds `_prev_c`, `_prev_c_at`, `_next_c`, `_next_c_at` for each column: its nearest
    non-NULL value at or before the row, the nearest one after the row, and their positions.

    Needs the columns of `with_carry`. Both directions look backward in their own order: a frame
    that reaches forward to the end would be evaluated anew for every row.
    """
    by = f"PARTITION BY {', '.join(keys)}, {SPAN} ORDER BY {at}"
    down = f"({by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    up = f"({by} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    added = []
    for c in cols:
        seen = f"IF({c} IS NULL, NULL, {at})"
        for side, over, outer in (("prev", down, "before"), ("next", up, "after")):
            added += [
                f"coalesce(last({c}, true) OVER {over}, _{outer}_{c}) AS _{side}_{c}",
                f"coalesce(last({seen}, true) OVER {over}, _{outer}_{c}_at) AS _{side}_{c}_at",
            ]
    return df.selectExpr("*", *added)


def drop_carry(df: DataFrame) -> DataFrame:
    return df.drop(SPAN, *[c for c in df.columns if c.startswith(("_before_", "_after_"))])


def with_previous(df: DataFrame, keys, at: str, span: Column, name: str) -> DataFrame:
    """Adds the position of the preceding row of the same key (positions are distinct)."""
    df = with_carry(df.withColumn(SPAN, span), keys, at)
    previous = F.coalesce(F.lag(at).over(local(keys, at)), F.col("_before_at"))
    return drop_carry(df.withColumn(name, previous))


def running_total(df: DataFrame, keys, at: str, span: Column, amount: Column, name: str) -> DataFrame:
    """Adds the running sum of `amount` up to and including the row, in order of `at`."""
    df = df.withColumn(SPAN, span).withColumn("_amount", amount).where(F.col(SPAN).isNotNull())
    totals = df.groupBy(*keys, SPAN).agg(F.sum("_amount").alias("_total"))
    offset = F.coalesce(F.sum("_total").over(_earlier(keys)), F.lit(0))
    totals = totals.select(*keys, SPAN, offset.alias("_offset"))
    inside = F.sum("_amount").over(local(keys, at).rowsBetween(W.unboundedPreceding, 0))
    return (
        df.join(totals, [*keys, SPAN])
        .withColumn(name, F.col("_offset") + inside)
        .drop(SPAN, "_amount", "_offset")
    )


def value_slices(df: DataFrame, keys, value: str, slices: int = 256) -> DataFrame:
    """Adds `_slice`, a slice of each key's rows in value order, as a span for values.

    Slices hold about as many rows each, so an outlier doesn't put all others into one. Their bounds
    are approximate percentiles: a bounded sketch per key, and exact enough for a size.
    """
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    bounds = df.groupBy(*keys).agg(F.percentile_approx(value, shares, 20 * slices).alias("_bounds"))
    # the number of bounds up to the value, by halving: a comparison for each power of two
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(slices.bit_length()))])
    reached = lambda at, step: F.get("_bounds", at + step - 1) <= F.col(value)
    slot = F.aggregate(halves, F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at))
    return df.join(bounds, list(keys)).withColumn("_slice", slot).drop("_bounds")


def exact_percentile(df: DataFrame, keys, value: str, p: float, name: str) -> DataFrame:
    """Linear-interpolated percentile per key without holding a key's values in one task.

    Values are counted first, the counts are summed along the value axis in slices, and the
    two ranks around the percentile are picked by a plain aggregate.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = running_total(
        value_slices(counts, keys, value), keys, value, F.col("_slice"), F.col("_n"), "_upto"
    )
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    place = F.lit(float(p)) * (F.col("_total") - 1)
    low = F.min(F.when(F.col("_upto") > F.floor("_place"), F.col(value)))
    high = F.min(F.when(F.col("_upto") > F.ceil("_place"), F.col(value)))
    share = F.first("_place") - F.floor(F.first("_place"))
    return (
        ranked.join(total.withColumn("_place", place), list(keys))
        .groupBy(*keys)
        .agg((low + (high - low) * share).alias(name))
    )
