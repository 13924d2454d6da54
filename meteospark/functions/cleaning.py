"""Casts, blanks, closeness tests, labels and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meteospark import catalog


def to_number(c) -> Column:
    """Numeric cast; text that is not a number, and NaN, become NULL."""
    x = F.col(c) if isinstance(c, str) else c
    x = x.try_cast("double")
    return F.when(~F.isnan(x), x)


def blank_to_number(c) -> Column:
    """Numeric cast in which blank text is NULL."""
    x = F.col(c) if isinstance(c, str) else c
    return to_number(F.nullif(F.trim(x.cast("string")), F.lit("")))


def nan_to_null(df):
    """Turns NaN into NULL in every floating column; sources call this first."""
    fixed = {
        name: F.when(~F.isnan(name), F.col(name))
        for name, kind in df.dtypes
        if kind in ("double", "float")
    }
    return df.withColumns(fixed) if fixed else df


def close_to(a: Column, b: Column, atol: float = 1e-4, rtol: float = 1e-5) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def two_decimals(c: Column) -> Column:
    """Two decimals, halves of the exact binary value to even; '-' for NULL."""
    return F.coalesce(F.call_function("format_number", c, F.lit("0.00")), F.lit("-"))


def signed(c: Column) -> Column:
    """Two decimals with an explicit sign, '-' for NULL."""
    return F.coalesce(F.call_function("format_number", c, F.lit("+0.00;-0.00")), F.lit("-"))


def drift_label(c: Column, limit: float = 1.5) -> Column:
    return (
        F.when(c.isNull(), F.lit("-"))
        .when(F.abs(c) > limit, F.concat(F.lit("DRIFT("), signed(c), F.lit(")")))
        .otherwise(F.concat(F.lit("OK("), signed(c), F.lit(")")))
    )


def month_key(text: Column) -> Column:
    """'YYYY_MM…' or 'YYYY-MM…' text to 'YYYY-MM'."""
    return F.regexp_replace(F.substring(F.trim(text), 1, 7), "_", "-")


def parse_specs(text: Column, default=catalog.NOMINAL_SPECS) -> Column:
    """Sensor specs from JSON; NULL or malformed text gives the default map."""
    return F.coalesce(F.from_json(text, catalog.SPECS_TYPE), default_specs(default))


def default_specs(specs=catalog.NOMINAL_SPECS) -> Column:
    entries = []
    for f, (res, dead) in specs.items():
        entries += [
            F.lit(f"ecowitt_{f}"),
            F.struct(F.lit(res).alias("resolution"), F.lit(dead).alias("deadband")),
        ]
    return F.create_map(*entries)
