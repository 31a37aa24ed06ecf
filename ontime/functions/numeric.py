"""Numeric column expressions with pandas-like null and rounding rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null mean the same in the inputs; Spark would order NaN above every number."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(a: Column, b: Column, decimals: int = 0) -> Column:
    """a / b rounded half to even; null when b is zero."""
    return F.bround(F.try_divide(a, b), decimals)


def density(count: Column, area: Column) -> Column:
    """count / area with one decimal, half away from zero; null when the area is zero."""
    return F.round(F.try_divide(count, area), 1)


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value. greatest/least skip nulls, so null is kept by hand."""
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def floor_bin(c: Column, width: int) -> Column:
    """Lower edge of the fixed-width bin that holds the value."""
    return F.floor(c / F.lit(width)) * F.lit(width)


def null_above(c: Column, limit: float) -> Column:
    """Impossible values become null; the row stays."""
    return F.when(~(c > F.lit(limit)), c)


def code_label(c: Column, labels: Mapping) -> Column:
    """Look a code up in a fixed dictionary; unknown codes give null."""
    expr = None
    for code, label in labels.items():
        expr = F.when(c == F.lit(code), F.lit(label)) if expr is None else expr.when(c == F.lit(code), F.lit(label))
    return expr


def additive_score(base: float, linear: Mapping[str, float], conditional: Sequence[tuple[Column, Column | float]]) -> Column:
    """base + sum(coefficient * column) + sum(term where its condition holds)."""
    total = F.lit(base)
    for name, weight in linear.items():
        total = total + F.col(name) * F.lit(weight)
    for condition, term in conditional:
        total = total + F.when(condition, term if isinstance(term, Column) else F.lit(term)).otherwise(F.lit(0.0))
    return total
