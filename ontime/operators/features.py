"""Derived order features. Training, scoring and what-if runs all use these."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.numeric import flag, ratio
from ontime.operators.selection import weighted_median


@dataclass(frozen=True)
class FeatureRules:
    hour: str = "hour"
    rush_hours: Sequence[int] = (13, 14, 20, 21)
    dow: str = "dow"
    weekend_from: int = 6
    value: str = "value"
    items: str = "items"
    experience: str = "experience_months"
    novice_below: int = 6
    density: str = "density"


def rush_hour(c: Column, hours: Sequence[int]) -> Column:
    return flag(c.isin(list(hours)))


def late_flag(minutes: Column, promise: float = 50) -> Column:
    return flag(minutes > F.lit(promise))


def order_features(df: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Features that depend on the order alone."""
    return df.withColumns({
        "is_rush_hour": rush_hour(F.col(rules.hour), rules.rush_hours),
        "is_weekend": flag(F.col(rules.dow) >= rules.weekend_from),
        "value_per_item": ratio(F.col(rules.value), F.col(rules.items)),
        "is_novice": flag(F.col(rules.experience) < rules.novice_below),
    })


def above_median(df: DataFrame, column: str, name: str, middle: DataFrame | None = None) -> DataFrame:
    """Flag values strictly above the column's median over the rows (not over the distinct values).

    ``middle``, one row with that median, may come from a smaller table: see :func:`median_over_rows`.
    """
    middle = weighted_median(df, column) if middle is None else middle
    return df.withColumn(name, flag(F.col(column) > middle.scalar()))


def median_over_rows(fact: DataFrame, key: str, dim: DataFrame, column: str) -> DataFrame:
    """Median of a dimension's column over the rows of a fact table, from the fact's counts per key: only the key is read."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(dim.select(key, column), key).where(F.col(column).isNotNull()).agg(
        F.percentile(F.col(column), F.lit(0.5), F.col("_n")).alias("median"))


def enrich(df: DataFrame, rules: FeatureRules = FeatureRules(), middle: DataFrame | None = None) -> DataFrame:
    return above_median(order_features(df, rules), rules.density, "is_dense_district", middle)


def date_parts(ts: Column) -> dict[str, Column]:
    """Hour 0-23 and ISO weekday 1 (Monday) to 7."""
    return {"hour": F.hour(ts), "dow": (F.weekday(ts) + 1).cast("int")}
