"""Rates, profiles, pivots, histograms and other summary tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.numeric import floor_bin
from ontime.operators.keytree import ordered_text


def filter_in(df: DataFrame, choices: Mapping[str, Sequence | None]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values; no choice for a column keeps all."""
    for column, values in choices.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def rate(df: DataFrame, label: str, name: str = "late_rate", decimals: int = 4) -> DataFrame:
    return df.agg(F.bround(F.avg(label), decimals).alias(name))


def rate_by(df: DataFrame, key: str | Column, label: str, alias: str | None = None,
            descending: bool = False, decimals: int = 4) -> DataFrame:
    """Mean of a 0/1 column per group, rows without a group left out; by group or by rate, highest first."""
    alias = alias or key
    key = F.col(key) if isinstance(key, str) else key
    grouped = (
        df.filter(key.isNotNull()).groupBy(key.alias(alias))
        .agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(label), decimals).alias("late_rate"))
    )
    return grouped.orderBy(F.desc("late_rate"), alias) if descending else grouped.orderBy(alias)


def rate_by_bin(df: DataFrame, column: str, width: int, label: str) -> DataFrame:
    return rate_by(df, floor_bin(F.col(column), width).cast("long"), label, alias="bin")


def pivot_rate(df: DataFrame, row: str, column: str, label: str, rows: Sequence[str], columns: Sequence[str],
               decimals: int = 4) -> DataFrame:
    """Mean per row and column category, in the given order; categories not listed drop out, empty cells are null."""
    cells = (
        df.filter(F.col(row).isin(list(rows)))
        .groupBy(row).pivot(column, list(columns)).agg(F.bround(F.avg(label), decimals))
    )
    frame = df.sparkSession.createDataFrame([(i, r) for i, r in enumerate(rows)], f"position int, `{row}` string")
    return frame.join(cells, row, "left").orderBy("position").select("position", row, *columns)


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; the largest falls in the last bin."""
    x = F.col(column)
    bounds = df.agg(F.struct(F.min(x).cast("double").alias("low"), F.max(x).cast("double").alias("high")).alias("b")).scalar()
    low, high = bounds["low"], bounds["high"]
    place = F.floor(F.lit(float(bins)) * F.try_divide(x - low, high - low))
    bin_no = F.least(F.coalesce(place, F.lit(0)) + 1, F.lit(bins)).cast("int")
    return (
        df.filter(x.isNotNull()).select(bin_no.alias("bin")).groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n")).orderBy("bin")
    )


def kpis(df: DataFrame, label: str, minutes: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_orders"), F.bround(F.avg(label), 4).alias("late_rate"),
                  F.bround(F.avg(minutes), 2).alias("mean_minutes"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def nunique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def district_table(df: DataFrame, key: str, label: str, means: Mapping[str, str], attributes: Sequence[str]) -> DataFrame:
    """Orders folded to districts: size, rate, means, and the district's own attributes."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg(label).alias("late_rate"),
        *[F.avg(c).alias(name) for name, c in means.items()],
        *[F.any_value(c, True).alias(c) for c in attributes],
    )


def context(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Per-district attributes taken from the orders, as a table to look scenarios up in."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.any_value(c, True).alias(c) for c in attributes])


def homogeneity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range and coefficient of variation of each column over the groups."""
    wide = df.agg(*[
        F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"),
                 F.try_divide(F.stddev_samp(c), F.avg(c)).alias("cv")).alias(c)
        for c in columns
    ])
    long = wide.unpivot([], list(columns), "variable", "s")
    return long.select("variable", F.bround("s.low", 3).alias("min"), F.bround("s.high", 3).alias("max"),
                       F.bround("s.cv", 4).alias("cv")).orderBy("variable")


def sorted_concat(df: DataFrame, key: str, column: str, alias: str = "names") -> DataFrame:
    """Distinct names of each group in order, in one text, put together piece by piece."""
    names = df.select(key, column).dropna().distinct()
    return ordered_text(names, [key], column, [column], ", ").withColumnRenamed(column, alias)


def segment_profile(districts: DataFrame, segment: str, name: str, means: Sequence[str], rate_column: str,
                    decimals: int | Mapping[str, int] = 1, rate_decimals: int = 4) -> DataFrame:
    """Per segment: districts, their names, means and the rate, rounded to ``decimals`` (of all, or by column)."""
    places = decimals if isinstance(decimals, Mapping) else dict.fromkeys(means, decimals)
    numbers = districts.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_districts"),
        *[F.bround(F.avg(c), places.get(c, 1)).alias(c) for c in means],
        F.bround(F.avg(rate_column), rate_decimals).alias(rate_column),
    )
    names = ordered_text(districts.select(segment, F.col(name).alias("districts")), [segment], "districts", ["districts"], ", ")
    return numbers.join(names.withColumnRenamed(segment, "_s"), F.col(segment).eqNullSafe(F.col("_s")), "left").drop("_s").orderBy(segment)


def transpose(df: DataFrame, id_column: str, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Turn a small metrics table on its side: one row per column, one column per record."""
    long = df.select(id_column, *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot(id_column, list(columns), "metric", "value")
    return long.groupBy("metric").pivot(id_column, list(ids)).agg(F.max("value")).orderBy("metric")


def without_columns(df: DataFrame, unwanted: Callable[[str], bool]) -> DataFrame:
    """All columns but those whose name meets a condition."""
    return df.select([c for c in df.columns if not unwanted(c)])


def lookup(df: DataFrame, key: str, value, column: str) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value)).select(column)


def head(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def top_abs(df: DataFrame, value: str, name: str, k: int = 12) -> DataFrame:
    """The k rows largest in absolute value, sign kept."""
    return df.orderBy(F.abs(F.col(value)).desc(), name).limit(k)


def arg_max(df: DataFrame, value: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(value), *ties).limit(1)
