"""Data-quality checks. Measures return DataFrames; ``assert_*`` raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.skew import expand_copies


class QualityError(ValueError):
    """A table breaks a rule it was declared to keep. Messages give examples; the measures give all rows."""


# --- keys and constraints --------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and whether the key is unique (1/0)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.coalesce(F.max("n"), F.lit(1)) == 1).cast("int").alias("is_unique"),
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    bad = duplicate_keys(df, keys).limit(20).collect()
    if bad:
        raise QualityError(f"key {list(keys)} is not unique, for example {[tuple(r)[:-1] for r in bad]}")


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise QualityError(f"null values: {bad}")


# --- duplicates ------------------------------------------------------------------------------------


def copies(df: DataFrame, count_col: str = "copies") -> DataFrame:
    """Distinct rows (nulls equal) with the number of times each occurs. Copies fold before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_col))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows."""
    return copies(df).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def duplicate_members(df: DataFrame) -> DataFrame:
    """Every row that has an identical twin, all copies included."""
    return expand_copies(copies(df).filter(F.col("copies") > 1), "copies").drop("copy_no", "copies")


def mark_copies(df: DataFrame) -> DataFrame:
    """All rows, each numbered within its group of identical rows; ``is_copy`` marks those after the first."""
    numbered = expand_copies(copies(df), "copies").drop("copies")
    return numbered.withColumn("is_copy", (F.col("copy_no") > 1).cast("int"))


def duplicate_key_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, with the group's size ``n``; nulls in keys are equal.

    Sizes are counted before any row moves, and a key that holds a large share of the rows is split by adaptive execution.
    """
    doubled = duplicate_keys(df, keys).select(*[F.col(k).alias(f"_r_{k}") for k in keys], "n")
    same = [df[k].eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(doubled, same).drop(*[f"_r_{k}" for k in keys])


# --- nulls, ranges, domains ------------------------------------------------------------------------


def _unpivot_counts(row: DataFrame, name: str, value: str) -> DataFrame:
    return row.unpivot([], row.columns, name, value)


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Null count per column, most first."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    result = _unpivot_counts(counted, "column", "nulls")
    if only_positive:
        result = result.filter(F.col("nulls") > 0)
    return result.orderBy(F.desc("nulls"), "column")


def null_cells(columns: Sequence[str]) -> Column:
    """Number of nulls in a row over the given columns."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def condition_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows that meet each condition; an unknown condition does not count."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def domain_violations(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed set with their row counts; nulls are not violations."""
    return (
        df.filter(~F.col(column).isin(list(allowed)))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy("value")
    )


def assert_domain(df: DataFrame, column: str, allowed: Sequence) -> None:
    bad = domain_violations(df, column, allowed).limit(20).collect()
    if bad:
        raise QualityError(f"{column} holds values outside its domain: {[r['value'] for r in bad]}")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows and non-null count."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    long = counted.unpivot(["_rows"], df.columns, "column", "non_null")
    position, kind = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, f in enumerate(df.schema.fields):
        here = F.col("column") == f.name
        position = F.when(here, F.lit(i)).otherwise(position)
        kind = F.when(here, F.lit(f.dataType.simpleString())).otherwise(kind)
    return long.select(position.alias("position"), "column", kind.alias("type"),
                       F.col("_rows").alias("n_rows"), "non_null").orderBy("position")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


# --- joins -----------------------------------------------------------------------------------------


def key_coverage(fact: DataFrame, key: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per distinct fact key: its rows and, per dimension, whether the key is known (``has_<name>``).

    The fact is folded to one count per key before it meets the dimensions, so a frequent key costs nothing.
    """
    keys = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    for name, dim in dims.items():
        known = dim.select(F.col(key).alias(f"_{name}")).distinct()
        keys = (
            keys.join(known, keys[key] == F.col(f"_{name}"), "left")
            .withColumn(f"has_{name}", F.col(f"_{name}").isNotNull().cast("int"))
            .drop(f"_{name}")
        )
    return keys


def unmatched_counts(fact: DataFrame, key: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows without a match, one row per dimension."""
    coverage = key_coverage(fact, key, dims)
    row = coverage.agg(*[
        F.coalesce(F.sum(F.when(F.col(f"has_{name}") == 0, F.col("n"))), F.lit(0)).alias(name) for name in dims])
    return _unpivot_counts(row, "dimension", "unmatched").orderBy("dimension")


def missing_keys(fact: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """Distinct fact keys the dimension does not know, in order."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti").orderBy(key)


def rowcount_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether a join kept the number of rows."""
    n_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return after.agg(F.count(F.lit(1)).alias("n_after")).select(
        n_before.alias("n_before"), "n_after", (n_before == F.col("n_after")).cast("int").alias("preserved"))
