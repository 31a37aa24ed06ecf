"""Make clean tables dirty in repeatable ways, as input for the cleaning job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.text import padded
from ontime.operators.keytree import number_rows
from ontime.operators.selection import sample_rows


def every(key: str, step: int, offset: int) -> Column:
    """True for one row in ``step``: those whose key leaves ``offset``."""
    return F.pmod(F.col(key), F.lit(step)) == F.lit(offset)


def null_out(df: DataFrame, column: str, where: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, F.lit(None)).otherwise(F.col(column)))


def lower_case(df: DataFrame, column: str, where: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, F.lower(column)).otherwise(F.col(column)))


def upper_case(df: DataFrame, column: str, where: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, F.upper(column)).otherwise(F.col(column)))


def pad(df: DataFrame, column: str, where: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, padded(F.col(column))).otherwise(F.col(column)))


def implant(df: DataFrame, column: str, value: Column, where: Column) -> DataFrame:
    """Overwrite with an impossible value or an invalid marker."""
    return df.withColumn(column, F.when(where, value).otherwise(F.col(column)))


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    return df.unionByName(more)


def append_copies(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """Add exact copies of ``n`` randomly chosen rows."""
    return append_rows(df, sample_rows(df, n, key, seed))


def format_ids(df: DataFrame, key: str, name: str, pattern: str = "PED_%05d") -> DataFrame:
    """Sequential formatted id in key order."""
    return number_rows(df, key, "_no").withColumn(name, F.format_string(pattern, F.col("_no"))).drop("_no")
