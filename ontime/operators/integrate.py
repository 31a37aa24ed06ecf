"""Joining orders to their dimensions, with checks that nothing is lost, doubled or left without a match."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.quality import QualityError, duplicate_keys, key_coverage, missing_keys

# Keys that an error message names; the error's DataFrames hold all of them.
EXAMPLES = 20


class IncompleteJoinError(QualityError):
    """Some orders have no match in a dimension; ``missing`` has all keys without one, per dimension."""

    def __init__(self, message: str, missing: dict[str, DataFrame]):
        super().__init__(message)
        self.missing = missing


class DuplicateKeyError(QualityError):
    """A dimension key occurs more than once, so a join would multiply orders; ``duplicates`` has all of them with their counts."""

    def __init__(self, message: str, duplicates: DataFrame):
        super().__init__(message)
        self.duplicates = duplicates


@dataclass(frozen=True)
class Dimension:
    name: str
    df: DataFrame
    columns: Sequence[str]


def prepare_dimension(dim: DataFrame, key: str, name: str = "dimension") -> DataFrame:
    """Check that the key is unique. How the table is joined is left to Spark, which knows its bytes, at run time at the latest."""
    doubled = duplicate_keys(dim, [key])
    examples = [r[key] for r in doubled.orderBy(key).limit(EXAMPLES).collect()]
    if examples:
        raise DuplicateKeyError(f"{name}: key {key} is not unique, for example {examples}", doubled)
    return dim


def attach(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str] | None = None,
           name: str = "dimension") -> DataFrame:
    """Left join of a many-to-one dimension; all fact rows stay."""
    if columns is not None:
        dim = dim.select(key, *columns)
    return fact.join(prepare_dimension(dim, key, name), key, "left")


def check_coverage(fact: DataFrame, key: str, dims: Sequence[Dimension]) -> dict:
    """Rows, distinct keys and unmatched rows per dimension in one pass over the fact's key column."""
    tables = {d.name: d.df for d in dims}
    row = key_coverage(fact, key, tables).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(key).alias("keys"),
        *[F.coalesce(F.sum(F.when(F.col(f"has_{d}") == 0, F.col("n"))), F.lit(0)).alias(f"missing_{d}") for d in tables],
    ).first()
    return {
        "rows_joined": row["rows"],
        "keys_joined": row["keys"],
        "unmatched": {d: row[f"missing_{d}"] for d in tables},
    }


def integrate(fact: DataFrame, key: str, dims: Sequence[Dimension]) -> tuple[DataFrame, dict]:
    """Attach all dimensions or raise. Returns the joined rows and a report."""
    prepared = [prepare_dimension(d.df.select(key, *d.columns), key, d.name) for d in dims]
    report = check_coverage(fact, key, dims)
    if any(report["unmatched"].values()):
        missing = {d.name: missing_keys(fact, key, d.df) for d in dims if report["unmatched"][d.name]}
        named = {name: [r[key] for r in keys.limit(EXAMPLES).collect()] for name, keys in missing.items()}
        raise IncompleteJoinError(f"incomplete join: rows without a match {report['unmatched']}; missing keys, for example {named}", missing)
    joined = fact
    for dim in prepared:  # unique keys and full coverage keep the row count
        joined = joined.join(dim, key, "left")
    report["columns"] = {d.name: list(d.columns) for d in dims}
    report["rows_unmatched"] = 0
    return joined, report
