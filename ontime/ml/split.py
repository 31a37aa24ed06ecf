"""Exact stratified splits and folds, repeatable and without sorting a class in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.order_keys import hash_key
from ontime.operators.selection import counted_small, hash_cuts


def _share(fraction: float):
    return lambda total: F.floor(total * F.lit(fraction) + F.lit(0.5))


def _join_cuts(df: DataFrame, cuts: DataFrame, label: str) -> DataFrame:
    return df.join(counted_small(cuts), label)


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.25, seed: int = 42,
                     name: str = "is_test") -> DataFrame:
    """Mark round(test * class size) rows of every class as test rows. Rows without a label are left out.

    All rows with one key land on the same side.
    """
    cuts = hash_cuts(df, key, seed, [_share(test)], by=[label])
    marked = _join_cuts(df, cuts, label)
    inside = F.coalesce(hash_key(F.col(key), seed) <= F.col("cut_0"), F.lit(False))
    return marked.withColumn(name, inside.cast("int")).drop("cut_0")


def _parts_passed(key: str, seed: int, cuts: int) -> Column:
    """Number of cuts a row lies beyond. A class too small for a cut has none there: its rows lie beyond it."""
    order = hash_key(F.col(key), seed)
    passed: Column = F.lit(0)
    for j in range(cuts):
        passed = passed + F.coalesce(order > F.col(f"cut_{j}"), F.lit(True)).cast("int")
    return passed.cast("int")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Give every row with a label a fold 0..folds-1; within a class, fold sizes differ by one row at most.

    Rows without a label stay, with a null fold.
    """
    def upto(j: int):
        return lambda total: F.floor(total * F.lit(j) / F.lit(folds))

    cuts = hash_cuts(df, key, seed, [upto(j) for j in range(1, folds)], by=[label])
    marked = df.join(counted_small(cuts), label, "left")
    return marked.withColumn(name, F.when(F.col(label).isNotNull(), _parts_passed(key, seed, folds - 1))) \
        .drop(*[f"cut_{j}" for j in range(folds - 1)])


def stratified_parts(df: DataFrame, label: str, key: str, test: float = 0.25, folds: int = 5,
                     seed: int = 42) -> DataFrame:
    """Test rows (``fold`` -1) and the folds of the training rows, cut from one shuffled order in one go."""
    share = _share(test)

    def upto(j: int):
        return lambda total: share(total) + F.floor((total - share(total)) * F.lit(j) / F.lit(folds))

    cuts = hash_cuts(df, key, seed, [share, *[upto(j) for j in range(1, folds)]], by=[label])
    marked = _join_cuts(df, cuts, label)
    return marked.withColumn("fold", _parts_passed(key, seed, folds) - 1) \
        .drop(*[f"cut_{j}" for j in range(folds)])
