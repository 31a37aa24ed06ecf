"""Giving groups of identical rows back their copies, however many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies that one task writes for one group.
CHUNK = 100_000


def expand_copies(groups: DataFrame, count_col: str, copy_col: str = "copy_no", chunk: int = CHUNK) -> DataFrame:
    """One row per copy, numbered 1..n, from one row per distinct content with its count.

    Copies are made where their group lies. Only the chunks of groups beyond ``chunk`` copies, one small row each, are dealt out
    to all tasks first.
    """
    n = F.col(count_col)
    small = groups.where(n <= chunk).withColumn(copy_col, F.explode(F.sequence(F.lit(1).cast("long"), n)))
    chunks = groups.where(n > chunk).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(chunk)))))
    start = F.col("_chunk") * F.lit(chunk)
    large = chunks.repartition(F.xxhash64(*[F.col(c) for c in groups.columns]), F.col("_chunk")).withColumn(
        copy_col, F.explode(F.sequence(start + 1, F.least(start + F.lit(chunk), n)))).drop("_chunk")
    return small.unionByName(large)
