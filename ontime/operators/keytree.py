"""Numbering rows and joining texts in key order, by a tree of counted key prefixes.

A key is cut into digits of 16 bits, first digit first, so that the prefixes of a key are the nodes of a tree whose children
follow each other in key order. Rows are counted per leaf; sums over the children of a node, of which there are at most
65,536, give every leaf the number of rows before it. No step looks at more than one node's children or one leaf's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a leaf may hold before a text key is cut further. Whole numbers need no such cut: see :func:`key_path`.
LEAF_ROWS = 1 << 16
DIGIT_BITS = 16


def whole_number(key: Column, kind: T.DataType) -> Column | None:
    """A key that is a whole number, date or time as a long of the same order; None for other kinds."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return key.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    return None


def key_path(key: Column, kind: T.DataType, depth: int) -> list[Column]:
    """Prefixes of a key, the shortest first; each orders keys as the key itself does.

    The prefixes of a whole number leave out its last 16 bits, so at most 65,536 different keys share the longest.
    Those of a text hold 2, 4, ... bytes of its UTF-8, written as hexadecimal digits.
    """
    number = whole_number(key, kind)
    if number is not None:
        return [F.shiftright(number, bits) for bits in (48, 32, 16)]
    if isinstance(kind, T.StringType):
        body = F.encode(key, "UTF-8")
        return [F.hex(F.substring(body, 1, 2 * (j + 1))) for j in range(depth)]
    raise TypeError(f"keys of type {kind.simpleString()} cannot be cut into digits")


def with_path(df: DataFrame, key: str, by: Sequence[str] = (), leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, list[str]]:
    """``df`` with the prefixes of its key as columns, deep enough that no leaf holds more than ``leaf_rows`` rows of different keys."""
    kind = df.schema[key].dataType
    depth = 2
    while True:
        columns = key_path(F.col(key), kind, depth)
        names = [f"_p{j}" for j in range(len(columns))]
        placed = df.withColumns(dict(zip(names, columns)))
        if whole_number(F.col(key), kind) is not None:
            return placed, names
        row = placed.groupBy(*by, names[-1]).agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(key)).alias("size")).agg(
            F.max("n"), F.max(F.when(F.col("n") > leaf_rows, F.col("size")))).first()
        if (row[0] or 0) <= leaf_rows or row[1] <= 2 * depth:  # the rows beyond share one key: no prefix parts them
            return placed, names
        depth *= 2


def leaf_offsets(placed: DataFrame, path: Sequence[str]) -> DataFrame:
    """One row per leaf: its path, and ``before``, the rows of all leaves before it."""
    counts = placed.groupBy(*path).agg(F.count(F.lit(1)).alias("_n"))
    offsets = None
    for j in range(len(path)):
        level = counts.groupBy(*path[: j + 1]).agg(F.sum("_n").alias("_n")) if j + 1 < len(path) else counts
        above = list(path[:j])
        siblings = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))  # at most 65,536 of them
        earlier = F.coalesce(F.sum("_n").over(siblings.orderBy(path[j]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        level = level.withColumn("_earlier", earlier).drop("_n")
        if offsets is not None:
            level = level.join(offsets, above).withColumn("_earlier", F.col("_earlier") + F.col("before")).drop("before")
        offsets = level.withColumnRenamed("_earlier", "before")
    return offsets


def number_rows(df: DataFrame, key: str, name: str = "row_no", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """1, 2, 3, ... in the order of a unique key: a whole number, date, time or text. Rows without a key get no number."""
    known, path = with_path(df.where(F.col(key).isNotNull()), key, leaf_rows=leaf_rows)
    rank = F.row_number().over(Window.partitionBy(*path).orderBy(key))
    numbered = (
        known.withColumn("_rank", rank).join(leaf_offsets(known, path), list(path))
        .withColumn(name, F.col("_rank") + F.col("before")).select(*df.columns, name)
    )
    return numbered.unionByName(df.where(F.col(key).isNull()).withColumn(name, F.lit(None).cast("long")))


def ordered_text(df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], separator: str = ",",
                 leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The values of each column, in key order, joined to one text per group; rows without a key are left out.

    Rows are joined leaf by leaf, and only the leaves' texts meet: a group of any size passes through one task as its final
    text alone, which must fit into a value. A row whose value is null is left out of that column's text.
    """
    by = list(by)
    known, path = with_path(df.where(F.col(order).isNotNull()), order, by, leaf_rows)
    held = F.struct(F.col(order).alias("_o"), *[F.col(c).cast("string").alias(f"v{n}") for n, c in enumerate(columns)])
    pieces = known.groupBy(*by, *path).agg(F.sort_array(F.collect_list(held)).alias("_rows")).select(
        *by, *path, *[F.array_join(F.col("_rows")[f"v{n}"], separator).alias(f"t{n}") for n in range(len(columns))],
        *[F.exists(F.col("_rows")[f"v{n}"], lambda v: v.isNotNull()).alias(f"h{n}") for n in range(len(columns))])
    pieces = pieces.select(*by, F.struct(*path, *[F.when(F.col(f"h{n}"), F.col(f"t{n}")).alias(f"t{n}") for n in range(len(columns))]).alias("_p"))
    whole = pieces.groupBy(*by).agg(F.sort_array(F.collect_list("_p")).alias("_parts"))
    return whole.select(*by, *[F.array_join(F.col("_parts")[f"t{n}"], separator).alias(c) for n, c in enumerate(columns)])
