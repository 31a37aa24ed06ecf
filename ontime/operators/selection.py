"""Exact order statistics and samples that never sort a whole table in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.order_keys import HASH_DIGITS, hash_key
from ontime.session import stage


# --- exact medians ---------------------------------------------------------------------------------


#: Equal parts that an octave, and then a range, is cut into.
OCTAVE_PARTS = 16
RANGE_PARTS = 1 << 16


def _octave(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: sixteenths of powers of two, mirrored below zero."""
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0)) * OCTAVE_PARTS) + 1200 * OCTAVE_PARTS
    return F.when(v == 0, 0).otherwise(F.signum(v).cast("long") * size)


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Median of each column, the middle two values averaged; nulls and NaN are skipped.

    Digit by digit: values are counted by their octave, then by equal parts of the range that holds the middle, until that
    part holds one value. Every step counts on the map side and reads the staged columns once; what the driver
    sees is bounded by the number of parts, and no value moves.
    """
    columns = list(columns)
    if not columns:
        return {}
    wide = stage(df.select(*[F.col(c).cast("double").alias(f"c{n}") for n, c in enumerate(columns)]), "median-values")
    values = wide.select(F.posexplode(F.array(*wide.columns)).alias("at", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = [F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
    parts: dict[int, list] = {}
    for r in values.groupBy("at", _octave(F.col("v")).alias("part")).agg(*counted).collect():
        parts.setdefault(r["at"], []).append(r)
    found: dict[tuple[int, int], float] = {}  # column and place of the value
    open_ranges = []  # column, low, high, rows of the column before the range, places wanted inside
    wanted = {}
    for at, own in parts.items():
        total = sum(r["n"] for r in own)
        wanted[at] = sorted({(total - 1) // 2, total // 2})
        open_ranges += _narrowed(at, own, 0, wanted[at], found)
    while open_ranges:
        ranges = df.sparkSession.createDataFrame(
            [(n, at, low, high) for n, (at, low, high, _, _) in enumerate(open_ranges)], "range int, at int, least double, most double")
        width = F.col("most") - F.col("least")
        part = F.floor((F.col("v") - F.col("least")) / width * RANGE_PARTS)
        inside = values.join(F.broadcast(ranges), "at").where(F.col("v").between(F.col("least"), F.col("most")))  # at most two ranges a column
        rows = inside.groupBy("range", part.alias("part")).agg(*counted).collect()
        still = []
        for n, (at, _, _, before, places) in enumerate(open_ranges):
            still += _narrowed(at, [r for r in rows if r["range"] == n], before, places, found)
        open_ranges = still
    return {c: sum(found[n, k] for k in wanted[n]) / len(wanted[n]) if n in wanted else None for n, c in enumerate(columns)}


def _narrowed(at: int, parts: Sequence, before: int, places: Sequence[int], found: dict) -> list[tuple]:
    """The parts that hold the wanted places: those of one value are answers, the others are ranges to look into."""
    result = []
    for r in sorted(parts, key=lambda r: r["part"]):
        own = [k for k in places if before <= k < before + r["n"]]
        if own and r["low"] == r["high"]:
            found.update({(at, k): r["low"] for k in own})
        elif own:
            result.append((at, r["low"], r["high"], before, own))
        before += r["n"]
    return result


def weighted_median(df: DataFrame, column: str, alias: str = "median") -> DataFrame:
    """Lazy exact median for a column with few distinct values, such as a dimension attribute.

    Rows are first folded into one count per value, so only the distinct values reach the last task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.percentile(F.col(column), F.lit(0.5), F.col("n")).alias(alias))


def exact_mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value with its count; the smallest value wins ties."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(1)
    )


#: A table of so many rows may be held by the driver and sent to every task.
SMALL_ROWS = 10_000


def counted_small(df: DataFrame) -> DataFrame:
    """``df`` as a local table if it has at most SMALL_ROWS rows, else itself: joins with it then need no shuffle.

    Spark does not know the size of rows that come from Python, so the counted table is marked for broadcast.
    """
    rows = df.limit(SMALL_ROWS + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= SMALL_ROWS else df


# --- repeatable samples and splits -----------------------------------------------------------------


#: Rows that may share the hash digits of a cut before more digits are looked at.
EDGE_ROWS = 100_000
DIGITS = 4


def _holding(counts: DataFrame, group: Sequence[str], need: Column) -> DataFrame:
    """The buckets of each group that hold the wanted rank, with the rank inside them as ``_need``."""
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy("_b"))  # at most 16**DIGITS buckets per group
    run = counts.withColumns({"_upto": upto, "_want": need})
    hit = (F.col("_upto") - F.col("_n") < F.col("_want")) & (F.col("_want") <= F.col("_upto"))
    return run.where(hit).withColumn("_need", F.col("_want") - F.col("_upto") + F.col("_n")).drop("_upto", "_want")


def hash_cuts(df: DataFrame, key: str, seed: int, sizes: Sequence[Callable[[Column], Column]],
              by: Sequence[str] = (), edge_rows: int = EDGE_ROWS) -> DataFrame:
    """Hash keys at given ranks of the shuffled order, one row per group (columns ``cut_0``, ``cut_1``, ...).

    ``sizes`` turn a group's row count into the wanted rank. Rows are counted per leading hash digits, which spreads any
    group evenly; while a bucket that holds a wanted rank has more than ``edge_rows`` rows it is counted by more digits, and
    only then looked at closely.
    """
    by = list(by)
    rows = df.select(*by, hash_key(F.col(key), seed).alias("_s"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # at most 16**DIGITS rows per group
    counts = rows.groupBy(*by, F.substring("_s", 1, DIGITS).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(whole)
    wanted = F.array(*[F.least(size(F.col("_total")).cast("long"), F.col("_total")) for size in sizes])
    each = counts.withColumn("_total", total).select(*by, "_b", "_n", F.posexplode(wanted).alias("_j", "_k"))
    targets = counted_small(_holding(each, [*by, "_j"], F.col("_k")).select(*by, "_b", "_n", "_j", "_need"))  # one row per group and size
    digits = DIGITS
    while digits < HASH_DIGITS and (targets.agg(F.max("_n")).first()[0] or 0) > edge_rows:
        inside = rows.withColumn("_b", F.substring("_s", 1, digits)).join(targets.drop("_n"), [*by, "_b"])
        digits += DIGITS
        finer = inside.groupBy(*by, "_j", "_need", F.substring("_s", 1, digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        targets = counted_small(_holding(finer.withColumnRenamed("_need", "_k"), [*by, "_j"], F.col("_k")).select(*by, "_b", "_n", "_j", "_need"))
    edge = (
        rows.withColumn("_b", F.substring("_s", 1, digits)).join(targets.drop("_n"), [*by, "_b"])
        .groupBy(*by, "_j", "_need", "_s").agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = F.sum("_n").over(Window.partitionBy(*by, "_j").orderBy("_s"))
    hits = edge.withColumn("_upto", upto).filter(
        (F.col("_upto") - F.col("_n") < F.col("_need")) & (F.col("_need") <= F.col("_upto")))
    return hits.groupBy(*by).agg(*[F.max(F.when(F.col("_j") == j, F.col("_s"))).alias(f"cut_{j}")
                                   for j in range(len(sizes))])


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer) of a table with a unique key, the same ones on every run."""
    cut = hash_cuts(df, key, seed, [lambda total: F.lit(n)])
    return df.filter(hash_key(F.col(key), seed) <= cut.scalar())


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Whole table in a repeatable random order (a distributed range sort)."""
    return df.orderBy(hash_key(F.col(key), seed))
