"""Exact top-k search by inner product over a vector-approximation file.

1. Vectors become integers, floor(scale * component). Equal vectors are folded into one *class* that keeps its k + 1
   smallest ids: no answer needs more of them. Equal queries are asked once.
2. Every dimension is cut into at most 2^bits cells of about equal counts, from a histogram over all classes. The
   approximation file holds one byte or two per component, in blocks of some thousand classes; queries lie in groups.
3. Scan: a block meets each group of queries in a tile. The cells bound every score from above and below; a class whose upper
   bound lies below the k-th lower bound of a query drops out, first within the tile and then over all tiles.
4. Read: the exact vectors of the rest are read in the order of their upper bounds, in rounds that grow fourfold, until the
   k-th exact score of every query lies above the upper bound of all that it has not read.

Blocks against groups are the only product; its size is rows times queries, and the dense numpy work of a tile is bounded.
Nothing but a few numbers per dimension and cell comes to the driver.

Defined results: vectors that are null, or hold a null or non-finite component, are neither queries nor candidates. Shorter
vectors count as ending in zeros. Rows that repeat an id are rows of their own: a query leaves out only itself, and a
repeated query row is answered again. Ties go to the smaller id, null ids last. Fewer candidates than k give all of them;
an empty table gives an empty result. A score beyond 64 bits counts as the nearest bound. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import named, staged

BITS = 6
BLOCK_ROWS = 4_096
GROUP_QUERIES = 2_048
#: Queries of a group whose bounds are held at once.
SLICE = 256
#: Equal parts of a dimension's range that its cells are made of.
BINS = 1_024
#: Integers up to here are exact as doubles.
EXACT = 2.0 ** 52


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, zeros behind shorter lists."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if width and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


# --- cells -----------------------------------------------------------------------------------------


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, low, high) of a task's vectors."""
    low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            x = _dense(batch.column("x"), max(int(sizes.max()), len(low)))
            own = x.min(0), x.max(0)
            if len(low) < x.shape[1]:  # earlier vectors were shorter: they count as zeros here
                grown = np.zeros(x.shape[1] - len(low), np.int64)
                low, high = (np.concatenate([old, grown]) if len(old) else new for old, new in zip((low, high), own))
            low, high = np.minimum(low, own[0]), np.maximum(high, own[1])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high)], ["dim", "low", "high"])


def _histogram(low: np.ndarray, step: np.ndarray):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(low), BINS), np.int64)
        for batch in batches:
            at = _bins(_dense(batch.column("x"), len(low)), low, step)
            np.add.at(counts.reshape(-1), (at + np.arange(len(low)) * BINS).reshape(-1), 1)
        dim, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(dim.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[dim, place])],
                                         ["dim", "bin", "n"])

    return counted


def _bins(x: np.ndarray, low: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.minimum((x.astype(np.float64) - low) // step, BINS - 1).astype(np.int64)


class Grid:
    """Cells of every dimension: the cell of each bin, and the smallest and largest value a cell may hold."""

    def __init__(self, low: np.ndarray, high: np.ndarray, cell_of_bin: np.ndarray, cells: int):
        self.low, self.step = low.astype(np.float64), _steps(low, high)
        self.cell_of_bin = cell_of_bin
        self.floor, self.ceiling = np.full((len(low), cells), np.inf), np.full((len(low), cells), -np.inf)
        starts = self.low[:, None] + self.step[:, None] * np.arange(BINS)
        stops = starts + self.step[:, None] - 1
        stops[:, -1] = np.maximum(stops[:, -1], high)
        for d in range(len(low)):
            np.minimum.at(self.floor[d], cell_of_bin[d], starts[d])
            np.maximum.at(self.ceiling[d], cell_of_bin[d], stops[d])
        self.floor, self.ceiling = np.maximum(self.floor, low[:, None]), np.minimum(self.ceiling, high[:, None])

    def cells(self, x: np.ndarray) -> np.ndarray:
        at = _bins(x, self.low, self.step)
        return self.cell_of_bin[np.arange(len(self.low)), at]


def _steps(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Width of a bin: whole numbers, so a narrow range has one bin per value."""
    return np.maximum(np.ceil((high.astype(np.float64) - low + 1) / BINS), 1.0)


def make_grid(classes: DataFrame, width: int, bits: int) -> Grid:
    """Cells of about equal counts. The driver sees at most BINS numbers per dimension."""
    found = classes.select("x").mapInArrow(_ranges, "dim int, low long, high long").groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    low, high = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for dim, least, most in found:
        low[dim], high[dim] = least, most
    short = classes.where(F.size("x") < width).limit(1).count() > 0
    if short:  # zeros stand behind shorter vectors
        low, high = np.minimum(low, 0), np.maximum(high, 0)
    counts = np.zeros((width, BINS), np.int64)
    binned = classes.select("x").mapInArrow(_histogram(low.astype(np.float64), _steps(low, high)), "dim int, bin int, n long")
    for dim, place, n in binned.groupBy("dim", "bin").agg(F.sum("n")).collect():
        counts[dim, place] = n
    cells = 1 << bits
    before = np.cumsum(counts, 1) - counts
    cell_of_bin = np.minimum(before * cells // np.maximum(counts.sum(1), 1)[:, None], cells - 1)
    return Grid(low, high, cell_of_bin.astype(np.uint8 if bits <= 8 else np.uint16), cells)


# --- the approximation file, the groups of queries, the scan ---------------------------------------


def _blocks(grid: Grid):
    """One row per task: its classes' numbers and their cells."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, cells = [], []
        for batch in batches:
            ids.append(batch.column("class").to_numpy())
            cells.append(grid.cells(_dense(batch.column("x"), len(grid.low))))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(cells).tobytes()], pa.binary())], ["block", "classes", "cells"])

    return packed


def _groups(width: int):
    """One row per task: its queries' numbers and exact vectors."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = [], []
        for batch in batches:
            ids.append(batch.column("class").to_numpy())
            x.append(_dense(batch.column("x"), width))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(x).astype(np.int64).tobytes()], pa.binary())], ["part", "asks", "q"])

    return packed


def bounds(q: np.ndarray, cells: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Twice the largest and the smallest inner product that vectors in these cells can have with each query."""
    dims = np.arange(len(grid.low))
    floor, ceiling = grid.floor[dims, cells], grid.ceiling[dims, cells]
    middle, spread = q @ (floor + ceiling).T, np.abs(q) @ (ceiling - floor).T
    reach = np.abs(q).max(initial=0) * max(np.abs(floor).max(initial=0), np.abs(ceiling).max(initial=0)) * len(dims) * 2
    if reach >= EXACT:  # rounding may have moved the sums
        spread = spread + (np.abs(q) @ np.maximum(np.abs(floor), np.abs(ceiling)).T) * (4 * len(dims) * 2.0 ** -52)
    return middle + spread, middle - spread


def _scan(grid: Grid, k: int):
    """(ask, class, high, low) of the classes of a tile that may be among a query's ``k`` best."""
    names = ["ask", "class", "high", "low"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                classes, asks = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("classes", "asks"))
                cells = np.frombuffer(batch.column("cells")[i].as_py(), grid.cell_of_bin.dtype).reshape(len(classes), -1)
                q = np.frombuffer(batch.column("q")[i].as_py(), np.int64).reshape(len(asks), -1).astype(np.float64)
                for at in range(0, len(asks), SLICE):
                    high, low = bounds(q[at: at + SLICE], cells, grid)
                    least = np.partition(low, len(classes) - k, axis=1)[:, len(classes) - k] if len(classes) > k else np.full(len(low), -np.inf)
                    ask, place = np.nonzero(high >= least[:, None])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asks[at + ask]), pa.array(classes[place]), pa.array(high[ask, place]), pa.array(low[ask, place])], names)

    return scanned


def tiles(cells: DataFrame, groups: DataFrame, n_blocks: int, n_groups: int) -> DataFrame:
    """Every block with every group of queries.

    Catalyst takes the copies of a group for one row: without the hint it would gather them all in the driver for a broadcast.
    """
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    return cells.withColumn("part", every(n_groups)).join(groups.withColumn("block", every(n_blocks)).hint("merge"), ["block", "part"])


def candidates(classes: DataFrame, asks: DataFrame, n: int, n_asks: int, width: int, k: int, bits: int = BITS,
               block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """(ask, class, high, place): per query the classes that may be among its ``k`` best, by falling upper bound."""
    grid = make_grid(classes, width, bits)
    n_blocks, n_groups = max(1, -(-n // block_rows)), max(1, -(-n_asks // group_queries))
    cells = staged(classes.select("class", "x").repartition(n_blocks).mapInArrow(_blocks(grid), "block int, classes binary, cells binary"), "va-file")
    groups = staged(asks.select("class", "x").repartition(n_groups).mapInArrow(_groups(width), "part int, asks binary, q binary"), "va-queries")
    bounded = staged(tiles(cells, groups, n_blocks, n_groups).mapInArrow(_scan(grid, k), "ask long, class long, high double, low double"), "va-bounds")
    best = bounded.select("ask", "low", F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("low"))).alias("place")).where(F.col("place") <= k)
    least = best.groupBy("ask").agg(F.when(F.count(F.lit(1)) == k, F.min("low")).alias("least"))
    kept = bounded.drop("low").join(least, "ask").where(F.col("least").isNull() | (F.col("high") >= F.col("least")))
    order = Window.partitionBy("ask").orderBy(F.desc("high"), "class")
    return staged(kept.select("ask", "class", "high", F.row_number().over(order).alias("place")), "va-candidates")


# --- exact vectors ---------------------------------------------------------------------------------


def inner_product(a: str, b: str) -> Column:
    """Exact in 64 bits; beyond them the nearest bound."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(F.coalesce(x, F.lit(0)).alias("x"), F.coalesce(y, F.lit(0)).alias("y")))
    exact = F.aggregate(pairs, F.lit(0).cast("long"), lambda s, p: F.try_add(s, F.try_multiply(p["x"], p["y"])))
    near = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["x"].cast("double") * p["y"].cast("double"))
    return F.coalesce(exact, F.floor(near))


def best_classes(classes: DataFrame, asks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(ask, class, score): the ``k`` best classes of every query, read in rounds until no unread one can be among them."""
    spark = classes.sparkSession
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.col("first").asc_nulls_last(), "class")
    queries = asks.select(F.col("class").alias("ask"), F.col("x").alias("q"))
    vectors = classes.select("class", "x", F.col("members")[0]["id"].alias("first"))
    best = spark.createDataFrame([], "ask long, class long, first long, score long")
    done, upto = 0, 2 * k
    rest = found
    while True:
        batch = rest.where((F.col("place") > done) & (F.col("place") <= upto)).select("ask", "class")
        scored = batch.join(queries, "ask").join(vectors, "class").select("ask", "class", "first", inner_product("q", "x").alias("score"))
        ranked = best.unionByName(scored).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = staged(ranked.drop("rank"), "va-best")
        certain = best.groupBy("ask").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least"))
        unread = rest.where(F.col("place") > upto).join(certain, "ask", "left")
        rest = staged(unread.where(F.col("least").isNull() | (F.col("high") >= 2.0 * F.col("least"))).drop("least"), "va-unread")
        if rest.isEmpty():
            return best.select("ask", "class", "score")
        done, upto = upto, 4 * upto


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding", bits: int = BITS, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``is_query`` the ``k`` other rows with the largest integer inner product."""
    vector = named(vector_col).cast("array<double>")
    whole = F.transform(vector, lambda c: F.floor(c * F.lit(scale)).cast("long"))
    rows = staged(
        vectors.where(finite(vector)).select(
            F.monotonically_increasing_id().alias("row"), named(id_col).cast("long").alias("id"), whole.alias("x"),
            F.coalesce(is_query, F.lit(False)).alias("asks")), "va-rows")
    keep = k + 1  # a query may have to leave itself out
    alike = Window.partitionBy("x").orderBy(F.col("id").asc_nulls_last(), "row")
    folded = rows.select("x", "id", "row", F.row_number().over(alike).alias("place")).where(F.col("place") <= keep)
    member = F.struct("place", "id", "row")
    classes = staged(
        folded.groupBy("x").agg(F.sort_array(F.collect_list(member)).alias("members"))  # at most k + 1 of them
        .select(F.monotonically_increasing_id().alias("class"), "x", "members"), "va-classes")
    asking = rows.where("asks").select(F.col("row").alias("query"), F.col("id").alias("query_id"), "x")
    asks = staged(classes.select("class", "x").join(asking.select("x").distinct(), "x", "left_semi"), "va-asks")
    n, width = classes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    width, n_asks = max(width, 1), asks.count()
    found = candidates(classes, asks, n, n_asks, width, keep, bits, block_rows, group_queries)
    best = best_classes(classes, asks, found, keep)
    answers = (
        best.join(classes.select("class", F.explode("members").alias("m")), "class")
        .select(F.col("ask").alias("class"), "score", F.col("m.id").alias("vec_id"), F.col("m.row").alias("row"))
    )
    first = Window.partitionBy("class").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    answers = answers.withColumn("place", F.row_number().over(first)).where(F.col("place") <= keep)
    mine = asking.join(asks.select("class", "x"), "x").select("query", "query_id", "class")
    own = Window.partitionBy("query").orderBy("place")
    others = mine.join(answers, "class").where(F.col("query") != F.col("row"))
    return others.withColumn("rank", F.row_number().over(own).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
