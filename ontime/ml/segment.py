"""Territory segmentation with K-Means and PCA."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.ml.preprocess import zscore
from ontime.ml.silhouette import euclidean_silhouette, squared_silhouette
from ontime.session import ROWS_PER_TASK, stage

STARTS = 100
SEED = 42
#: Starting centres are drawn from at most so many rows; every step after that covers all rows.
SAMPLE_ROWS = 5_000
#: Rows whose distances to the centres of a start a task holds at once.
SLICE_ROWS = 8_192
#: Rows of a cell, cells that are packed as one row, and rows that a task cuts into cells at once.
CELL_ROWS = 32
PACKED_CELLS = 8_192
CUT_ROWS = 1_000_000


def scaled_features(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Z-scores of the variables as the vector ``features``; rows with an unknown variable are left out (see :func:`left_out`).

    The table is written once, because the statistics, every K-Means step and the profile read it again.
    """
    kept = stage(df.dropna(subset=list(variables)), "districts")
    cols = [f"{c}_z" for c in variables]
    return VectorAssembler(inputCols=cols, outputCol="features").transform(zscore(kept, variables)).drop(*cols)


def left_out(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The rows that no segment can be found for, because a variable is null or NaN."""
    unknown = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in variables]
    return df.where(reduce(lambda a, b: a | b, unknown))


@dataclass
class Clustering:
    """Centres of one K-Means fit and its cost, the sum of squared distances."""

    centres: np.ndarray
    cost: float
    steps: int

    @property
    def k(self) -> int:
        return len(self.centres)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the nearest centre; the first on ties."""
        x = vector_to_array("features")
        distances = F.array(*[F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                                          lambda total, d: total + d) for centre in self.centres])
        return df.withColumn("_d", distances).withColumn("prediction", (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d")


def starting_centres(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre is a row drawn by its squared distance to those already chosen."""
    chosen = [sample[draw.integers(len(sample))]]
    distance = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        total = distance.sum()
        at = draw.choice(len(sample), p=distance / total) if total > 0 else draw.integers(len(sample))
        chosen.append(sample[at])
        distance = np.minimum(distance, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


@dataclass
class Cells:
    """Points that lie close together, cell after cell: coordinates, points of each cell, middle and reach of its bounds, sums, and squared
    distances from its mean."""

    x: np.ndarray  # one row per dimension
    points: np.ndarray
    middle: np.ndarray
    reach: np.ndarray
    total: np.ndarray
    within: np.ndarray

    @staticmethod
    def of(x: np.ndarray, points: np.ndarray) -> "Cells":
        first = np.cumsum(points) - points
        low, high, total = (how.reduceat(x, first, axis=1).T for how in (np.minimum, np.maximum, np.add))
        apart = x - np.repeat((total / points[:, None]).T, points, axis=1)
        return Cells(x, points, (low + high) / 2, (high - low) / 2, total, np.add.reduceat((apart ** 2).sum(0), first))

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(own).tobytes() for own in (self.x, self.points, self.middle, self.reach, self.total, self.within))

    @staticmethod
    def unpacked(body: pa.Buffer, n: int, cells: int, width: int) -> "Cells":
        found, at = [], 0
        for shape, kind in (((width, n), np.float64), ((cells,), np.int64), *[((cells, width), np.float64)] * 3, ((cells,), np.float64)):
            found.append(np.frombuffer(body, kind, math.prod(shape), at).reshape(shape))
            at += 8 * math.prod(shape)
        return Cells(*found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, cells, body): the points of a task in cells, some thousand of them packed as one row."""

    def cut(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, sizes, todo = [], [], [np.arange(len(x))]
        while todo:
            own = todo.pop()
            if len(own) <= CELL_ROWS:
                order.append(own)
                sizes.append(len(own))
                continue
            points = x[own]
            along = points[:, int((points.max(0) - points.min(0)).argmax())]
            half = np.argpartition(along, len(own) // 2)
            todo += [own[half[: len(own) // 2]], own[half[len(own) // 2:]]]
        for at in range(0, len(sizes), PACKED_CELLS):
            own = np.concatenate(order[at: at + PACKED_CELLS])
            cells = Cells.of(np.ascontiguousarray(x[own].T), np.array(sizes[at: at + PACKED_CELLS], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int32()), pa.array([len(cells.points)], pa.int32()), pa.array([cells.packed()], pa.binary())],
                                             ["n", "cells", "body"])

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1))
        if sum(map(len, held)) >= CUT_ROWS:
            yield from cut(np.concatenate(held))
            held = []
    if held:
        yield from cut(np.concatenate(held))


def _cells_of(batch: pa.RecordBatch, width: int) -> Iterator[Cells]:
    """The packed cells of a batch, or its points as cells of their own."""
    if "body" in batch.schema.names:
        for n, cells, body in zip(batch.column("n").to_pylist(), batch.column("cells").to_pylist(), batch.column("body")):
            yield Cells.unpacked(body.as_buffer(), n, cells, width)
    elif batch.num_rows:
        yield Cells.of(np.ascontiguousarray(batch.column("x").flatten().to_numpy().reshape(-1, width).T), np.ones(batch.num_rows, np.int64))


def _near(middle: np.ndarray, reach: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centre nearest to the middle of each cell, and all that may be as near to one of its points.

    A cell lies within ``reach`` of its middle in every dimension. Rounding counts as nearness.
    """
    k = len(centres)
    square = (centres ** 2).sum(1)
    apart = square - 2 * (middle @ centres.T)  # less the same number for all centres
    nearest = apart.argmin(1)
    swing = (reach @ np.abs(centres[:, None, :] - centres[None]).reshape(k * k, -1).T).reshape(-1, k, k)
    cells = np.arange(len(middle))
    bound = apart[cells, nearest][:, None] - apart + 2 * swing[cells, nearest]
    margin = 1e-9 * ((middle ** 2).sum(1) + (reach ** 2).sum(1) + square.max())
    return nearest, bound >= -margin[:, None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every centre the points it is the nearest of, their squared distances and their coordinates; the first centre wins ties."""
    for c, centre in enumerate(centres):
        apart, to = x[0] - centre[0], np.empty(x.shape[1])
        apart *= apart
        for j in range(1, len(x)):
            np.subtract(x[j], centre[j], out=to)
            to *= to
            apart += to
        if c == 0:
            chosen, least = np.zeros(x.shape[1], np.int8 if len(centres) < 128 else np.int64), apart
        else:
            np.putmask(chosen, apart < least, c)
            np.minimum(least, apart, out=least)
    for c in range(len(centres)):
        which = np.flatnonzero(chosen == c)
        yield which, least.take(which), x.take(which, axis=1)


def _step(centres: list[np.ndarray]):
    """(design, cluster, n, cost, s0, s1, ...): a task's share of one step of every design.

    Points come in cells. Where one centre is the nearest of all points of a cell, which its bounds tell, the cell's
    sums are added as a whole; only the points of other cells are compared one by one.
    """
    sizes, width = [len(c) for c in centres], centres[0].shape[1]
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]

    def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, sums = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros((sum(sizes), width))
        for held in (own for batch in batches for own in _cells_of(batch, width)):
            x, points, total = held.x, held.points, held.total
            first, mean = np.cumsum(points) - points, total / points[:, None]
            for start, own in zip(starts, centres):
                k = len(own)
                nearest, near = _near(held.middle, held.reach, own)
                several = near.sum(1) > 1
                done = np.flatnonzero(~several)
                to, weight = nearest[done], points[done].astype(np.float64)
                n[start: start + k] += np.bincount(to, weights=weight, minlength=k)
                cost[start: start + k] += np.bincount(to, weights=held.within[done] + weight * ((mean[done] - own[to]) ** 2).sum(1), minlength=k)
                for j in range(width):
                    sums[start: start + k, j] += np.bincount(to, weights=total[done, j], minlength=k)
                cells = np.flatnonzero(several)
                kind = np.packbits(near[cells], axis=1)  # cells with the same centres to choose from are taken together
                order = np.lexsort(kind.T)
                cells, kind = cells[order], kind[order]
                cuts = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]).any(1)])) if len(cells) else []
                for begin, end in zip(cuts, [*cuts[1:], len(cells)]):
                    some, members = points[cells[begin:end]], np.flatnonzero(near[cells[begin]])
                    rows = np.repeat(first[cells[begin:end]] - np.cumsum(some) + some, some) + np.arange(some.sum())
                    for at in range(0, len(rows), SLICE_ROWS):
                        part = x.take(rows[at: at + SLICE_ROWS], axis=1)
                        for c, which in zip(members.tolist(), _nearest(part, own[members])):
                            n[start + c] += len(which[0])
                            cost[start + c] += which[1].sum()
                            sums[start + c] += which[2].sum(1)
        design = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        cluster = (np.arange(sum(sizes)) - starts[design]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(design), pa.array(cluster), pa.array(n), pa.array(cost), *[pa.array(np.ascontiguousarray(sums[:, j])) for j in range(width)]],
            ["design", "cluster", "n", "cost", *[f"s{j}" for j in range(width)]])

    return stepped


def best_kmeans(features: DataFrame, k_range: Sequence[int], starts: int = STARTS, seed: int = SEED, max_iter: int = 100,
                tolerance: float = 1e-6) -> dict[int, Clustering]:
    """For every k the cheapest of several K-Means starts.

    All starts of all k move together: one step is one aggregation over (design, cluster), and designs that have come to rest
    drop out, so a whole sweep takes about as many jobs as its slowest start. Points are put together in small cells first (see :func:`_step`).
    """
    points = features.select(vector_to_array("features").alias("x"))
    drawn = points.orderBy(F.xxhash64("x", F.lit(seed))).limit(SAMPLE_ROWS).collect()  # the documented sample
    if not drawn:
        raise ValueError("no rows to cluster")
    sample = np.array([r["x"] for r in drawn])
    draw = np.random.default_rng(seed)
    ks = [k for k in k_range for _ in range(starts)]
    centres = [starting_centres(sample, k, draw) for k in ks]
    width = sample.shape[1]
    # large tasks have small cells; as many as there are cores, or whole rounds of them
    n, cores = points.count(), points.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n // ROWS_PER_TASK), cores * -(-n // (cores * CUT_ROWS))))
    placed = points.coalesce(tasks) if tasks <= points.rdd.getNumPartitions() else points.repartition(tasks)
    cached = placed.mapInArrow(_cut, "n int, cells int, body binary").persist(StorageLevel.MEMORY_AND_DISK)
    schema = "design int, cluster int, n double, cost double, " + ", ".join(f"s{j} double" for j in range(width))
    sums = [F.sum(c).alias(c) for c in ("n", "cost", *[f"s{j}" for j in range(width)])]

    def stepped(live: list[int]) -> tuple[dict[int, np.ndarray], dict[int, float]]:
        """New centres and present cost of the live designs."""
        moved, cost = {d: centres[d].copy() for d in live}, dict.fromkeys(live, 0.0)
        found = cached.mapInArrow(_step([centres[d] for d in live]), schema).groupBy("design", "cluster").agg(*sums).collect()
        for r in found:  # one row per centre
            d = live[r["design"]]
            cost[d] += r["cost"]
            if r["n"]:
                moved[d][r["cluster"]] = [r[f"s{j}"] / r["n"] for j in range(width)]
        return moved, cost

    try:
        steps, costs, live = [0] * len(ks), {}, list(range(len(ks)))
        for _ in range(max_iter):
            moved, cost = stepped(live)
            shifts = {d: ((moved[d] - centres[d]) ** 2).sum() for d in live}
            for d in live:
                centres[d], costs[d], steps[d] = moved[d], cost[d], steps[d] + 1
            live = [d for d in live if shifts[d] > tolerance]
            if not live:
                break
        else:
            costs.update(stepped(live)[1])
        best: dict[int, Clustering] = {}
        for d, k in enumerate(ks):
            if k not in best or costs[d] < best[k].cost:
                best[k] = Clustering(centres[d], costs[d], steps[d])
        return best
    finally:
        cached.unpersist()


def kmeans(features: DataFrame, k: int, starts: int = STARTS, seed: int = SEED) -> Clustering:
    return best_kmeans(features, [k], starts, seed)[k]


def k_sweep(features: DataFrame, key: str, models: Mapping[int, Clustering], exact: bool = False) -> list[dict]:
    """Inertia and silhouette of each fitted k.

    ``exact`` measures Euclidean silhouettes, which need every pair of rows: for districts. Otherwise they are taken from squared
    distances, which need one pass.
    """
    if exact:
        metric = "euclidean"
        placed = [m.transform(features).select(F.lit(k).alias("k"), key, "prediction", vector_to_array("features").alias("_x"))
                  for k, m in models.items()]
        rows = euclidean_silhouette(reduce(DataFrame.unionAll, placed), key, "prediction", "_x", by="k").collect()
        width = {r["k"]: r["silhouette"] for r in rows}  # one row per k
    else:
        metric = "squared_euclidean"
        width = {k: squared_silhouette(m.transform(features)) for k, m in models.items()}
    return [{"k": k, "inertia": round(m.cost, 2), "silhouette": round(width[k], 4), "metric": metric} for k, m in models.items()]


def choose_k(table: Sequence[Mapping]) -> int:
    """The k with the largest silhouette; the smaller k on ties."""
    return max(table, key=lambda r: (r["silhouette"], -r["k"]))["k"]


def principal_components(features: DataFrame, n: int = 2) -> tuple[DataFrame, list[float]]:
    """Add PC1..PCn, signs fixed so that the largest loading of each is positive; and the variance shares."""
    model = PCA(k=n, inputCol="features", outputCol="_pc").fit(features)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(n)]
    placed = model.transform(features).withColumn("_pc", vector_to_array("_pc"))
    placed = placed.withColumns({f"PC{j + 1}": F.col("_pc")[j] * F.lit(signs[j]) for j in range(n)}).drop("_pc")
    return placed, [float(v) for v in model.explainedVariance.toArray()]


def name_segments(districts: DataFrame, cluster: str, rank_by: str, names: Sequence[str]) -> DataFrame:
    """Name clusters by their mean of one variable, lowest first, so names do not depend on cluster numbers."""
    means = districts.groupBy(cluster).agg(F.avg(rank_by).alias("_m")).orderBy("_m", cluster).collect()  # k rows
    label = F.lit(None).cast("string")
    for i, row in enumerate(means):
        text = names[i] if i < len(names) else f"segment {i + 1}"
        label = F.when(F.col(cluster) == row[cluster], F.lit(text)).otherwise(label)
    return districts.withColumn("segment", label)
