"""Mean silhouette of a clustering."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Points whose distances to as many others a task holds at once.
BLOCK = 2_000
# Parts that the points are cut into if they are more than a block: one task compares two parts, so a point is copied once per
# part. Only parts of more than PART_POINTS points, too many for a task, call for more.
PARTS = 16
PART_POINTS = 100_000


def parts_of(points: int, block: int = BLOCK) -> int:
    return 1 if points <= block else max(PARTS, -(-points // PART_POINTS))


def euclidean_silhouette(df: DataFrame, key: str, cluster: str, vector: str, by: str | None = None,
                         block: int = BLOCK) -> DataFrame:
    """Exact mean silhouette with plain Euclidean distances: ``silhouette, n``, one row, or one per ``by`` value.

    Mean distances to a cluster have no closed form, so every pair must be measured: once, part against part, tile by tile, and only one
    sum per point and cluster leaves a task, for the points of either part. What is shuffled grows with the points, the work with
    their square: meant for districts, not orders (see :func:`squared_silhouette`). Points alone in their
    cluster count 0.
    """

    def block_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Distance sums from the points of one part to the clusters of another, and the other way round."""
        if left.empty or right.empty:
            return pd.DataFrame({"design": [], "id": [], "cluster": [], "other": [], "total": []})
        a = np.stack([np.asarray(v, dtype="float64") for v in left["x"]])
        b = np.stack([np.asarray(v, dtype="float64") for v in right["r_x"]])
        ours, theirs = (left["id"].to_numpy(), left["cluster"].to_numpy()), (right["r_id"].to_numpy(), right["r_cluster"].to_numpy())
        (our_clusters, our_place), (their_clusters, their_place) = (np.unique(c, return_inverse=True) for _, c in (ours, theirs))
        forth, back = np.zeros((len(a), len(their_clusters))), np.zeros((len(b), len(our_clusters)))
        once = left["bi"].iloc[0] == left["bj"].iloc[0]
        for i in range(0, len(a), block):
            for j in range(0, len(b), block):
                x, y = a[i: i + block], b[j: j + block]
                squared = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T
                same = ours[0][i: i + block, None] == theirs[0][None, j: j + block]
                distance = np.sqrt(np.where(same, 0.0, np.maximum(squared, 0.0)))
                forth[i: i + block] += distance @ np.eye(len(their_clusters))[their_place[j: j + block]]
                if not once:
                    back[j: j + block] += distance.T @ np.eye(len(our_clusters))[our_place[i: i + block]]

        def side(ids, clusters, present, totals) -> pd.DataFrame:
            return pd.DataFrame({"design": left["design"].iloc[0], "id": np.repeat(ids, len(present)), "cluster": np.repeat(clusters, len(present)),
                                 "other": np.tile(present, len(ids)), "total": totals.ravel()})

        forth = side(*ours, their_clusters, forth)
        return forth if once else pd.concat([forth, side(*theirs, our_clusters, back)])

    design = F.col(by) if by else F.lit(0)
    points = df.select(design.cast("long").alias("design"), F.col(key).cast("long").alias("id"),
                       F.col(cluster).cast("int").alias("cluster"), F.col(vector).cast("array<double>").alias("x"))
    largest = points.groupBy("design").count().agg(F.max("count")).first()[0] or 0
    blocks = parts_of(largest, block)
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    # every pair of parts meets once: part i with each part j from i on
    left = points.withColumn("bi", own).withColumn("bj", F.explode(F.sequence(F.col("bi"), F.lit(blocks - 1))))
    right = points.withColumn("bj", own).withColumn("bi", F.explode(F.sequence(F.lit(0), F.col("bj"))))
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    sums = left.groupBy("design", "bi", "bj").cogroup(right.groupBy("r_design", "r_bi", "r_bj")).applyInPandas(
        block_sums, "design long, id long, cluster int, other int, total double")
    sizes = points.groupBy("design", F.col("cluster").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    means = (
        sums.groupBy("design", "id", "cluster", "other").agg(F.sum("total").alias("total"))
        .join(sizes, ["design", "other"])
        .groupBy("design", "id")
        .agg(
            F.max(F.when(F.col("cluster") == F.col("other"), F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
            F.min(F.when(F.col("cluster") != F.col("other"), F.col("total") / F.col("n"))).alias("b"),
        )
    )
    width = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    result = means.groupBy("design").agg(F.avg(width).alias("silhouette"), F.count(F.lit(1)).alias("n"))
    return result.withColumnRenamed("design", by) if by else result.drop("design")


def squared_silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distances: linear in the points, but a different number."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(df)
