"""The three late-order classifiers, their grids and cross-validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.ml import forest as fo
from ontime.ml.evaluate import confusion_counts
from ontime.ml.preprocess import preprocessing_stages
from ontime.ml.spec import FeatureSpec

SEED = 42
FOLDS = 5
#: Deeper than any tree on rows that can be told apart by their features; the same as the deepest that Spark builds.
UNLIMITED_DEPTH = 30

# The grids of the tree and the forest.
TREE_GRID = {"maxDepth": [4, 8, 12, UNLIMITED_DEPTH], "minInstancesPerNode": [1, 20, 50]}
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [10, 14, UNLIMITED_DEPTH]}


def f1_of_late() -> MulticlassClassificationEvaluator:
    """F1 of class 1. The evaluator's plain "f1" is weighted over both classes, a different number."""
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)


def logistic(n_rows: int, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2-regularized; regParam 1/(c*n) on unscaled weights matches a penalty of 1/c on the summed loss."""
    return LogisticRegression(labelCol="label", featuresCol="features", regParam=1.0 / (c * max(n_rows, 1)),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter)


def with_label(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return df.withColumn("label", F.col(spec.target).cast("double"))


def fit(classifier, train: DataFrame, spec: FeatureSpec, n_rows: int | None = None) -> PipelineModel:
    """Preprocessing and classifier as one fitted object, with fresh stages each time."""
    return Pipeline(stages=[*preprocessing_stages(spec, n_rows), classifier]).fit(train)


@dataclass
class GridPoint:
    model: str
    params: dict
    f1_by_fold: list[float]
    place: int  # among the settings of the grown trees

    @property
    def f1(self) -> float:
        return mean_and_deviation(self.f1_by_fold)[0]

    @property
    def deviation(self) -> float:
        return mean_and_deviation(self.f1_by_fold)[1]


@dataclass
class GridRun:
    """Every setting of the grids with its F1 on each fold, and the trees behind them."""

    grown: fo.Grown
    points: list[GridPoint]

    def best(self, model: str) -> GridPoint:
        """The setting with the best mean F1; the first of the grid on ties."""
        return max((p for p in self.points if p.model == model), key=lambda p: p.f1)


def grid_search(parts: DataFrame, spec: FeatureSpec, tree_grid: Mapping[str, Sequence] | None = None,
                forest_grid: Mapping[str, Sequence] | None = None, folds: int = FOLDS, seed: int = SEED,
                bins: int = fo.BINS, node_rows: int = fo.NODE_ROWS) -> GridRun:
    """Try every point of the grids on every fold; ``parts`` holds ``label`` and ``fold``, test rows with a fold below zero.

    Folds, settings and the refit on all training rows are grown in one go: see :mod:`ontime.ml.forest`.
    """
    families = [*(fo.tree_families(tree_grid) if tree_grid else []), *([fo.forest_family(forest_grid)] if forest_grid else [])]
    encoding = fo.Encoding.fit(parts.where("fold >= 0"), spec, bins)
    rows = fo.encode(parts, encoding, spec.id, "label", "fold")
    grown = fo.Grower(rows, encoding, families, folds, seed, node_rows).run()
    counts = confusion_counts(grown.scores(held_out=True), "label", "prediction", ["which", "point"])
    f1 = {(r["which"], r["point"]): 2 * r["tp"] / max(2 * r["tp"] + r["fp"] + r["fn"], 1) for r in counts.collect()}  # folds x settings
    points = [GridPoint("random_forest" if families[p.family].bagged else "decision_tree", p.params,
                        [f1.get((fold, n), 0.0) for fold in range(folds)], n) for n, p in enumerate(grown.points)]
    return GridRun(grown, sorted(points, key=lambda p: (p.model, *p.params.values())))


def cross_validate(make, train: DataFrame, spec: FeatureSpec, folds: int = FOLDS, fold_col: str = "fold", parallelism: int = 5) -> list[float]:
    """F1 of class 1 on each fold, preprocessing and classifier fitted on the others. ``make(n_rows)`` gives a fresh classifier."""
    sizes = {r[fold_col]: r["count"] for r in train.groupBy(fold_col).count().collect()}  # one row per fold
    total = sum(sizes.values())

    def run(i: int) -> float:
        n = total - sizes.get(i, 0)
        model = fit(make(n), train.filter(F.col(fold_col) != i), spec, n)
        return f1_of_late().evaluate(model.transform(train.filter(F.col(fold_col) == i)))

    with ThreadPool(min(parallelism, folds)) as pool:
        return pool.map(run, range(folds), chunksize=1)


def mean_and_deviation(scores: Sequence[float]) -> tuple[float, float]:
    mean = sum(scores) / len(scores)
    return mean, (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
