"""Train and compare the three classifiers, then explain and keep the best."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.ml import forest as fo
from ontime.ml import train as t
from ontime.ml.evaluate import confusion_matrix, evaluate, top_features
from ontime.ml.spec import FeatureSpec
from ontime.ml.split import stratified_parts
from ontime.ml.store import Model, ModelStore
from ontime.session import sized, stage


@dataclass
class Training:
    """Training and test rows of one split, cached for the fits; ``close`` releases them."""

    parts: DataFrame  # every row with its fold, -1 for test rows
    train: DataFrame
    test: DataFrame
    n: int

    def close(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


def split_orders(orders: DataFrame, spec: FeatureSpec, test: float = 0.25, folds: int = t.FOLDS, seed: int = t.SEED) -> Training:
    """Stratified training and test rows; training rows also carry their fold.

    The cuts are found from key and label alone; then the features are written once, marked.
    """
    data = t.with_label(orders.select(spec.id, spec.target, *spec.features), spec)
    parts = stage(stratified_parts(data, "label", spec.id, test, folds, seed), "parts")
    n = parts.agg(F.count_if(F.col("fold") >= 0).alias("train"), F.count_if(F.col("fold") < 0).alias("test")).first()
    return Training(parts, sized(parts.filter("fold >= 0"), n["train"]), sized(parts.filter("fold < 0"), n["test"]), n["train"])


def ablation(split: Training, spec: FeatureSpec, make=t.logistic, full: float | None = None) -> dict:
    """F1 on the test rows with and without the external columns."""
    def f1(own: FeatureSpec) -> float:
        return round(t.f1_of_late().evaluate(t.fit(make(split.n), split.train, own, split.n).transform(split.test)), 4)

    with_external, without = f1(spec) if full is None else full, f1(spec.without_external())
    return {"f1_operational_only": without, "f1_with_external": with_external, "difference": round(with_external - without, 4)}


@dataclass
class TrainingResult:
    best: str
    linear: Model
    report: dict
    grid: t.GridRun
    scored_test: DataFrame  # label, prediction and score of the best model on the test rows

    def model(self, name: str | None = None) -> Model:
        """One of the three refit models, the best unless named; trees come out of the grown tables only when asked for."""
        name = name or self.best
        return self.linear if name == "logistic_regression" else self.grid.grown.model(self.grid.best(name).place)


def tree_scores(run: t.GridRun, point: t.GridPoint, tested: bool) -> DataFrame:
    """Label, prediction and score of the refit trees of a setting, on test or training rows."""
    rows = run.grown.scores([point.place], held_out=False).where(F.col("tested") == F.lit(tested))
    return rows.select(F.col("label").cast("double").alias("label"), "prediction", "score")


def train_and_compare(split: Training, spec: FeatureSpec, tree_grid: Mapping[str, Sequence] = t.TREE_GRID,
                      forest_grid: Mapping[str, Sequence] = t.FOREST_GRID, folds: int = t.FOLDS, seed: int = t.SEED,
                      node_rows: int = fo.NODE_ROWS) -> TrainingResult:
    """Logistic regression, and the best tree and forest of their grids, compared by F1 on the test rows."""
    run = t.grid_search(split.parts, spec, tree_grid, forest_grid, folds, seed, node_rows=node_rows)
    linear = t.fit(t.logistic(split.n), split.train, spec, split.n)
    scored = {"logistic_regression": tuple(linear.transform(part) for part in (split.train, split.test))}
    params: dict[str, dict] = {"logistic_regression": {"maxIter": 1000}}
    best_points = {name: run.best(name) for name in ("decision_tree", "random_forest")}
    for name, point in best_points.items():
        scored[name] = tree_scores(run, point, False), tree_scores(run, point, True)
        params[name] = point.params
    results = {name: {**evaluate(*both), "params": params[name]} for name, both in scored.items()}
    for name, point in best_points.items():
        results[name]["f1_cv"] = round(point.f1, 4)
    best = max(results, key=lambda m: results[m]["f1"])  # the first wins ties
    # trees keep their folds' scores from the grid: the same rows, settings and draws would give them again
    by_fold = best_points[best].f1_by_fold if best in best_points else t.cross_validate(t.logistic, split.train, spec, folds)
    mean, deviation = t.mean_and_deviation(by_fold)
    report = {
        "best_model": best,
        "results": results,
        "cross_validation": {"folds": folds, "f1_mean": round(mean, 4), "f1_std": round(deviation, 4), "f1_by_fold": [round(s, 4) for s in by_fold]},
        "external_features": ablation(split, spec, full=results["logistic_regression"]["f1"]),
    }
    return TrainingResult(best, linear, report, run, scored[best][1])


RESULT = ("model string, best int, accuracy double, precision double, recall double, f1 double, roc_auc double, accuracy_train double, "
          "gap double, overfit string, params string, f1_cv double")


def report_tables(spark: SparkSession, result: TrainingResult, model: Model, split: Training, spec: FeatureSpec) -> dict[str, DataFrame]:
    """What is kept beside the model: results, grid, cross-validation, confusion matrix, top features, value of the external columns."""
    rows = [(name, int(name == result.best), *[r[k] for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "accuracy_train", "gap", "overfit")],
             json.dumps(r["params"]), r.get("f1_cv")) for name, r in result.report["results"].items()]
    grid = [(p.model, json.dumps(p.params), round(p.f1, 4), round(p.deviation, 4)) for p in result.grid.points]
    folds = result.report["cross_validation"]
    external = result.report["external_features"]
    # a linear model's names come from its own columns
    shown = split.test if result.best != "logistic_regression" else model.transform(split.test)
    return {
        "results": spark.createDataFrame(rows, RESULT),
        "grid": spark.createDataFrame(grid, "model string, params string, f1 double, f1_std double"),
        "folds": spark.createDataFrame([*[(f"fold {n}", f) for n, f in enumerate(folds["f1_by_fold"])], ("mean", folds["f1_mean"]), ("std", folds["f1_std"])],
                                       "part string, f1 double"),
        "confusion": confusion_matrix(result.scored_test),
        "top_features": top_features(model, spec, shown),
        "external_features": spark.createDataFrame([tuple(external.values())], ", ".join(f"{k} double" for k in external)),
    }


def run_training(orders: DataFrame, spec: FeatureSpec, root: str, tree_grid: Mapping[str, Sequence] = t.TREE_GRID,
                 forest_grid: Mapping[str, Sequence] = t.FOREST_GRID, folds: int = t.FOLDS, seed: int = t.SEED,
                 node_rows: int = fo.NODE_ROWS) -> dict:
    """The whole job: split, train, compare, and publish model and tables as one version under ``root``. Returns the report."""
    split = split_orders(orders, spec, folds=folds, seed=seed)
    try:
        result = train_and_compare(split, spec, tree_grid, forest_grid, folds, seed, node_rows)
        model = result.model()
        ModelStore(orders.sparkSession, root).save(model, report_tables(orders.sparkSession, result, model, split, spec))
    finally:
        split.close()
    return result.report
