"""Fold orders to districts, segment the districts and describe the segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ontime.ml.segment import (
    STARTS, best_kmeans, choose_k, k_sweep, left_out, name_segments, principal_components, scaled_features,
)
from ontime.ml.spec import SegmentSpec
from ontime.operators.reports import homogeneity, segment_profile
from ontime.plans.etl import report_frame
from ontime.sources.sinks import write_csv, write_report
from ontime.sources.versions import VersionedFolder

# Lowest mean density first.
SEGMENT_NAMES = ("wide and thinly settled", "close and densely settled")


@dataclass
class Segmentation:
    districts: DataFrame
    profile: DataFrame
    homogeneity: DataFrame
    left_out: DataFrame
    report: dict


def segment_districts(districts: DataFrame, name: str, key: str, spec: SegmentSpec, rank_by: str, rate: str,
                      names: Sequence[str] = SEGMENT_NAMES, starts: int = STARTS, exact: bool = False) -> Segmentation:
    """``districts`` has one row per district; ``key`` is a numeric id of it. ``exact`` compares all pairs of districts."""
    missing = left_out(districts, spec.variables)
    features = scaled_features(districts, spec.variables)
    models = best_kmeans(features, spec.k_range, starts)
    table = k_sweep(features, key, models, exact)
    k = spec.k or choose_k(table)
    model = models[k]
    placed, shares = principal_components(model.transform(features).withColumnRenamed("prediction", "cluster"))
    named = name_segments(placed, "cluster", rank_by, names).drop("features")
    report = {
        "unit": name,
        "n": features.count(),
        "n_left_out": missing.count(),
        "k": k,
        "variables": list(spec.variables),
        "not_used": list(spec.descriptive),
        "comparison": table,
        "inertia": round(model.cost, 2),
        "silhouette": next(r["silhouette"] for r in table if r["k"] == k),
        "pca": {"PC1": round(shares[0], 4), "PC2": round(shares[1], 4), "total": round(sum(shares), 4)},
    }
    means = [*spec.variables, *[c for c in spec.descriptive if c != rate]]
    return Segmentation(named, segment_profile(named, "segment", name, means, rate),
                        homogeneity(features, spec.descriptive), missing.select(name), report)


def run_segmentation(districts: DataFrame, name: str, key: str, spec: SegmentSpec, rank_by: str, rate: str, root: str,
                     names: Sequence[str] = SEGMENT_NAMES, starts: int = STARTS, exact: bool = False) -> dict:
    """Segment, and publish the labelled districts (CSV) with report, profile, homogeneity and k sweep (JSON) as one version."""
    spark = districts.sparkSession
    found = segment_districts(districts, name, key, spec, rank_by, rate, names, starts, exact)
    report = {k: v for k, v in found.report.items() if k != "comparison"}

    def write(path: str) -> None:
        write_csv(found.districts, f"{path}/districts", "errorifexists")
        write_report(report_frame(found.districts, report), f"{path}/report")
        sweep = spark.createDataFrame(found.report["comparison"], "k int, inertia double, silhouette double, metric string")
        for stem, table in (("profile", found.profile), ("homogeneity", found.homogeneity), ("k_sweep", sweep), ("left_out", found.left_out)):
            write_report(table, f"{path}/{stem}")

    VersionedFolder(spark, root).publish(write)
    return found.report
