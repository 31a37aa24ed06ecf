"""Scaling and one-hot encoding as fitted Spark ML stages."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.ml.spec import FeatureSpec


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    stats = df.agg(*[F.avg(c).alias(f"{c}_m") for c in columns],
                   *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]).first()

    def scaled(c: str):
        if not stats[f"{c}_s"]:
            return F.when(F.col(c).isNotNull(), F.lit(0.0))
        return (F.col(c) - F.lit(stats[f"{c}_m"])) / F.lit(stats[f"{c}_s"])

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def preprocessing_stages(spec: FeatureSpec, n_rows: int | None = None) -> list:
    """Numbers standardized, categories one-hot; a category not seen in training gives all zeros.

    Spark scales by the sample deviation; with ``n_rows`` a constant factor turns that into the population one.
    With handleInvalid="keep" the extra slot is the last one, and dropLast drops just that slot.
    """
    stages: list = [
        VectorAssembler(inputCols=spec.numeric, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
    ]
    scaled = "_scaled"
    if n_rows and n_rows > 1:
        factor = math.sqrt(n_rows / (n_rows - 1))
        stages.append(ElementwiseProduct(scalingVec=[factor] * len(spec.numeric), inputCol="_scaled", outputCol="_scaled_pop"))
        scaled = "_scaled_pop"
    cats = spec.categories
    if cats:
        stages += [
            StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_hot" for c in cats], dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=[scaled, *[f"{c}_hot" for c in cats]], outputCol="features"))
    return stages


def preprocessor(spec: FeatureSpec, n_rows: int | None = None) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(spec, n_rows))


def feature_names(spec: FeatureSpec, transformed: DataFrame) -> list[str]:
    """Names of the slots of ``features``: the numeric columns, then ``column_value`` per category level."""
    names = list(spec.numeric)
    for c in spec.categories:
        attrs = transformed.schema[f"{c}_hot"].metadata["ml_attr"]["attrs"]["binary"]
        names += [f"{c}_{a['name']}" for a in sorted(attrs, key=lambda a: a["idx"])]
    return names
