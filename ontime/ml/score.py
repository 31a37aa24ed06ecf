"""Scoring orders and what-if scenarios with a fitted model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ontime.ml.store import Model
from ontime.operators.features import FeatureRules, order_features
from ontime.operators.integrate import prepare_dimension
from ontime.operators.selection import exact_medians, exact_mode

AT_RISK = 0.5


def score(df: DataFrame, model: Model, threshold: float = AT_RISK) -> DataFrame:
    """Add the probability of being late and the at-risk flag; works on batch and streaming rows alike.

    The flag is taken from the probability, because ``prediction`` is 0 at exactly one half. Rows that a context join marked
    as without context (``has_context``) are returned with nulls in place of a score.
    """
    if "has_context" in df.columns:
        known = score(df.where("has_context").drop("has_context"), model, threshold).withColumn("has_context", F.lit(True))
        rest = df.where(~F.col("has_context"))
        for name in ("prediction", "late_probability", "at_risk"):
            rest = rest.withColumn(name, F.lit(None).cast(known.schema[name].dataType))
        return known.unionByName(rest)
    scored = model.transform(df)
    late = vector_to_array("probability")[1]
    return scored.select(
        *df.columns,
        F.col("prediction"),
        late.alias("late_probability"),
        (late >= F.lit(threshold)).cast("int").alias("at_risk"),
    )


def scenarios(orders: DataFrame, overrides: Mapping[str, Mapping[str, object]], features: FeatureRules | None = None,
              context: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Every order under every named set of changed columns, features derived again and district looked up.

    The number of scenario rows is orders x scenarios; the rows are made in place, without a join.
    """
    names = list(overrides)
    rows = orders.withColumn("scenario", F.explode(F.array(*[F.lit(n) for n in names])))
    changed = sorted({c for o in overrides.values() for c in o})
    for c in changed:
        value = F.col(c)
        for n in names:
            if c in overrides[n]:
                value = F.when(F.col("scenario") == n, F.lit(overrides[n][c]).cast(orders.schema[c].dataType)).otherwise(value)
        rows = rows.withColumn(c, value)
    if features is not None:
        rows = order_features(rows, features)
    if context is not None:
        rows = with_context(rows, context, key)
    return rows


def default_order(orders: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """One order to start scenarios from: the median of each number, the most frequent level of each category.

    Whole-number columns stay whole: a median between two of them is rounded half to even.
    """
    medians = exact_medians(orders, numeric)
    whole = {c for c in numeric if isinstance(orders.schema[c].dataType, IntegralType)}
    values = [F.lit(round(medians[c]) if c in whole and medians[c] is not None else medians[c]).cast(orders.schema[c].dataType).alias(c) for c in numeric]
    for c in categories:
        top = exact_mode(orders, c).first()
        values.append(F.lit(top["value"] if top else None).cast(orders.schema[c].dataType).alias(c))
    return orders.sparkSession.range(1).select(*values)


def with_context(rows: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """Look up the context of every row; a row whose key has none stays, with ``has_context`` false."""
    known = prepare_dimension(context, key, "context").withColumn("has_context", F.lit(True))
    return rows.join(known, key, "left").withColumn("has_context", F.coalesce("has_context", F.lit(False)))
