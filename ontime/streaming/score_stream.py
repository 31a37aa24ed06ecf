"""Scoring orders as they are created."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ontime.ml.score import score, with_context
from ontime.ml.store import Model
from ontime.operators.features import FeatureRules, order_features


def read_orders(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(stream: DataFrame, model: Model, context: DataFrame | None = None, key: str | None = None,
                 features: FeatureRules | None = None, defaults: Mapping[str, float] | None = None) -> DataFrame:
    """Stateless: derive features, look the district up in a static table, score. The batch functions are reused.

    ``defaults`` stand in for features that are null, such as the value per item of an order without items.
    """
    if features is not None:
        stream = order_features(stream, features)
    if context is not None:
        stream = with_context(stream, context, key)
    if defaults:
        stream = stream.fillna(dict(defaults))
    return score(stream, model)


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet with exactly-once files; processes what is there and stops."""
    return (
        scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def score_batch(batch: DataFrame, batch_id: int, model: Model, context: Callable[[], DataFrame], key: str, scored_path: str, unscored_path: str,
                features: FeatureRules | None = None, defaults: Mapping[str, float] | None = None, columns: list[str] | None = None) -> None:
    """Score one batch into two tables: orders with a score, and orders whose district has no context yet.

    Each batch owns the folder ``batch=<id>`` of both tables and replaces it whole, so a batch that is played again after a failure
    leaves the same rows once. ``context`` is asked anew for every batch: a district that got its context meanwhile is known.
    """
    rows = order_features(batch, features) if features is not None else batch
    rows = with_context(rows, context(), key)
    if defaults:
        rows = rows.fillna(dict(defaults))
    known = score(rows.where("has_context").drop("has_context"), model)
    kept = known.select(*(columns or batch.columns), "late_probability", "at_risk")
    kept.write.mode("overwrite").parquet(f"{scored_path}/batch={batch_id}")
    unknown = rows.where(~F.col("has_context")).select(*batch.columns)
    unknown.write.mode("overwrite").parquet(f"{unscored_path}/batch={batch_id}")


def score_stream_to(stream: DataFrame, model: Model, context: Callable[[], DataFrame], key: str, scored_path: str, unscored_path: str,
                    checkpoint: str, features: FeatureRules | None = None, defaults: Mapping[str, float] | None = None,
                    columns: list[str] | None = None) -> StreamingQuery:
    """Run :func:`score_batch` on every batch that is there, then stop."""
    def each(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, model, context, key, scored_path, unscored_path, features, defaults, columns)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
