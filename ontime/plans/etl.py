"""The whole batch job: clean, integrate, enrich, write the table and its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.clean import CleanRules, clean
from ontime.operators.features import FeatureRules, enrich, median_over_rows
from ontime.operators.integrate import Dimension, integrate
from ontime.session import drop_staged
from ontime.sources.sinks import write_report


def transform(orders: DataFrame, key: str, dims: Sequence[Dimension], rules: CleanRules,
              features: FeatureRules = FeatureRules()):
    """Cleaned, joined and enriched orders (lazy), the report so far, and the staged table behind them."""
    cleaned = clean(orders, rules)
    joined, integration = integrate(cleaned.df, key, dims)
    dense = next((d.df for d in dims if features.density in d.columns), None)
    middle = median_over_rows(cleaned.df, key, dense, features.density) if dense is not None else None
    return enrich(joined, features, middle), {**cleaned.report, "integration": integration}, cleaned.staged


def report_frame(df: DataFrame, report: dict) -> DataFrame:
    """The report as one row; nested parts become structs."""
    spark = df.sparkSession

    def column(value, name: str):
        if isinstance(value, dict):
            return F.struct(*[column(v, k) for k, v in value.items()]).alias(name)
        if isinstance(value, (list, tuple)):
            return F.array(*[F.lit(v) for v in value]).alias(name)
        return F.lit(value).alias(name)

    return spark.range(1).select(*[column(v, k) for k, v in report.items()])


def run_etl(orders: DataFrame, key: str, dims: Sequence[Dimension], rules: CleanRules, table_path: str,
            report_path: str, label: str = "late", features: FeatureRules = FeatureRules()) -> dict:
    """Run the job and write both outputs; the staged intermediate is deleted at the end."""
    spark = orders.sparkSession
    enriched, report, staged = transform(orders, key, dims, rules, features)
    enriched.write.mode("overwrite").parquet(table_path)
    written = spark.read.schema(enriched.schema).parquet(table_path)
    totals = written.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")).first()
    report["rows_written"] = totals["n"]
    report["columns_written"] = len(enriched.columns)
    report["late_rate"] = round(totals["rate"], 4) if totals["rate"] is not None else None
    write_report(report_frame(written, report), report_path)
    drop_staged(spark, staged)
    return report
