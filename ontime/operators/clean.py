"""The cleaning job: duplicates, text, impossible values, invalid rows, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.numeric import nan_to_null, null_above
from ontime.functions.text import normalize_category, title_case
from ontime.operators.quality import copies, null_cells
from ontime.operators.selection import exact_medians, exact_mode
from ontime.session import stage


@dataclass(frozen=True)
class CleanRules:
    """Which columns each step of the job works on."""

    text: Sequence[str] = ()
    title: Sequence[str] = ()
    limits: Mapping[str, float] = field(default_factory=dict)
    positive: Sequence[str] = ()
    impute_median: Sequence[str] = ()
    impute_mode: Sequence[str] = ()
    null_tokens: Sequence[str] = ()


# The columns and limits of the delivery orders in ontime.sources.schemas.
DELIVERY_RULES = CleanRules(
    text=("weather", "traffic", "vehicle", "shop_type", "district"),
    title=("district",),
    limits={"distance_km": 40},
    positive=("delivery_min",),
    impute_median=("distance_km", "prep_min", "rating", "value"),
    impute_mode=("weather",),
)


@dataclass
class CleanResult:
    df: DataFrame
    report: dict
    staged: DataFrame


def normalize_text(df: DataFrame, text: Sequence[str], title: Sequence[str] = (),
                   null_tokens: Sequence[str] = ()) -> DataFrame:
    df = df.withColumns({c: normalize_category(F.col(c), null_tokens) for c in text})
    return df.withColumns({c: title_case(F.col(c)) for c in title}) if title else df


def valid_rows(positive: Sequence[str]) -> Column:
    """All given columns are above zero; null counts as not valid."""
    condition = F.lit(True)
    for c in positive:
        condition = condition & F.coalesce(F.col(c) > 0, F.lit(False))
    return condition


def tidy(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Distinct rows, normalized, impossible values nulled; keeps what the report needs as ``_`` columns."""
    distinct = copies(nan_to_null(df), "_copies")
    outlier = F.lit(0)
    for c, limit in rules.limits.items():
        outlier = outlier + F.coalesce(F.col(c) > F.lit(limit), F.lit(False)).cast("int")
    nonpositive, missing = F.lit(False), F.lit(False)
    for c in rules.positive:
        nonpositive = nonpositive | F.coalesce(F.col(c) <= 0, F.lit(False))
        missing = missing | F.col(c).isNull()
    marked = distinct.withColumns({
        "_outliers": outlier,
        "_invalid": nonpositive.cast("int"),
        "_untimed": (missing & ~nonpositive).cast("int"),
    })
    marked = normalize_text(marked, rules.text, rules.title, rules.null_tokens)
    if rules.limits:
        marked = marked.withColumns({c: null_above(F.col(c), limit) for c, limit in rules.limits.items()})
    return marked.withColumn("_valid", valid_rows(rules.positive))


def report_measures(columns: Sequence[str], rules: CleanRules) -> list[Column]:
    """Aggregates over :func:`tidy` output that make up the quality report."""
    imputed = [*rules.impute_median, *rules.impute_mode]
    valid = F.col("_valid")
    left = F.sum(F.when(valid, null_cells([c for c in columns if c not in imputed])).otherwise(0))
    for c in imputed:  # a column without any value has nothing to impute from
        nulls = F.count_if(valid & F.col(c).isNull())
        left = left + F.when(F.count_if(valid & F.col(c).isNotNull()) == 0, nulls).otherwise(0)

    def whole(total: Column) -> Column:
        return F.coalesce(total, F.lit(0)).cast("long")

    return [
        whole(F.sum("_copies")).alias("rows_in"),
        whole(F.sum(F.col("_copies") - 1)).alias("duplicates_removed"),
        whole(F.sum("_outliers")).alias("outliers_corrected"),
        whole(F.sum("_invalid")).alias("invalid_rows_removed"),
        whole(F.sum("_untimed")).alias("untimed_rows_removed"),
        whole(F.sum(F.when(valid, null_cells(columns)).otherwise(0))).alias("null_cells_before"),
        whole(F.sum(F.when(valid, null_cells(imputed)).otherwise(0))).alias("null_cells_imputable"),
        whole(left).alias("null_cells_left"),
        F.count_if(valid).alias("rows_out"),
    ]


def quality_report(df: DataFrame, rules: CleanRules) -> DataFrame:
    """The cleaning report alone, as one lazy row."""
    return tidy(df, rules).agg(*report_measures(df.columns, rules))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    return df.fillna(medians) if medians else df


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    modes = {}
    for c in columns:
        row = exact_mode(df, c).first()
        if row is not None:
            modes[c] = row["value"]
    return df.fillna(modes) if modes else df


def clean(df: DataFrame, rules: CleanRules) -> CleanResult:
    """Clean a table in a fixed order and report on it.

    Duplicates are removed before text is normalized and nulls are filled, so rows that become equal later
    both stay. The distinct rows are written once with their markers; the report is one aggregate over them,
    and the medians and modes read only their own columns.
    """
    staged = stage(tidy(df, rules), "clean")
    report = staged.agg(*report_measures(df.columns, rules)).first().asDict()
    kept = staged.filter("_valid").select(*df.columns)
    filled = impute_mode(impute_median(kept, rules.impute_median), rules.impute_mode)
    return CleanResult(filled, report, staged)
