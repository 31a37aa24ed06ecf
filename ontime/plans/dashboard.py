"""The tables behind a late-order dashboard, for one choice of filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ontime.operators import reports as r


@dataclass(frozen=True)
class DashboardColumns:
    label: str = "late"
    minutes: str = "delivery_min"
    hour: str = "hour"
    district: str = "district"
    row: str = "traffic"
    rows: Sequence[str] = ("Bajo", "Medio", "Alto")
    column: str = "weather"
    columns: Sequence[str] = ("Despejado", "Nublado", "Lluvia")
    bins: int = 60


def dashboard(orders: DataFrame, filters: Mapping[str, Sequence | None] | None = None,
              columns: DashboardColumns = DashboardColumns()) -> dict[str, DataFrame]:
    c = columns
    chosen = r.filter_in(orders, filters or {})
    return {
        "kpis": r.kpis(chosen, c.label, c.minutes),
        "by_hour": r.rate_by(chosen, c.hour, c.label),
        "by_district": r.rate_by(chosen, c.district, c.label, descending=True),
        "heatmap": r.pivot_rate(chosen, c.row, c.column, c.label, c.rows, c.columns),
        "minutes": r.histogram(chosen, c.minutes, c.bins),
    }


def choices(orders: DataFrame, filter_columns: Sequence[str]) -> dict[str, DataFrame]:
    return {c: r.distinct_values(orders, c) for c in filter_columns}
