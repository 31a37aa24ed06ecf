"""Which columns a model may learn from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace


class LeakageError(ValueError):
    """A feature would give the answer away."""


@dataclass(frozen=True)
class FeatureSpec:
    """Feature catalog of a classifier. Target, id and anything known only afterwards may not be features."""

    operational: Sequence[str]
    external: Sequence[str]
    categorical: Sequence[str]
    target: str
    id: str
    post_event: Sequence[str] = ()
    external_categorical: Sequence[str] = ()

    def __post_init__(self):
        banned = {self.target, self.id, *self.post_event}
        used = banned & {*self.numeric, *self.categories}
        if used:
            raise LeakageError(f"not known when an order is created: {sorted(used)}")

    @property
    def numeric(self) -> list[str]:
        return [*self.operational, *self.external]

    @property
    def categories(self) -> list[str]:
        return [*self.categorical, *self.external_categorical]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categories]

    def without_external(self) -> "FeatureSpec":
        return replace(self, external=(), external_categorical=())


# The features of delivery orders after ontime.plans.etl.
DELIVERY_SPEC = FeatureSpec(
    operational=("distance_km", "prep_min", "items", "value", "hour", "dow", "experience_months", "rating",
                 "active_orders", "is_rush_hour", "is_weekend", "value_per_item", "is_novice"),
    external=("density", "is_dense_district", "temperature_c", "humidity_pct", "wind_kmh"),
    categorical=("district", "weather", "traffic", "vehicle", "shop_type"),
    external_categorical=("class",),
    target="late",
    id="order_id",
    post_event=("delivery_min",),
)


@dataclass(frozen=True)
class SegmentSpec:
    """Columns that form segments, and those kept only to describe them."""

    variables: Sequence[str]
    descriptive: Sequence[str]
    label_columns: Sequence[str]
    k_range: Sequence[int] = (2, 3, 4, 5, 6)
    k: int | None = None

    def __post_init__(self):
        used = set(self.variables) & set(self.label_columns)
        if used:
            raise LeakageError(f"segments may not use the label: {sorted(used)}")
        if self.k is not None and self.k not in self.k_range:
            raise ValueError(f"k={self.k} was not among the tried {list(self.k_range)}")


DELIVERY_SEGMENTS = SegmentSpec(
    variables=("population", "area_km2", "density", "temperature_c", "humidity_pct", "wind_kmh"),
    descriptive=("n_orders", "late_rate", "mean_distance", "mean_minutes", "mean_value"),
    label_columns=("late", "late_rate", "delivery_min"),
)
