"""The cleaning, integration and feature jobs on ten known orders."""

import json
import glob

import pytest


from ontime.ml.spec import DELIVERY_SEGMENTS, DELIVERY_SPEC, FeatureSpec, LeakageError, SegmentSpec
from ontime.operators.clean import DELIVERY_RULES, CleanRules, clean, quality_report
from ontime.operators.features import enrich
from ontime.operators.integrate import Dimension, DuplicateKeyError, IncompleteJoinError, integrate
from ontime.operators.quality import QualityError, assert_domain, assert_not_null, assert_unique
from ontime.plans.dashboard import dashboard
from ontime.plans.etl import run_etl
from ontime.sources import readers
from tests.fixtures import districts, dirty_orders, weather


def dims(spark):
    reference = readers.read_with_query(districts(spark), "d", readers.district_query(
        "d", "district", "population", "area_km2", ["class", "latitude", "longitude"]))
    return [
        Dimension("districts", reference, ["population", "area_km2", "density", "class", "latitude", "longitude"]),
        Dimension("weather", weather(spark, constant=True), ["temperature_c", "humidity_pct", "wind_kmh", "precipitation_mm"]),
    ]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_clean(spark, missing):
    result = clean(dirty_orders(spark, missing), DELIVERY_RULES)
    assert result.report == {
        "rows_in": 10, "duplicates_removed": 2, "outliers_corrected": 1, "invalid_rows_removed": 2,
        "untimed_rows_removed": 0, "null_cells_before": 3, "null_cells_imputable": 3, "null_cells_left": 0, "rows_out": 6}
    rows = result.df.collect()
    only = {"weather": "Nublado", "traffic": "Medio", "vehicle": "Auto", "shop_type": "Farmacia", "distance_km": 5.5, "prep_min": 14.0}
    assert all(r[c] == v for r in rows for c, v in only.items())
    assert all(r["delivery_min"] > 0 for r in rows)
    assert not any(v is None for r in rows for v in r)
    assert result.df.distinct().count() == 1  # rows made equal by imputation stay
    assert_domain(result.df, "traffic", ["Bajo", "Medio", "Alto"])
    assert_domain(result.df, "weather", ["Despejado", "Nublado", "Lluvia"])


def test_lazy_report_equals_job_report(spark):
    assert quality_report(dirty_orders(spark), DELIVERY_RULES).first().asDict() == clean(dirty_orders(spark), DELIVERY_RULES).report


def test_column_without_values_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    result = clean(df, CleanRules(impute_median=("v",)))
    assert result.report["null_cells_left"] == 2
    assert [r["v"] for r in result.df.collect()] == [None, None]


def test_null_tokens_and_untimed_rows(spark):
    df = spark.createDataFrame([(1, " nan ", 5.0), (2, "a", None), (3, "a", 4.0)], "id int, c string, t double")
    result = clean(df, CleanRules(text=("c",), positive=("t",), impute_mode=("c",), null_tokens=("nan",)))
    assert result.report["untimed_rows_removed"] == 1
    assert {r["id"]: r["c"] for r in result.df.collect()} == {1: "A", 3: "A"}


def test_integrate_keeps_rows(spark):
    cleaned = clean(dirty_orders(spark), DELIVERY_RULES).df
    joined, report = integrate(cleaned, "district", dims(spark))
    assert joined.count() == 6
    assert report["rows_joined"] == 6 and report["unmatched"] == {"districts": 0, "weather": 0}
    assert {"density", "temperature_c"} <= set(joined.columns)


def test_integrate_names_missing_keys(spark):
    orders = spark.createDataFrame([("Providencia", 1), ("Nowhere", 2), ("Nowhere", 3)], "district string, n int")
    with pytest.raises(IncompleteJoinError, match="incomplete join.*'districts': 2.*Nowhere") as raised:
        integrate(orders, "district", dims(spark))
    assert [r["district"] for r in raised.value.missing["districts"].collect()] == ["Nowhere"]


def test_integrate_refuses_duplicate_dimension_keys(spark):
    d = dims(spark)
    doubled = Dimension("districts", d[0].df.unionAll(d[0].df), d[0].columns)
    with pytest.raises(DuplicateKeyError, match="not unique") as raised:
        integrate(spark.createDataFrame([("Macul",)], "district string"), "district", [doubled])
    assert raised.value.duplicates.count() == 14  # all of them, whatever the message names


def test_enrich(spark):
    joined, _ = integrate(clean(dirty_orders(spark), DELIVERY_RULES).df, "district", dims(spark))
    for row in enrich(joined).collect():
        assert (row["is_rush_hour"], row["is_weekend"], row["value_per_item"]) == (0, 0, 6200.0)
        assert (row["is_novice"], row["is_dense_district"]) == (1, 0)


def test_density_query(spark):
    rows = {r["district"]: r["density"] for r in dims(spark)[0].df.collect()}
    assert len(rows) == 14 and list(rows)[-1] == "Ñuñoa"
    assert rows["Santiago Centro"] == 18057.8 and rows["Providencia"] == 9866.6 and rows["Las Condes"] == 2966.2
    assert_unique(districts(spark), ["district"])
    with pytest.raises(QualityError):
        assert_unique(districts(spark).unionAll(districts(spark)), ["district"])
    with pytest.raises(QualityError):
        assert_not_null(spark.createDataFrame([(None,)], "a string"), ["a"])


def test_run_etl_writes_table_and_report(spark, tmp_path):
    report = run_etl(dirty_orders(spark), "district", dims(spark), DELIVERY_RULES, str(tmp_path / "t"), str(tmp_path / "r"))
    assert report["rows_written"] == 6 and report["late_rate"] == 1.0
    assert report["columns_written"] == 16 + 6 + 4 + 5
    stored = json.loads(open(glob.glob(str(tmp_path / "r" / "*.json"))[0]).read())
    assert stored["duplicates_removed"] == 2 and stored["integration"]["rows_unmatched"] == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_dashboard(spark):
    orders = clean(dirty_orders(spark), DELIVERY_RULES).df
    tables = dashboard(orders, {"weather": ["Nublado"], "vehicle": [], "district": None})
    assert tables["kpis"].first()["n_orders"] == 6
    heat = tables["heatmap"].collect()
    assert [r["traffic"] for r in heat] == ["Bajo", "Medio", "Alto"]
    assert heat[1]["Nublado"] == 1.0 and heat[0]["Nublado"] is None
    assert sum(r["n"] for r in tables["minutes"].collect()) == 6  # all values equal: one bin


def test_guards():
    features = DELIVERY_SPEC.features
    assert not {"delivery_min", "late", "order_id"} & set(features)
    assert len(DELIVERY_SPEC.operational) == 13 and len(DELIVERY_SPEC.external) == 5 and len(DELIVERY_SPEC.categories) == 6
    assert "class" not in DELIVERY_SPEC.without_external().features
    with pytest.raises(LeakageError):
        FeatureSpec(("delivery_min",), (), (), "late", "order_id", ("delivery_min",))
    assert not {"late", "late_rate", "delivery_min"} & set(DELIVERY_SEGMENTS.variables)
    with pytest.raises(LeakageError):
        SegmentSpec(("late_rate",), (), ("late_rate",))
    with pytest.raises(ValueError):
        SegmentSpec(("a",), (), (), k=9)


