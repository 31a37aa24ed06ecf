"""Cleaning, integration, features and the whole job."""

from pyspark.sql import functions as F

from ontime.catalog import inputs as i
from ontime.catalog.q_quality import RULES
from ontime.catalog.registry import query
from ontime.functions import numeric
from ontime.functions.text import title_case
from ontime.operators import features as fe
from ontime.operators import reports as r
from ontime.operators.clean import clean, impute_median, impute_mode, normalize_text
from ontime.operators.integrate import Dimension, attach, integrate, prepare_dimension
from ontime.plans.etl import transform

_CAP = "upper(left({0}, 1)) || lower(substr({0}, 2))"


def _normal(c: str) -> str:
    return _CAP.format(f"trim({c}, chr(32) || chr(9) || chr(10) || chr(13))")


_TITLE = ("array_to_string(list_transform(regexp_extract_all({0}, '([a-zA-Z]+|[^a-zA-Z]+)'), "
          "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '')")

CLEAN = f"""{i.DIRTY},
distinct_rows AS (SELECT DISTINCT * FROM dirty),
normal AS (
  SELECT * REPLACE ({_normal("event_type")} AS event_type, {_TITLE.format("district")} AS district,
                    CASE WHEN value > 900 THEN NULL ELSE value END AS value)
  FROM distinct_rows WHERE duration > 0
),
stats AS (SELECT (SELECT median(value) FROM normal) AS mid,
                 (SELECT event_type FROM normal WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top),
cleaned AS (
  SELECT normal.* REPLACE (coalesce(value, mid) AS value, coalesce(event_type, top) AS event_type) FROM normal, stats
)"""


@query("cln_normalize_text", f"""
WITH {i.DIRTY} SELECT event_id, {_normal("event_type")} AS event_type, {_TITLE.format("district")} AS district,
       CAST(duration AS BIGINT) AS duration FROM dirty""")
def normalize(spark, sf):
    return normalize_text(i.dirty(spark, sf), ["event_type", "district"], ["district"]).select(
        "event_id", "event_type", "district", F.col("duration").cast("long").alias("duration"))


@query("str_title", f"""
WITH n AS (SELECT p_partkey, replace(p_name, ' ', '-') || ' o''' || lower(p_type) AS name FROM part)
SELECT p_partkey, {_TITLE.format("name")} AS title FROM n""")
def str_title(spark, sf):
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" o'"), F.lower("p_type"))
    return i.table(spark, sf, "part").select("p_partkey", title_case(name).alias("title"))


@query("cln_outlier_to_null", f"""
WITH {i.DIRTY} SELECT event_id, CASE WHEN value > 900 THEN NULL ELSE value END AS value FROM dirty""")
def outlier_to_null(spark, sf):
    return i.dirty(spark, sf).select("event_id", numeric.null_above(F.col("value"), 900).alias("value"))


@query("cln_impute", f"""
WITH {i.DIRTY} SELECT event_id, coalesce(value, (SELECT median(value) FROM dirty)) AS value FROM dirty""")
def impute(spark, sf):
    return impute_median(i.dirty(spark, sf).select("event_id", "value"), ["value"])


@query("cln_impute_mode", f"""
WITH {i.DIRTY}
SELECT event_id, coalesce(event_type, (SELECT event_type FROM dirty WHERE event_type IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type FROM dirty""")
def mode(spark, sf):
    return impute_mode(i.dirty(spark, sf).select("event_id", "event_type"), ["event_type"])


@query("job_clean", f"WITH {CLEAN} SELECT * FROM cleaned")
def job_clean(spark, sf):
    return clean(i.dirty(spark, sf), RULES).df


@query("flt_invalid_rows", f"WITH {i.FACT} SELECT count(*) AS n, sum(lead_days)::BIGINT AS days FROM fact WHERE lead_days > 0")
def invalid_rows(spark, sf):
    return i.fact(spark, sf).filter("lead_days > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("lead_days").alias("days"))


@query("flt_multi_isin", f"""
WITH {i.FACT} SELECT order_key, line_no, segment, priority, value FROM fact
WHERE segment IN ('MACHINERY', 'BUILDING') AND priority IN ('1-URGENT')""")
def multi_isin(spark, sf):
    chosen = r.filter_in(i.fact(spark, sf), {"segment": ["MACHINERY", "BUILDING"], "priority": ["1-URGENT"], "status": []})
    return chosen.select("order_key", "line_no", "segment", "priority", "value")


@query("prj_code_map", f"""
WITH {i.FACT} SELECT order_key, line_no, value,
  CASE status WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS state,
  CASE late WHEN 0 THEN 'on time' WHEN 1 THEN 'late' END AS outcome FROM fact""")
def code_map(spark, sf):
    return i.fact(spark, sf).select(
        "order_key", "line_no", "value", numeric.code_label(F.col("status"), {"F": "finished", "O": "open"}).alias("state"),
        numeric.code_label(F.col("late"), {0: "on time", 1: "late"}).alias("outcome"))


@query("prj_clip", f"""
WITH {i.DIRTY} SELECT event_id, CASE WHEN value IS NOT NULL THEN least(greatest(value, 5.0), 100.0) END AS bounded,
  CASE WHEN value IS NOT NULL THEN greatest(value, 8.0) END AS floored FROM dirty""")
def clip(spark, sf):
    return i.dirty(spark, sf).select("event_id", numeric.clip(F.col("value"), 5.0, 100.0).alias("bounded"),
                                     numeric.clip(F.col("value"), low=8.0).alias("floored"))


@query("prj_additive_score", f"""
WITH {i.FACT} SELECT order_key, line_no, value, round(4.25 + value * 0.25 + line_no * 0.75
  + CASE WHEN late = 1 THEN 2.5 ELSE 0.0 END + CASE WHEN priority = '5-LOW' THEN value * 0.5 ELSE 0.0 END, 4) AS score FROM fact""")
def additive(spark, sf):
    score = numeric.additive_score(4.25, {"value": 0.25, "line_no": 0.75}, [
        (F.col("late") == 1, 2.5), (F.col("priority") == "5-LOW", F.col("value") * 0.5)])
    return i.fact(spark, sf).select("order_key", "line_no", "value", F.round(score, 4).alias("score"))


# --- features --------------------------------------------------------------------------------------


@query("fe_late_label", f"WITH {i.FACT} SELECT order_key, line_no, value, lead_days, late FROM fact WHERE lead_days > 0")
def late_label(spark, sf):
    return i.fact(spark, sf).filter("lead_days > 0").select("order_key", "line_no", "value", "lead_days", "late")


@query("fe_ratio_round", f"""
WITH {i.DIRTY} SELECT event_id, round_even(value / nullif(items, 0), 0) AS value_per_item FROM dirty""")
def ratio_round(spark, sf):
    return i.dirty(spark, sf).select("event_id", numeric.ratio(F.col("value"), F.col("items")).alias("value_per_item"))


@query("fe_flags", f"""
WITH {i.DIRTY} SELECT event_id, CAST(hour IN (13, 14, 20, 21) AS INT) AS is_rush_hour, CAST(dow >= 6 AS INT) AS is_weekend,
  CAST(experience_months < 6 AS INT) AS is_novice FROM dirty""")
def flags(spark, sf):
    return fe.order_features(i.dirty(spark, sf)).select("event_id", "is_rush_hour", "is_weekend", "is_novice")


def _fact_with_density(spark, sf):
    dims = i.reference(i.district_dim(spark, sf).select("district", "density", "population", "area"))
    return attach(i.fact(spark, sf), dims, "district")


@query("fe_above_median", f"""
WITH {i.FACT}, {i.DISTRICTS}, j AS (SELECT fact.*, density FROM fact LEFT JOIN district_dim USING (district))
SELECT order_key, line_no, value, density,
       CAST(coalesce(density > (SELECT median(density) FROM j), false) AS INT) AS is_dense FROM j""")
def above_median(spark, sf):
    return fe.above_median(_fact_with_density(spark, sf), "density", "is_dense").select(
        "order_key", "line_no", "value", "density", "is_dense")


@query("dt_hour_dow", "SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) AS INT) AS dow FROM events")
def hour_dow(spark, sf):
    parts = fe.date_parts(F.col("ts"))
    return i.table(spark, sf, "events").select("event_id", *[e.alias(n) for n, e in parts.items()])


# --- joins -----------------------------------------------------------------------------------------


@query("join_left_dim", f"""
WITH {i.FACT}, {i.DISTRICTS} SELECT order_key, line_no, value, population, density FROM fact LEFT JOIN district_dim USING (district)""")
def left_dim(spark, sf):
    return _fact_with_density(spark, sf).select("order_key", "line_no", "value", "population", "density")


@query("join_two_dims", f"""
WITH {i.FACT}, {i.DISTRICTS}, {i.WEATHER}
SELECT order_key, line_no, value, population, temperature_c, wind_kmh FROM fact
LEFT JOIN district_dim USING (district) LEFT JOIN weather_dim USING (district)""")
def two_dims(spark, sf):
    joined = attach(_fact_with_density(spark, sf), i.reference(i.weather_dim(spark, sf)), "district")
    return joined.select("order_key", "line_no", "value", "population", "temperature_c", "wind_kmh")


@query("join_context", f"""
WITH {i.FACT}, c AS (SELECT district, any_value(region_key) AS region, any_value(district_key) AS code FROM fact GROUP BY 1)
SELECT n_name AS district, s_suppkey AS scenario, region, code FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN c ON c.district = n_name""")
def join_context(spark, sf):
    attributes = i.reference(r.context(i.fact(spark, sf).select(
        "district", F.col("region_key").alias("region"), F.col("district_key").alias("code")), "district", ["region", "code"]))
    asked = i.table(spark, sf, "supplier").join(i.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .select(F.col("n_name").alias("district"), F.col("s_suppkey").alias("scenario"))
    return asked.join(prepare_dimension(attributes, "district"), "district").select("district", "scenario", "region", "code")


def _dims(spark, sf, title: bool):
    def named(df):
        return i.reference(df.withColumn("district", title_case(F.col("district"))) if title else df)
    return [
        Dimension("districts", named(i.district_dim(spark, sf)), ["population", "area", "density", "region_key"]),
        Dimension("weather", named(i.weather_dim(spark, sf)), ["temperature_c", "humidity_pct", "wind_kmh"]),
    ]


@query("job_integrate", f"""
WITH {i.FACT}, {i.DISTRICTS}, {i.WEATHER}
SELECT order_key, line_no, value, district, late, population, area, density, temperature_c, humidity_pct, wind_kmh
FROM fact JOIN district_dim USING (district) JOIN weather_dim USING (district)""")
def job_integrate(spark, sf):
    fact = i.fact(spark, sf).select("order_key", "line_no", "value", "district", "late")
    return integrate(fact, "district", _dims(spark, sf, False))[0].drop("region_key")


_ENRICHED = """
  CAST(hour IN (13, 14, 20, 21) AS INT) AS is_rush_hour, CAST(dow >= 6 AS INT) AS is_weekend,
  round_even(value / nullif(items, 0), 0) AS value_per_item, CAST(experience_months < 6 AS INT) AS is_novice,
  CAST(coalesce(density > (SELECT median(density) FROM j), false) AS INT) AS is_dense_district"""


@query("job_enrich", f"""
WITH {i.DIRTY}, {i.DISTRICTS}, j AS (SELECT dirty.*, density FROM dirty LEFT JOIN district_dim USING (district))
SELECT event_id, {_ENRICHED} FROM j""")
def job_enrich(spark, sf):
    joined = attach(i.dirty(spark, sf), i.reference(i.district_dim(spark, sf)), "district", ["density"])
    return fe.enrich(joined).select("event_id", "is_rush_hour", "is_weekend", "value_per_item", "is_novice", "is_dense_district")


@query("job_etl", f"""
WITH {CLEAN}, {i.DISTRICTS}, {i.WEATHER},
j AS (
  SELECT cleaned.*, population, area, density, region_key, temperature_c, humidity_pct, wind_kmh
  FROM cleaned JOIN (SELECT * REPLACE ({_TITLE.format("district")} AS district) FROM district_dim) d USING (district)
  JOIN (SELECT * REPLACE ({_TITLE.format("district")} AS district) FROM weather_dim) w USING (district)
)
SELECT *, {_ENRICHED} FROM j""")
def job_etl(spark, sf):
    return transform(i.dirty(spark, sf), "district", _dims(spark, sf, True), RULES)[0]
