"""Rates, statistics, profiles, ordering and sampling."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.catalog import inputs as i
from ontime.catalog.registry import query
from ontime.functions.order_keys import hash_key
from ontime.operators import perturb, selection
from ontime.operators import reports as r
from ontime.operators.integrate import attach
from ontime.operators.keytree import number_rows
from ontime.plans.dashboard import DashboardColumns, dashboard


def valid(spark, sf):
    return i.fact(spark, sf).filter("lead_days > 0")


@query("agg_late_rate_by_nation", f"""
WITH {i.FACT} SELECT district, count(*) AS n, round_even(avg(late), 4) AS late_rate FROM fact WHERE lead_days > 0
GROUP BY 1 ORDER BY late_rate DESC, district""")
def late_rate_by_nation(spark, sf):
    """Flagship. Lines are folded to one count per customer before they meet customers and nations, so after
    the one join of the two large tables only sums travel."""
    lines, orders = i.table(spark, sf, "lineitem"), i.table(spark, sf, "orders")
    lead = F.datediff("l_shipdate", "o_orderdate")
    per_customer = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(lead > 0)
        .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(lead > 50).alias("late"))
    )
    return (
        per_customer.join(i.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(i.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("district"))
        .agg(F.sum("n").alias("n"), F.bround(F.sum("late") / F.sum("n"), 4).alias("late_rate"))
        .orderBy(F.desc("late_rate"), "district")
    )


@query("agg_late_rate", f"WITH {i.FACT} SELECT round_even(avg(late), 4) AS late_rate FROM fact WHERE lead_days > 0")
def late_rate(spark, sf):
    return r.rate(valid(spark, sf), "late")


@query("agg_rate_by_hour", """
SELECT hour(ts)::INT AS hour, count(*) AS n, round_even(avg(CAST(value > 50 AS INT)), 4) AS late_rate FROM events GROUP BY 1 ORDER BY 1""")
def rate_by_hour(spark, sf):
    events = i.table(spark, sf, "events").select(F.hour("ts").alias("hour"), (F.col("value") > 50).cast("int").alias("late"))
    return r.rate_by(events, "hour", "late")


@query("agg_rate_by_district", f"""
WITH {i.FACT} SELECT segment, count(*) AS n, round_even(avg(late), 4) AS late_rate FROM fact WHERE lead_days > 0
GROUP BY 1 ORDER BY 3 DESC, 1""")
def rate_by_district(spark, sf):
    return r.rate_by(valid(spark, sf), "segment", "late", descending=True)


@query("agg_binned_rate", f"""
WITH {i.FACT} SELECT CAST(floor(items / 6) * 6 AS BIGINT) AS bin, count(*) AS n, round_even(avg(late), 4) AS late_rate FROM fact
WHERE lead_days > 0 GROUP BY 1 ORDER BY 1""")
def binned_rate(spark, sf):
    return r.rate_by_bin(valid(spark, sf), "items", 6, "late")


@query("agg_median", f"""
WITH {i.DIRTY} SELECT median(value) AS value, median(duration) AS duration FROM dirty""")
def median(spark, sf):
    found = selection.exact_medians(i.dirty(spark, sf), ["value", "duration"])
    return spark.range(1).select(*[F.lit(v).cast("double").alias(c) for c, v in found.items()])


@query("agg_weighted_median", f"""
WITH {i.FACT}, {i.DISTRICTS} SELECT median(density) AS median FROM fact JOIN district_dim USING (district)""")
def weighted_median(spark, sf):
    joined = attach(i.fact(spark, sf), i.reference(i.district_dim(spark, sf)), "district", ["density"])
    return selection.weighted_median(joined, "density")


@query("agg_mode", f"""
WITH {i.DIRTY} SELECT event_type AS value, count(*) AS n FROM dirty WHERE event_type IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def mode(spark, sf):
    return selection.exact_mode(i.dirty(spark, sf), "event_type")


@query("agg_nunique", f"""
WITH {i.DIRTY} SELECT count(DISTINCT event_type) AS n_event_type, count(DISTINCT district) AS n_district,
  count(DISTINCT user_id) AS n_user_id FROM dirty""")
def nunique(spark, sf):
    return r.nunique(i.dirty(spark, sf), ["event_type", "district", "user_id"])


@query("agg_distinct_values", f"WITH {i.DIRTY} SELECT DISTINCT event_type FROM dirty WHERE event_type IS NOT NULL ORDER BY 1")
def distinct_values(spark, sf):
    return r.distinct_values(i.dirty(spark, sf), "event_type")


def districts_of_orders(spark, sf):
    """Orders folded to districts, with the districts' own attributes attached first."""
    dims = i.reference(i.district_dim(spark, sf).select("district", "population", "area", "density"))
    orders = attach(valid(spark, sf), dims, "district")
    return r.district_table(orders, "district", "late", {"mean_items": "items", "mean_lead": "lead_days"},
                            ["district_key", "region_key", "population", "area", "density"])


DISTRICT_TABLE = f"""
{i.FACT}, {i.DISTRICTS}, districts AS (
  SELECT district, count(*) AS n_orders, avg(late) AS late_rate, avg(items) AS mean_items, avg(lead_days) AS mean_lead,
         any_value(fact.district_key) AS district_key, any_value(fact.region_key) AS region_key, any_value(population) AS population, any_value(area) AS area,
         any_value(density) AS density
  FROM fact LEFT JOIN district_dim USING (district) WHERE lead_days > 0 GROUP BY 1
)"""


@query("agg_district_table", f"""
WITH {DISTRICT_TABLE} SELECT district, n_orders, round(late_rate, 6) AS late_rate, round(mean_items, 6) AS mean_items,
  round(mean_lead, 6) AS mean_lead, district_key, region_key, population, area, density FROM districts""")
def district_table(spark, sf):
    return districts_of_orders(spark, sf).withColumns(
        {c: F.round(c, 6) for c in ("late_rate", "mean_items", "mean_lead")})


@query("agg_homogeneity", f"""
WITH {DISTRICT_TABLE}
SELECT 'late_rate' AS variable, round_even(min(late_rate), 3) AS min, round_even(max(late_rate), 3) AS max,
  round_even(stddev_samp(late_rate) / avg(late_rate), 4) AS cv FROM districts
UNION ALL SELECT 'mean_items', round_even(min(mean_items), 3), round_even(max(mean_items), 3),
  round_even(stddev_samp(mean_items) / avg(mean_items), 4) FROM districts
UNION ALL SELECT 'mean_lead', round_even(min(mean_lead), 3), round_even(max(mean_lead), 3),
  round_even(stddev_samp(mean_lead) / avg(mean_lead), 4) FROM districts
UNION ALL SELECT 'n_orders', min(n_orders), max(n_orders), round_even(stddev_samp(n_orders) / avg(n_orders), 4) FROM districts""")
def homogeneity(spark, sf):
    return r.homogeneity(districts_of_orders(spark, sf), ["n_orders", "late_rate", "mean_items", "mean_lead"])


@query("agg_sorted_concat", f"""
WITH {i.FACT} SELECT region_key, string_agg(district, ', ' ORDER BY district) AS names
FROM (SELECT DISTINCT region_key, district FROM fact WHERE late = 1) GROUP BY 1""")
def sorted_concat(spark, sf):
    return r.sorted_concat(i.fact(spark, sf).filter("late = 1"), "region_key", "district")


PRIORITY_ROWS = ["5-LOW", "3-MEDIUM", "1-URGENT", "0-NEVER"]
SEGMENT_COLUMNS = ["BUILDING", "MACHINERY", "NO SUCH"]


@query("agg_pivot_rate", f"""
WITH {i.FACT}, r(position, priority) AS (VALUES (0, '5-LOW'), (1, '3-MEDIUM'), (2, '1-URGENT'), (3, '0-NEVER'))
SELECT position, r.priority,
  round_even(avg(late) FILTER (segment = 'BUILDING'), 4) AS "BUILDING",
  round_even(avg(late) FILTER (segment = 'MACHINERY'), 4) AS "MACHINERY",
  round_even(avg(late) FILTER (segment = 'NO SUCH'), 4) AS "NO SUCH"
FROM r LEFT JOIN fact USING (priority) GROUP BY 1, 2 ORDER BY 1""")
def pivot_rate(spark, sf):
    return r.pivot_rate(i.fact(spark, sf), "priority", "segment", "late", PRIORITY_ROWS, SEGMENT_COLUMNS)


@query("agg_histogram", f"""
WITH {i.FACT}, b AS (SELECT min(value) AS low, max(value) AS high FROM fact)
SELECT CAST(least(floor(60.0::DOUBLE * ((value - low) / (high - low))) + 1, 60) AS INT) AS bin, count(*) AS n
FROM fact, b GROUP BY 1 ORDER BY 1""")
def histogram(spark, sf):
    return r.histogram(i.fact(spark, sf), "value", 60)


@query("rpt_kpis", f"""
WITH {i.FACT} SELECT count(*) AS n_orders, round_even(avg(late), 4) AS late_rate, round_even(avg(lead_days), 2) AS mean_minutes
FROM fact WHERE lead_days > 0 AND segment IN ('MACHINERY') AND status IN ('F', 'O')""")
def kpis(spark, sf):
    return r.kpis(r.filter_in(valid(spark, sf), {"segment": ["MACHINERY"], "status": ["F", "O"], "priority": None}), "late", "lead_days")


@query("rpt_transpose", f"""
WITH {i.FACT}, m AS (SELECT return_flag, count(*) AS n, sum(lead_days)::BIGINT AS days, max(lead_days) AS longest FROM fact GROUP BY 1)
SELECT metric, max(value) FILTER (return_flag = 'A') AS "A", max(value) FILTER (return_flag = 'N') AS "N",
  max(value) FILTER (return_flag = 'R') AS "R"
FROM (SELECT return_flag, 'n' AS metric, n::DOUBLE AS value FROM m UNION ALL SELECT return_flag, 'days', days::DOUBLE FROM m
  UNION ALL SELECT return_flag, 'longest', longest::DOUBLE FROM m) GROUP BY 1 ORDER BY 1""")
def transpose(spark, sf):
    wide = i.fact(spark, sf).groupBy("return_flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lead_days").alias("days"), F.max("lead_days").alias("longest"))
    return r.transpose(wide, "return_flag", ["n", "days", "longest"], ["A", "N", "R"])


@query("rpt_segment_profile", f"""
WITH {DISTRICT_TABLE}
SELECT CASE WHEN population >= 15 * area THEN 'dense' ELSE 'sparse' END AS segment, count(*) AS n_districts,
  round_even(avg(population), 1) AS population, round_even(avg(area), 1) AS area, round_even(avg(n_orders), 1) AS n_orders,
  round_even(avg(late_rate), 4) AS late_rate, string_agg(district, ', ' ORDER BY district) AS districts
FROM districts GROUP BY 1 ORDER BY 1""")
def segment_profile(spark, sf):
    named = districts_of_orders(spark, sf).withColumn(
        "segment", F.when(F.col("population") >= 15 * F.col("area"), "dense").otherwise("sparse"))
    return r.segment_profile(named, "segment", "district", ["population", "area", "n_orders"], "late_rate")


@query("rpt_segment_decimals", f"""
WITH {DISTRICT_TABLE}
SELECT CASE WHEN population >= 15 * area THEN 'dense' ELSE 'sparse' END AS segment, count(*) AS n_districts,
  round_even(avg(population), 2) AS population, round_even(avg(mean_lead), 3) AS mean_lead,
  round_even(avg(late_rate), 2) AS late_rate, string_agg(district, ', ' ORDER BY district) AS districts
FROM districts GROUP BY 1 ORDER BY 1""")
def segment_decimals(spark, sf):
    """The segment summary with places of the caller's choice."""
    named = districts_of_orders(spark, sf).withColumn(
        "segment", F.when(F.col("population") >= 15 * F.col("area"), "dense").otherwise("sparse"))
    return r.segment_profile(named, "segment", "district", ["population", "mean_lead"], "late_rate", {"population": 2, "mean_lead": 3}, 2)


DASHBOARD = DashboardColumns(label="late", minutes="lead_days", hour="items", district="district", row="priority", rows=("5-LOW", "1-URGENT"),
                             column="status", columns=("F", "O"), bins=20)


@query("rpt_dashboard", f"""
WITH {i.FACT}, f AS (SELECT * FROM fact WHERE lead_days > 0 AND segment IN ('MACHINERY', 'BUILDING')),
b AS (SELECT min(lead_days) AS low, max(lead_days) AS high FROM f)
SELECT 'kpis' AS part, '' AS place, '' AS across, count(*)::DOUBLE AS n, round_even(avg(late), 4) AS value FROM f
UNION ALL SELECT 'by_hour', CAST(items AS VARCHAR), '', count(*), round_even(avg(late), 4) FROM f GROUP BY 2
UNION ALL SELECT 'by_district', district, '', count(*), round_even(avg(late), 4) FROM f GROUP BY 2
UNION ALL SELECT 'heatmap', priority, status, NULL, round_even(avg(late), 4) FROM f WHERE priority IN ('5-LOW', '1-URGENT') AND status IN ('F', 'O') GROUP BY 2, 3
UNION ALL SELECT 'minutes', CAST(CAST(least(floor(20.0::DOUBLE * ((lead_days - low) / (high - low))) + 1, 20) AS INT) AS VARCHAR), '', count(*), NULL
  FROM f, b GROUP BY 2""")
def dashboard_tables(spark, sf):
    """All tables behind the dashboard for one choice of filters, one under the other."""
    t = dashboard(valid(spark, sf), {"segment": ["MACHINERY", "BUILDING"], "status": None}, DASHBOARD)
    none = F.lit(None).cast("double")

    def part(name, place, across, n, value, df):
        return df.select(F.lit(name).alias("part"), place.cast("string").alias("place"), across.alias("across"), n.cast("double").alias("n"), value.alias("value"))

    heat = t["heatmap"].unpivot("priority", ["F", "O"], "status", "rate").where("rate is not null")
    return reduce(DataFrame.unionAll, [
        part("kpis", F.lit(""), F.lit(""), F.col("n_orders"), F.col("late_rate"), t["kpis"]),
        part("by_hour", F.col("items"), F.lit(""), F.col("n"), F.col("late_rate"), t["by_hour"]),
        part("by_district", F.col("district"), F.lit(""), F.col("n"), F.col("late_rate"), t["by_district"]),
        part("heatmap", F.col("priority"), F.col("status"), none, F.col("rate"), heat),
        part("minutes", F.col("bin"), F.lit(""), F.col("n"), none, t["minutes"])])


@query("prj_exclude", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def exclude(spark, sf):
    return r.without_columns(i.table(spark, sf, "orders"), lambda c: c.endswith(("date", "priority", "price")))


# --- order, limit, sample --------------------------------------------------------------------------


@query("top_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def top_head(spark, sf):
    return r.head(i.table(spark, sf, "customer"), ["c_custkey"], 5)


@query("top_k_abs", """
SELECT s_name, round(s_acctbal - 5000, 2) AS weight FROM supplier ORDER BY abs(round(s_acctbal - 5000, 2)) DESC, s_name LIMIT 12""")
def top_k_abs(spark, sf):
    weights = i.table(spark, sf, "supplier").select("s_name", F.round(F.col("s_acctbal") - 5000, 2).alias("weight"))
    return r.top_abs(weights, "weight", "s_name", 12)


@query("top_argmax", f"""
WITH {i.FACT} SELECT segment, round_even(avg(late), 4) AS late_rate FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def top_argmax(spark, sf):
    rates = i.fact(spark, sf).groupBy("segment").agg(F.bround(F.avg("late"), 4).alias("late_rate"))
    return r.arg_max(rates, "late_rate", "segment")


def hash_sql(key: str, seed: int) -> str:
    return f"substr(md5({key} || '#{seed}'), 1, 16) || {key}"


@query("smp_fixed_n", f"""
SELECT event_id, value, CASE WHEN value > 50 THEN 'late' ELSE 'on time' END AS outcome FROM events
ORDER BY {hash_sql("event_id", 42)} LIMIT 1500""")
def fixed_n(spark, sf):
    chosen = selection.sample_rows(i.table(spark, sf, "events"), 1500, "event_id", 42)
    return chosen.select("event_id", "value", F.when(F.col("value") > 50, "late").otherwise("on time").alias("outcome"))


@query("smp_shuffle", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {hash_sql("o_orderkey", 42)}) AS place FROM orders""")
def shuffle(spark, sf):
    """The place of every row in a repeatable random order."""
    keyed = i.table(spark, sf, "orders").select("o_orderkey", hash_key(F.col("o_orderkey"), 42).alias("h"))
    return number_rows(keyed, "h", "place").drop("h")


@query("dirty_nulls", f"WITH {i.DIRTY} SELECT event_id, CASE WHEN event_id % 40 = 7 THEN NULL ELSE value END AS value FROM clean_events")
def dirty_nulls(spark, sf):
    return perturb.null_out(i.clean_events(spark, sf), "value", perturb.every("event_id", 40, 7)).select("event_id", "value")


@query("dirty_text", f"WITH {i.DIRTY} SELECT event_id, event_type, district FROM dirty_rows")
def dirty_text(spark, sf):
    return i.dirty_rows(spark, sf).select("event_id", "event_type", "district")


@query("dirty_outliers", f"WITH {i.DIRTY} SELECT event_id, value, duration FROM dirty_rows")
def dirty_outliers(spark, sf):
    return i.dirty_rows(spark, sf).select("event_id", "value", "duration")


@query("dirty_duplicates", f"""
WITH {i.DIRTY} SELECT event_id, value, hour FROM clean_events UNION ALL
(SELECT event_id, value, hour FROM clean_events ORDER BY {hash_sql("event_id", 7)} LIMIT 600)""".replace("hour FROM", "CAST(hour AS INT) AS hour FROM"))
def dirty_duplicates(spark, sf):
    return perturb.append_copies(i.clean_events(spark, sf).select("event_id", "value", "hour"), 600, "event_id")


@query("str_format_id", """
SELECT o_orderkey, 'PED_' || lpad(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR),
  greatest(5, length(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR)))::INT, '0') AS order_id FROM orders""")
def format_id(spark, sf):
    return perturb.format_ids(i.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "order_id")
