"""Inputs shared by the queries, written once for Spark and once as SQL ``WITH`` parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.numeric import density, flag
from ontime.operators import perturb
from ontime.operators.features import date_parts, late_flag
from ontime.session import stage


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- fact: one row per order line with its lead time -----------------------------------------------

FACT = """
fact AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_no,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS INT) AS lead_days,
         CAST(date_diff('day', o_orderdate, l_shipdate) > 50 AS INT) AS late,
         l_extendedprice AS value, l_quantity AS items, l_discount AS discount,
         c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status,
         l_returnflag AS return_flag, n_name AS district, n_nationkey AS district_key, n_regionkey AS region_key,
         o_custkey AS customer_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
)"""


def fact(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    lead = F.datediff("l_shipdate", "o_orderdate")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
            lead.alias("lead_days"), late_flag(lead).alias("late"),
            F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("items"),
            F.col("l_discount").alias("discount"), F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
            F.col("l_returnflag").alias("return_flag"), F.col("n_name").alias("district"),
            F.col("n_nationkey").alias("district_key"), F.col("n_regionkey").alias("region_key"),
            F.col("o_custkey").alias("customer_key"),
        )
    )


# --- districts: a reference table and a weather table per nation -----------------------------------

DISTRICTS = """
district_dim AS (
  SELECT n_nationkey AS district_key, n_name AS district, n_regionkey AS region_key,
         coalesce(customers, 0) AS population, coalesce(suppliers, 0) AS area,
         round(coalesce(customers, 0) / nullif(coalesce(suppliers, 0), 0), 1) AS density
  FROM nation
  LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey
)"""

WEATHER = """
weather_dim AS (
  SELECT n_name AS district,
         coalesce(sum(CAST(round(c_acctbal * 100) AS BIGINT)) // nullif(count(c_custkey), 0), 0) / 1000 AS temperature_c,
         count(c_custkey) % 100 AS humidity_pct,
         coalesce(max(CAST(round(c_acctbal * 100) AS BIGINT)), 0) / 10000 AS wind_kmh
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
  GROUP BY n_name
)"""


def district_dim(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation")
    people = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    shops = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    joined = (
        nations.join(people, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(shops, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("n_nationkey").alias("district_key"), F.col("n_name").alias("district"),
            F.col("n_regionkey").alias("region_key"),
            F.coalesce("customers", F.lit(0)).alias("population"), F.coalesce("suppliers", F.lit(0)).alias("area"),
        )
    )
    return joined.withColumn("density", density(F.col("population"), F.col("area")))


def weather_dim(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    people = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents).alias("total"), F.max(cents).alias("most"))
    n = F.coalesce("n", F.lit(0))
    return table(spark, sf, "nation").join(people, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("n_name").alias("district"),
        (F.coalesce(F.expr("total div n"), F.lit(0)) / 1000).alias("temperature_c"),
        (n % 100).alias("humidity_pct"),
        (F.coalesce("most", F.lit(0)) / 10000).alias("wind_kmh"),
    )


def reference(dim: DataFrame) -> DataFrame:
    """A dimension kept as a table, as reference data is: key checks and joins then read it, not its sources."""
    return stage(dim, "reference")


# --- dirty: events made dirty by fixed rules -------------------------------------------------------

DIRTY = """
clean_events AS (
  SELECT event_id, user_id, event_type, value, hour(ts) + 1 AS duration, hour(ts) AS hour,
         CAST(isodow(ts) AS INT) AS dow, CAST(user_id % 5 AS INT) AS items, user_id % 61 AS experience_months,
         'NATION_' || (user_id % 25) AS district, CAST(hour(ts) + 1 > 12 AS INT) AS late
  FROM events
),
dirty_rows AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % 100 = 11 THEN NULL
              WHEN event_id % 67 = 2 THEN ' ' || (CASE WHEN event_id % 50 = 1 THEN upper(event_type) ELSE event_type END) || ' '
              WHEN event_id % 50 = 1 THEN upper(event_type) ELSE event_type END AS event_type,
         CASE WHEN event_id % 40 = 7 THEN NULL WHEN event_id % 997 = 3 THEN value + 1000 ELSE value END AS value,
         CAST(CASE WHEN event_id % 400 = 5 THEN -1 ELSE duration END AS INT) AS duration,
         CAST(hour AS INT) AS hour, dow, items, experience_months,
         CASE WHEN event_id % 31 = 4 THEN lower(district) ELSE district END AS district, late
  FROM clean_events
),
dirty AS (
  SELECT * FROM dirty_rows
  UNION ALL SELECT * FROM dirty_rows WHERE event_id % 87 = 0
)"""

DIRTY_COLUMNS = ["event_id", "user_id", "event_type", "value", "duration", "hour", "dow", "items",
                 "experience_months", "district", "late"]


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    parts = date_parts(F.col("ts"))
    duration = parts["hour"] + 1
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", duration.alias("duration"), parts["hour"].alias("hour"),
        parts["dow"].alias("dow"), (F.col("user_id") % 5).cast("int").alias("items"),
        (F.col("user_id") % 61).alias("experience_months"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("district"),
        flag(duration > 12).alias("late"),
    )


def dirty_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = clean_events(spark, sf)
    df = perturb.upper_case(df, "event_type", perturb.every("event_id", 50, 1))
    df = perturb.pad(df, "event_type", perturb.every("event_id", 67, 2))
    df = perturb.null_out(df, "event_type", perturb.every("event_id", 100, 11))
    df = perturb.implant(df, "value", F.col("value") + 1000, perturb.every("event_id", 997, 3))
    df = perturb.null_out(df, "value", perturb.every("event_id", 40, 7))
    df = perturb.implant(df, "duration", F.lit(-1), perturb.every("event_id", 400, 5))
    return perturb.lower_case(df, "district", perturb.every("event_id", 31, 4)).select(*DIRTY_COLUMNS)


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    rows = dirty_rows(spark, sf)
    return perturb.append_rows(rows, rows.filter(perturb.every("event_id", 87, 0)))
