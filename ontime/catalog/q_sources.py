"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.catalog import inputs as i
from ontime.catalog.registry import query
from ontime.operators import reports as r
from ontime.operators.integrate import attach
from ontime.session import scratch_path
from ontime.sources import api, readers, schemas, sinks
from ontime.sources.versions import VersionedFolder


@query("src_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, ' ' || c_mktsegment || ' ' AS padded FROM customer")
def csv_roundtrip(spark, sf):
    source = i.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("padded"))
    path = scratch_path(spark, "customer-csv")
    sinks.write_csv(source, path)
    return readers.read_csv(spark, path, source.schema)


@query("src_sql_density", f"""
WITH {i.DISTRICTS} SELECT district, population, area, density, region_key FROM district_dim ORDER BY district""")
def sql_density(spark, sf):
    places = i.district_dim(spark, sf).drop("density")
    return readers.read_with_query(places, "ontime_districts", readers.district_query(
        "ontime_districts", "district", "population", "area", ["region_key"]))


# A reference table of order priorities.
PRIORITIES = [("1-URGENT", 1, 24.0), ("2-HIGH", 2, 48.0), ("3-MEDIUM", 3, 72.0), ("4-NOT SPECIFIED", 4, 96.0), ("5-LOW", 5, 120.0)]


@query("src_inline_dim", """
WITH p(priority, tier, promise_hours) AS (VALUES ('1-URGENT', 1, 24.0::DOUBLE), ('2-HIGH', 2, 48.0), ('3-MEDIUM', 3, 72.0),
  ('4-NOT SPECIFIED', 4, 96.0), ('5-LOW', 5, 120.0))
SELECT priority, tier, promise_hours, count(*) AS n_orders FROM orders JOIN p ON o_orderpriority = priority GROUP BY ALL""")
def inline_dim(spark, sf):
    schema = T.StructType([T.StructField("priority", T.StringType(), False), T.StructField("tier", T.IntegerType(), False),
                           T.StructField("promise_hours", T.DoubleType(), False)])
    dim = readers.read_reference(spark, scratch_path(spark, "priorities"), lambda: spark.createDataFrame(PRIORITIES, schema))
    counts = i.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n_orders"))
    return attach(counts, dim, "priority").filter(F.col("tier").isNotNull()).select("priority", "tier", "promise_hours", "n_orders")


SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                         T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])


@query("src_json_snapshot", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def json_snapshot(spark, sf):
    path = scratch_path(spark, "supplier-json")
    sinks.write_snapshot(i.table(spark, sf, "supplier").select(*SUPPLIER.names), path, "suppliers", "s_suppkey")
    return readers.read_snapshot(spark, path, schemas.envelope(SUPPLIER))


@query("snk_json_envelope", """
WITH n AS (SELECT s_suppkey, (row_number() OVER (ORDER BY s_suppkey) - 1) // 16 AS part FROM supplier)
SELECT 'suppliers' AS source, '2024-01-01T00:00:00' AS extracted_at, part, count(*) AS n_records,
       min(s_suppkey) AS first_key, max(s_suppkey) AS last_key, string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey) AS keys
FROM n GROUP BY part""")
def json_envelope(spark, sf):
    """Every envelope as it was stored: its part, its key range and its records in order."""
    path = sinks.write_snapshot(
        i.table(spark, sf, "supplier").select(*SUPPLIER.names), scratch_path(spark, "supplier-envelope"), "suppliers", "s_suppkey",
        extracted_at=F.lit("2024-01-01T00:00:00"), records=16)
    keys = F.col("records.s_suppkey")
    return spark.read.schema(schemas.envelope(SUPPLIER)).json(path).select(
        "source", "extracted_at", "part", F.size("records").cast("long").alias("n_records"), keys[0].alias("first_key"),
        F.element_at(keys, -1).alias("last_key"), F.array_join(keys.cast("array<string>"), ",").alias("keys"))


@query("snk_envelope_text_key", """
WITH n AS (SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 100 AS part FROM customer)
SELECT part, count(*) AS n_records, min(c_name) AS first_key, max(c_name) AS last_key FROM n GROUP BY part""")
def envelope_text_key(spark, sf):
    """Envelopes cut along a text key."""
    cut = sinks.envelopes(i.table(spark, sf, "customer").select("c_name", "c_acctbal"), "customers", "c_name", F.lit("2024-01-01T00:00:00"), 100)
    names = F.col("records.c_name")
    return cut.select("part", F.size("records").cast("long").alias("n_records"), names[0].alias("first_key"),
                      F.element_at(names, -1).alias("last_key"))


CUSTOMER = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                         T.StructField("c_acctbal", T.DoubleType())])


@query("src_snapshot_refresh", """
SELECT c_custkey, c_name, c_acctbal, 1::BIGINT AS versions, 2 AS fallbacks FROM customer""")
def snapshot_refresh(spark, sf):
    """A stored snapshot outlives a fetch that fails at once and one that fails while its rows are being written."""
    path, schema = scratch_path(spark, "customer-snapshot"), schemas.envelope(CUSTOMER)
    customers = i.table(spark, sf, "customer").select(*CUSTOMER.names)
    failed = []

    def refused():
        raise ConnectionError("refused")

    last = customers.agg(F.max("c_custkey")).scalar()
    broken_off = customers.withColumn(
        "c_acctbal", F.when(F.col("c_custkey") == last, F.raise_error(F.lit("broken off")).cast("double")).otherwise(F.lit(0.0)))
    readers.resolve_snapshot(spark, path, schema, lambda: customers, key="c_custkey")
    for fetch in (refused, lambda: broken_off):
        kept = readers.resolve_snapshot(spark, path, schema, fetch, refresh=True, key="c_custkey", on_fallback=failed.append)
    return kept.withColumns({"versions": F.lit(len(VersionedFolder(spark, path).history())).cast("long"), "fallbacks": F.lit(len(failed))})


@query("src_json_report", f"""
WITH {i.FACT} SELECT count(*) AS n_rows, round_even(avg(late), 4) AS late_rate FROM fact""")
def json_report(spark, sf):
    """A report with nested values, stored and read back by its fields."""
    path = scratch_path(spark, "report")
    sinks.write_report(i.fact(spark, sf).agg(F.struct(F.count(F.lit(1)).alias("n_rows"), F.bround(F.avg("late"), 4).alias("late_rate")).alias("orders")), path)
    schema = T.StructType([T.StructField("orders", T.StructType([T.StructField("n_rows", T.LongType()), T.StructField("late_rate", T.DoubleType())]))])
    return readers.read_report(spark, path, schema).select("orders.n_rows", "orders.late_rate")


@query("src_first_existing", "SELECT count(*) AS n_orders, 0 AS has_optional FROM orders")
def first_existing(spark, sf):
    """The first of several places that exists; an optional input that is nowhere is absent, not an error."""
    nowhere = scratch_path(spark, "nowhere")
    orders = readers.read_first(spark, [nowhere, f"{sf}/orders.parquet"], spark.read.parquet)
    optional = readers.read_first(spark, [nowhere], spark.read.parquet, optional=True)
    return orders.agg(F.count(F.lit(1)).alias("n_orders")).withColumn("has_optional", F.lit(int(optional is not None)))


@query("src_json_positional", """
SELECT event_id, round(value, 1) AS temperature_c, user_id AS humidity_pct, value AS wind_kmh,
       CAST(event_id % 7 AS DOUBLE) AS precipitation_mm
FROM events QUALIFY row_number() OVER (ORDER BY event_id) <= (SELECT count(*) FROM events)""")
def json_positional(spark, sf):
    """Events dealt into requests; each request answered by one JSON text; points attached back by position."""
    events = api.assign_batches(i.table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id")
    current = F.struct(
        F.round("value", 1).alias("temperature_2m"), F.col("user_id").alias("relative_humidity_2m"),
        F.col("value").alias("wind_speed_10m"), (F.col("event_id") % 7).cast("double").alias("precipitation"))
    answers = (
        events.select("batch", F.struct("event_id", F.struct(current.alias("current")).alias("p")).alias("s"))
        .groupBy("batch").agg(F.sort_array(F.collect_list("s")).alias("s"))  # at most api.BATCH points
        .select("batch", F.to_json(F.transform("s", lambda s: s["p"])).alias("body"))
    )
    return api.rows_from_responses(events, answers, "event_id", "batch", "body")


@query("json_field_extract", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def json_field_extract(spark, sf):
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())]))
    return i.table(spark, sf, "events").select("event_id", parsed.alias("p")).select("event_id", F.col("p.k").alias("k"))


@query("agg_ordered_concat", """
WITH n AS (SELECT c_custkey, c_nationkey, c_acctbal, (row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS batch FROM customer)
SELECT batch, string_agg(CAST(c_acctbal AS VARCHAR), ',' ORDER BY c_custkey) AS c_acctbal,
       string_agg(CAST(c_nationkey AS VARCHAR), ',' ORDER BY c_custkey) AS c_nationkey
FROM n GROUP BY batch""")
def ordered_concat(spark, sf):
    places = api.assign_batches(i.table(spark, sf, "customer"), "c_custkey")
    return api.ordered_concat(places, "c_custkey", ["c_acctbal", "c_nationkey"], "batch")


@query("prj_lookup", f"WITH {i.DISTRICTS} SELECT density FROM district_dim WHERE district = 'NATION_3'")
def prj_lookup(spark, sf):
    return r.lookup(i.district_dim(spark, sf), "district", "NATION_3", "density")
