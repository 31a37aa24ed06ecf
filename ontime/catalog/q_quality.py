"""Data-quality checks."""

from pyspark.sql import functions as F

from ontime.catalog import inputs as i
from ontime.catalog.registry import query
from ontime.operators import quality as q
from ontime.operators.clean import CleanRules, quality_report
from ontime.operators.integrate import attach

RULES = CleanRules(text=("event_type", "district"), title=("district",), limits={"value": 900}, positive=("duration",),
                   impute_median=("value",), impute_mode=("event_type",))


@query("dq_unique_key", """
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
       CAST(count(*) = count(DISTINCT o_orderkey) AS INT) AS is_unique FROM orders""")
def unique_key(spark, sf):
    return q.unique_key_report(i.table(spark, sf, "orders"), ["o_orderkey"])


@query("dq_dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_keys(spark, sf):
    return q.duplicate_keys(i.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_not_null", f"""
WITH {i.DIRTY}
SELECT count(*) FILTER (event_id IS NULL) AS event_id, count(*) FILTER (value IS NULL) AS value,
       count(*) FILTER (event_type IS NULL) AS event_type FROM dirty""")
def not_null(spark, sf):
    columns = ["event_id", "value", "event_type"]
    return q.condition_counts(i.dirty(spark, sf), {c: F.col(c).isNull() for c in columns})


@query("dq_null_counts", f"""
WITH {i.DIRTY}, c AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS nulls FROM dirty" for c in i.DIRTY_COLUMNS)})
SELECT column, nulls FROM c WHERE nulls > 0 ORDER BY nulls DESC, column""".replace("AS column,", 'AS "column",')
    .replace("SELECT column, nulls FROM", 'SELECT "column", nulls FROM').replace("DESC, column", 'DESC, "column"'))
def null_counts(spark, sf):
    return q.null_counts(i.dirty(spark, sf))


_TYPES = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "duration": "int",
          "hour": "int", "dow": "int", "items": "int", "experience_months": "bigint", "district": "string", "late": "int"}


@query("dq_profile", f"WITH {i.DIRTY} " + " UNION ALL ".join(
    f"""SELECT {n} AS position, '{c}' AS "column", '{_TYPES[c]}' AS type, count(*) AS n_rows, count({c}) AS non_null FROM dirty"""
    for n, c in enumerate(i.DIRTY_COLUMNS)))
def profile(spark, sf):
    return q.profile(i.dirty(spark, sf))


@query("dq_range_counts", f"""
WITH {i.DIRTY}
SELECT count(*) FILTER (value > 900) AS outliers, count(*) FILTER (duration <= 0) AS invalid,
       count(*) FILTER (items = 0) AS no_items FROM dirty""")
def range_counts(spark, sf):
    return q.condition_counts(i.dirty(spark, sf), {
        "outliers": F.col("value") > 900, "invalid": F.col("duration") <= 0, "no_items": F.col("items") == 0})


@query("dq_duplicate_count", f"""
WITH {i.DIRTY} SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicates""")
def duplicate_count(spark, sf):
    return q.duplicate_count(i.dirty(spark, sf))


@query("dq_domain", f"""
WITH {i.DIRTY}
SELECT event_type AS value, count(*) AS n FROM dirty
WHERE event_type NOT IN ('click', 'view', 'purchase', 'error', 'signup') GROUP BY 1""")
def domain(spark, sf):
    return q.domain_violations(i.dirty(spark, sf), "event_type", ["click", "view", "purchase", "error", "signup"])


# The report's oracle follows the job's order: distinct rows, then limits, then valid rows.
@query("dq_report", f"""
WITH {i.DIRTY},
d AS (SELECT DISTINCT * FROM dirty),
m AS (SELECT * REPLACE (CASE WHEN value > 900 THEN NULL ELSE value END AS value), value > 900 AS big FROM d),
v AS (SELECT * FROM m WHERE duration > 0)
SELECT (SELECT count(*) FROM dirty) AS rows_in,
       (SELECT count(*) FROM dirty) - (SELECT count(*) FROM d) AS duplicates_removed,
       (SELECT count(*) FROM m WHERE big) AS outliers_corrected,
       (SELECT count(*) FROM d WHERE duration <= 0) AS invalid_rows_removed,
       CAST(0 AS BIGINT) AS untimed_rows_removed,
       (SELECT count(*) FILTER (value IS NULL) + count(*) FILTER (event_type IS NULL) FROM v) AS null_cells_before,
       (SELECT count(*) FILTER (value IS NULL) + count(*) FILTER (event_type IS NULL) FROM v) AS null_cells_imputable,
       CAST(0 AS BIGINT) AS null_cells_left,
       (SELECT count(*) FROM v) AS rows_out""")
def report(spark, sf):
    return quality_report(i.dirty(spark, sf), RULES)


def _some_customers(spark, sf):
    return i.table(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 0).select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment")


@query("dq_unmatched_counts", """
SELECT 'customers' AS dimension, count(*) AS unmatched FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)
UNION ALL SELECT 'suppliers', count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def unmatched(spark, sf):
    suppliers = i.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    return q.unmatched_counts(i.table(spark, sf, "events"), "user_id",
                              {"customers": _some_customers(spark, sf), "suppliers": suppliers})


@query("join_anti_missing", """
SELECT DISTINCT user_id FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0) ORDER BY 1""")
def anti_missing(spark, sf):
    return q.missing_keys(i.table(spark, sf, "events"), "user_id", _some_customers(spark, sf))


@query("dq_rowcount_preserved", """
SELECT (SELECT count(*) FROM events) AS n_before,
       (SELECT count(*) FROM events LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON user_id = c_custkey) AS n_after,
       CAST(1 AS INT) AS preserved""")
def rowcount(spark, sf):
    events = i.table(spark, sf, "events")
    return q.rowcount_report(events, attach(events, _some_customers(spark, sf), "user_id"))


@query("win_dup_members", f"""
WITH {i.DIRTY} SELECT * FROM dirty QUALIFY count(*) OVER (PARTITION BY {", ".join(i.DIRTY_COLUMNS)}) > 1""")
def dup_members(spark, sf):
    return q.duplicate_members(i.dirty(spark, sf))


@query("win_dup_rank", f"""
WITH {i.DIRTY}, n AS (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(i.DIRTY_COLUMNS)} ORDER BY event_id) AS copy_no FROM dirty)
SELECT *, CAST(copy_no > 1 AS INT) AS is_copy FROM n""")
def dup_rank(spark, sf):
    return q.mark_copies(i.dirty(spark, sf))


@query("win_dup_key_members", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
FROM lineitem QUALIFY n > 1""")
def dup_key_members(spark, sf):
    lines = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return q.duplicate_key_members(lines, ["l_orderkey", "l_linenumber"])


@query("set_distinct_rows", f"WITH {i.DIRTY} SELECT DISTINCT * FROM dirty")
def distinct_rows(spark, sf):
    return i.dirty(spark, sf).dropDuplicates()


@query("set_union_all", f"WITH {i.DIRTY} SELECT late, hour, count(*) AS n FROM dirty GROUP BY 1, 2")
def union_all(spark, sf):
    return i.dirty(spark, sf).groupBy("late", "hour").agg(F.count(F.lit(1)).alias("n"))
