"""Learning: splits, metrics, models, scoring, segmentation. Labels are planted, because the tables hold none."""

import json
from contextlib import contextmanager

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ontime.catalog import inputs as i
from ontime.catalog.q_reports import districts_of_orders, hash_sql
from ontime.catalog.registry import query
from ontime.ml import evaluate as ev
from ontime.ml import segment as sg
from ontime.ml import train as t
from ontime.ml.preprocess import zscore
from ontime.ml.score import default_order, scenarios, score
from ontime.ml.silhouette import euclidean_silhouette
from ontime.ml.spec import FeatureSpec, LeakageError, SegmentSpec
from ontime.ml.split import stratified_folds, stratified_parts, stratified_split
from ontime.ml.store import ModelStore
from ontime.operators.features import FeatureRules, above_median, order_features
from ontime.operators.integrate import attach
from ontime.operators.reports import context
from ontime.plans import training
from ontime.plans.segmentation import run_segmentation
from ontime.session import scratch_path, stage
from ontime.sources.versions import VersionedFolder
from ontime.streaming import score_stream as st

# --- rule-based label, prediction and score on orders ----------------------------------------------

RULED = """
ruled AS (
  SELECT o_orderkey, o_orderpriority,
         CAST(o_totalprice + (o_orderkey * 7919 % 97) * 2000 > 350000 AS INT) AS label,
         CAST(o_totalprice > 250000 AS INT) AS prediction,
         floor(o_totalprice / 1000) / 500 AS score
  FROM orders
)"""


def ruled(spark, sf):
    price = F.col("o_totalprice")
    return i.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority",
        (price + (F.col("o_orderkey") * 7919 % 97) * 2000 > 350000).cast("int").alias("label"),
        (price > 250000).cast("int").alias("prediction"),
        (F.floor(price / 1000) / 500).alias("score"))


_METRICS = """
  round_even((count(*) FILTER (label = prediction)) / count(*), 4) AS accuracy,
  round_even(coalesce((count(*) FILTER (label = 1 AND prediction = 1)) / nullif(count(*) FILTER (prediction = 1), 0), 0), 4) AS precision,
  round_even(coalesce((count(*) FILTER (label = 1 AND prediction = 1)) / nullif(count(*) FILTER (label = 1), 0), 0), 4) AS recall,
  round_even(coalesce(2 * (count(*) FILTER (label = 1 AND prediction = 1)) / nullif(sum(label) + sum(prediction), 0), 0), 4) AS f1"""


@query("ml_metrics", f"WITH {RULED} SELECT o_orderpriority, {_METRICS} FROM ruled GROUP BY 1")
def ml_metrics(spark, sf):
    return ev.metrics(ruled(spark, sf), by=["o_orderpriority"])


@query("ml_auc", f"""
WITH {RULED}, s AS (
  SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM ruled GROUP BY 1
), c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM s)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)), 8) AS roc_auc FROM c""")
def ml_auc(spark, sf):
    return spark.range(1).select(F.round(F.lit(ev.roc_auc(ruled(spark, sf))), 8).alias("roc_auc"))


@query("ml_confusion", f"""
WITH {RULED} SELECT label AS actual, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1
FROM ruled GROUP BY 1 ORDER BY 1""")
def ml_confusion(spark, sf):
    return ev.confusion_matrix(ruled(spark, sf))


@query("ml_gap", f"""
WITH {RULED}, a AS (
  SELECT o_orderpriority, avg(CAST(label = prediction AS INT)) FILTER (o_orderkey % 4 <> 0) AS train,
         avg(CAST(label = prediction AS INT)) FILTER (o_orderkey % 4 = 0) AS test FROM ruled GROUP BY 1)
SELECT o_orderpriority, round_even(train - test, 4) AS gap, CASE WHEN train - test > 0.1 THEN 'possible' ELSE 'not detected' END AS overfit
FROM a""")
def ml_gap(spark, sf):
    right = (F.col("label") == F.col("prediction")).cast("int")
    test = F.col("o_orderkey") % 4 == 0
    parts = ruled(spark, sf).groupBy("o_orderpriority").agg(
        F.avg(F.when(~test, right)).alias("train"), F.avg(F.when(test, right)).alias("test"))
    return parts.select("o_orderpriority", *ev.overfit(F.col("train"), F.col("test")))


@query("ml_zscore", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d, avg(c_nationkey) AS nm, stddev_pop(c_nationkey) AS nd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / d, 6) AS c_acctbal_z, round((c_nationkey - nm) / nd, 6) AS c_nationkey_z, 0.0::DOUBLE AS one_z
FROM customer, s""")
def ml_zscore(spark, sf):
    z = zscore(i.table(spark, sf, "customer").withColumn("one", F.lit(1)), ["c_acctbal", "c_nationkey", "one"])
    return z.select("c_custkey", F.round("c_acctbal_z", 6).alias("c_acctbal_z"), F.round("c_nationkey_z", 6).alias("c_nationkey_z"), "one_z")


@query("ml_onehot", """
SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS "AUTOMOBILE", CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS "BUILDING",
  CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS "FURNITURE", CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS "HOUSEHOLD" FROM customer""")
def ml_onehot(spark, sf):
    """Fitted without one of the segments, so that its rows show what an unseen category gives."""
    customers = i.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    model = Pipeline(stages=[
        StringIndexer(inputCol="c_mktsegment", outputCol="_i", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_i", outputCol="_hot", dropLast=True),
    ]).fit(customers.filter("c_mktsegment <> 'MACHINERY'"))
    hot = model.transform(customers).withColumn("_hot", vector_to_array("_hot"))
    levels = model.stages[0].labels
    return hot.select("c_custkey", *[F.col("_hot")[n].alias(level) for n, level in enumerate(levels)])


# Rounding of the test share is half up, on integers: floor(total / 4 + 1/2).
@query("ml_strat_split", f"""
WITH {RULED}, r AS (
  SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY {hash_sql("o_orderkey", 42)}) AS place,
         count(*) OVER (PARTITION BY label) AS total FROM ruled)
SELECT o_orderkey, label, CAST(place <= floor(total * 0.25 + 0.5) AS INT) AS is_test FROM r""")
def ml_strat_split(spark, sf):
    return stratified_split(ruled(spark, sf).select("o_orderkey", "label"), "label", "o_orderkey")


@query("ml_cv_folds", f"""
WITH {RULED}, r AS (
  SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY {hash_sql("o_orderkey", 42)}) AS place,
         count(*) OVER (PARTITION BY label) AS total FROM ruled)
SELECT o_orderkey, label, CAST(CASE WHEN place <= total // 5 THEN 0 WHEN place <= total * 2 // 5 THEN 1 WHEN place <= total * 3 // 5 THEN 2
  WHEN place <= total * 4 // 5 THEN 3 ELSE 4 END AS INT) AS fold FROM r""")
def ml_cv_folds(spark, sf):
    return stratified_folds(ruled(spark, sf).select("o_orderkey", "label"), "label", "o_orderkey")


@query("ml_split_and_folds", f"""
WITH {RULED}, r AS (
  SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY {hash_sql("o_orderkey", 42)}) AS place,
         count(*) OVER (PARTITION BY label) AS total FROM ruled),
s AS (SELECT *, CAST(floor(total * 0.25 + 0.5) AS BIGINT) AS t FROM r)
SELECT o_orderkey, label, CAST(CASE WHEN place <= t THEN -1 WHEN place <= t + (total - t) // 5 THEN 0 WHEN place <= t + (total - t) * 2 // 5 THEN 1
  WHEN place <= t + (total - t) * 3 // 5 THEN 2 WHEN place <= t + (total - t) * 4 // 5 THEN 3 ELSE 4 END AS INT) AS fold FROM s""")
def ml_split_and_folds(spark, sf):
    return stratified_parts(ruled(spark, sf).select("o_orderkey", "label"), "label", "o_orderkey")


# --- orders with a planted label -------------------------------------------------------------------

SPEC = FeatureSpec(
    operational=("items", "n_lines", "value", "hour", "dow", "experience_months", "is_rush_hour", "is_weekend",
                 "value_per_item", "is_novice"),
    external=("density", "is_dense_district", "temperature_c", "humidity_pct", "wind_kmh"),
    categorical=("district", "segment", "priority", "status"),
    external_categorical=("class",),
    target="late",
    id="order_id",
    post_event=("minutes",),
)
FEATURES = FeatureRules()


def raw_orders(spark, sf):
    """Orders with their line totals and customer, before any external column. Read several times, so staged."""
    lines = i.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("items"), F.count(F.lit(1)).alias("n_lines"))
    orders, customers, nations = (i.table(spark, sf, n) for n in ("orders", "customer", "nation"))
    joined = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").fillna({"items": 0.0, "n_lines": 0})
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("order_id"), "items", F.col("n_lines").cast("double").alias("n_lines"),
            F.col("o_totalprice").alias("value"), F.pmod("o_orderkey", F.lit(24)).cast("int").alias("hour"),
            (F.weekday("o_orderdate") + 1).alias("dow"), F.pmod("o_custkey", F.lit(61)).cast("int").alias("experience_months"),
            F.col("n_name").alias("district"), F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    )
    return stage(joined, "orders")


def planted(df):
    """Minutes from a made-up formula with a pseudo-random part, and the label late = minutes > 45."""
    minutes = (
        F.lit(15.0) + F.col("n_lines") * 4 + F.when(F.col("dow") >= 6, 8.0).otherwise(0.0)
        + F.when(F.col("segment") == "MACHINERY", 6.0).otherwise(0.0) + F.pmod(F.col("order_id") * 6151, F.lit(101)) / 101 * 20
    )
    return df.withColumn("minutes", minutes).withColumn("late", (F.col("minutes") > 45).cast("int"))


def external_columns(spark, sf):
    dims = i.district_dim(spark, sf).select("district", "density", F.concat(F.lit("R"), F.col("region_key").cast("string")).alias("class"))
    weather = i.weather_dim(spark, sf).select(
        "district", "temperature_c", F.col("humidity_pct").cast("double").alias("humidity_pct"), "wind_kmh")
    return i.reference(dims.join(weather, "district").fillna({"density": 0.0}))


def model_orders(spark, sf, raw=None):
    raw = raw if raw is not None else raw_orders(spark, sf)
    df = attach(order_features(raw, FEATURES), external_columns(spark, sf), "district")
    return planted(above_median(df, "density", "is_dense_district")).fillna({"value_per_item": 0.0})


EXTERNAL = ["density", "is_dense_district", "class", "temperature_c", "humidity_pct", "wind_kmh"]


@contextmanager
def split(orders, spec=SPEC, folds=t.FOLDS):
    """Training and test rows of the planted orders, released when the query has its numbers."""
    parts = training.split_orders(orders, spec, folds=folds)
    try:
        yield parts
    finally:
        parts.close()


ONE_MODEL = ("model string, params string, accuracy double, precision double, recall double, f1 double, "
             "roc_auc double, accuracy_train double, gap double, overfit string")


def one_row(spark, name, params, result):
    return spark.createDataFrame([{"model": name, "params": json.dumps(params), **result}], ONE_MODEL)


@query("ml_train_lr")
def ml_train_lr(spark, sf):
    with split(model_orders(spark, sf)) as s:
        model = t.fit(t.logistic(s.n), s.train, SPEC, s.n)
        return one_row(spark, "logistic_regression", {"maxIter": 1000}, ev.evaluate(model.transform(s.train), model.transform(s.test)))


def best_of_grid(spark, sf, name, **grids):
    with split(model_orders(spark, sf)) as s:
        run = t.grid_search(s.parts, SPEC, **grids)
        best = run.best(name)
        return one_row(spark, name, best.params, ev.evaluate(training.tree_scores(run, best, False), training.tree_scores(run, best, True)))


@query("ml_train_tree")
def ml_train_tree(spark, sf):
    """The best tree of the whole grid, refit on all training rows."""
    return best_of_grid(spark, sf, "decision_tree", tree_grid=t.TREE_GRID)


@query("ml_train_forest")
def ml_train_forest(spark, sf):
    """The best forest of the whole grid, refit on all training rows."""
    return best_of_grid(spark, sf, "random_forest", forest_grid=t.FOREST_GRID)


@query("ml_grid_search")
def ml_grid_search(spark, sf):
    """All 18 settings of both grids on five folds."""
    with split(model_orders(spark, sf)) as s:
        run = t.grid_search(s.parts, SPEC, t.TREE_GRID, t.FOREST_GRID)
        best = {run.best(name).place for name in ("decision_tree", "random_forest")}
        rows = [(p.model, p.params["maxDepth"], p.params.get("minInstancesPerNode"), p.params.get("numTrees"), round(p.f1, 4),
                 round(p.deviation, 4), int(p.place in best)) for p in run.points]
        return spark.createDataFrame(rows, "model string, maxDepth int, minInstancesPerNode int, numTrees int, f1 double, f1_std double, best int")


@query("job_train")
def job_train(spark, sf):
    """The whole training job with its full grids; what it stored is read back."""
    root = scratch_path(spark, "late-model")
    training.run_training(model_orders(spark, sf), SPEC, root)
    return ModelStore(spark, root).table("results", training.RESULT)


# --- saturated models: one category says all a model can know, so every model must answer its group's rate ---------------

SATURATED = """
sat AS (
  SELECT o_orderkey, o_orderpriority, CAST((o_orderkey * 7919) % 100 < CASE left(o_orderpriority, 1)
    WHEN '1' THEN 90 WHEN '2' THEN 75 WHEN '3' THEN 30 WHEN '4' THEN 20 ELSE 10 END AS INT) AS late FROM orders
), placed AS (
  SELECT o_orderkey, o_orderpriority, late, row_number() OVER (PARTITION BY late ORDER BY {hash}) AS place,
         count(*) OVER (PARTITION BY late) AS total FROM sat
), cut AS (SELECT *, CAST(floor(total * 0.25 + 0.5) AS BIGINT) AS t FROM placed
), parts AS (
  SELECT o_orderkey, o_orderpriority, late, CASE WHEN place <= t THEN -1 WHEN place <= t + (total - t) // 5 THEN 0
    WHEN place <= t + (total - t) * 2 // 5 THEN 1 WHEN place <= t + (total - t) * 3 // 5 THEN 2
    WHEN place <= t + (total - t) * 4 // 5 THEN 3 ELSE 4 END AS fold FROM cut
), rates AS (SELECT o_orderpriority, avg(late) AS rate FROM parts WHERE fold >= 0 GROUP BY 1
), scored AS (SELECT late, fold, rate, CAST(rate > 0.5 AS INT) AS called FROM parts JOIN rates USING (o_orderpriority)
), m AS (
  SELECT fold < 0 AS tested, avg(CAST(late = called AS INT)) AS accuracy, (sum(late * called))::DOUBLE / sum(called) AS precision,
         (sum(late * called))::DOUBLE / sum(late) AS recall, 2.0 * sum(late * called) / (sum(late) + sum(called)) AS f1 FROM scored GROUP BY 1
), ranked AS (SELECT rate, sum(late) AS pos, count(*) - sum(late) AS neg FROM scored WHERE fold < 0 GROUP BY 1
), below AS (SELECT *, sum(neg) OVER (ORDER BY rate) - neg AS less FROM ranked
), auc AS (SELECT sum(pos * (less + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc FROM below
), fold_rates AS (
  SELECT i.fold, p.o_orderpriority, avg(p.late) AS rate FROM (SELECT DISTINCT fold FROM parts WHERE fold >= 0) i
  JOIN parts p ON p.fold >= 0 AND p.fold <> i.fold GROUP BY 1, 2
), by_fold AS (
  SELECT p.fold, 2.0 * sum(late * CAST(rate > 0.5 AS INT)) / (sum(late) + sum(CAST(rate > 0.5 AS INT))) AS f1
  FROM parts p JOIN fold_rates r ON p.fold = r.fold AND p.o_orderpriority = r.o_orderpriority GROUP BY 1
), cv AS (SELECT avg(f1) AS mean, stddev_pop(f1) AS deviation FROM by_fold)""".replace("{hash}", hash_sql("o_orderkey", 42))

SATURATED_SPEC = FeatureSpec(("one",), (), ("priority",), "late", "order_id")


def saturated_orders(spark, sf):
    share = F.when(F.left("o_orderpriority", F.lit(1)) == "1", 90)
    for level, value in (("2", 75), ("3", 30), ("4", 20)):
        share = share.when(F.left("o_orderpriority", F.lit(1)) == level, value)
    return i.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"), F.lit(1.0).alias("one"),
        ((F.col("o_orderkey") * 7919) % 100 < share.otherwise(10)).cast("int").alias("late"))


@query("job_train_saturated", f"""
WITH {SATURATED}
SELECT model, CAST(model = 'logistic_regression' AS INT) AS best, round_even(e.accuracy, 4) AS accuracy, round_even(e.precision, 4) AS precision,
  round_even(e.recall, 4) AS recall, round_even(e.f1, 4) AS f1, round_even(roc_auc, 4) AS roc_auc, round_even(r.accuracy, 4) AS accuracy_train,
  round_even(r.accuracy - e.accuracy, 4) AS gap, 'not detected' AS overfit, params,
  CASE WHEN model <> 'logistic_regression' THEN round_even(mean, 4) END AS f1_cv
FROM (VALUES ('logistic_regression', '{{"maxIter": 1000}}'), ('decision_tree', '{{"maxDepth": 4, "minInstancesPerNode": 1}}'),
  ('random_forest', '{{"maxDepth": 10, "numTrees": 100}}')) v(model, params), m e, m r, auc, cv WHERE e.tested AND NOT r.tested""")
def job_train_saturated(spark, sf):
    """The training job on orders whose priority is all there is to know: full grids, five folds, stored and read back."""
    root = scratch_path(spark, "saturated-model")
    training.run_training(saturated_orders(spark, sf), SATURATED_SPEC, root)
    return ModelStore(spark, root).table("results", training.RESULT)


@query("ml_cv_saturated", f"""
WITH {SATURATED}
SELECT 'fold ' || fold AS part, round_even(f1, 4) AS f1 FROM by_fold
UNION ALL SELECT 'mean', round_even(mean, 4) FROM cv UNION ALL SELECT 'std', round_even(deviation, 4) FROM cv""")
def ml_cv_saturated(spark, sf):
    with split(saturated_orders(spark, sf), SATURATED_SPEC) as s:
        scores = t.cross_validate(t.logistic, s.train, SATURATED_SPEC)
        mean, deviation = t.mean_and_deviation(scores)
        rows = [(f"fold {n}", round(f1, 4)) for n, f1 in enumerate(scores)]
        return spark.createDataFrame([*rows, ("mean", round(mean, 4)), ("std", round(deviation, 4))], "part string, f1 double")


@query("ml_model_roundtrip", f"""
WITH {SATURATED}
SELECT o_orderkey AS order_id, round(rate, 6) AS late_probability, CAST(rate >= 0.5 AS INT) AS at_risk, 1 AS same_after_reload, 1::BIGINT AS versions
FROM parts JOIN rates USING (o_orderpriority)""")
def ml_model_roundtrip(spark, sf):
    """A stored tree scores as before it was stored, and a save that fails half way changes nothing."""
    orders = saturated_orders(spark, sf)
    with split(orders, SATURATED_SPEC) as s:
        run = t.grid_search(s.parts, SATURATED_SPEC, {"maxDepth": [4], "minInstancesPerNode": [1]})
        model = run.grown.model(run.best("decision_tree").place)
    store = ModelStore(spark, scratch_path(spark, "tree"))
    store.save(model)
    broken = orders.select(F.raise_error(F.lit("broken off")).cast("string").alias("x"))
    try:
        store.save(model, {"report": broken})
    except Exception as error:  # noqa: BLE001
        if "broken off" not in str(error):
            raise
    before = score(orders, model).select("order_id", F.col("late_probability").alias("p"))
    after = score(orders, store.load()).join(before, "order_id")
    return after.select("order_id", F.round("late_probability", 6).alias("late_probability"), "at_risk",
                        (F.col("late_probability") == F.col("p")).cast("int").alias("same_after_reload"),
                        F.lit(len(store.folder.history())).cast("long").alias("versions"))


@query("ml_cross_validate")
def ml_cross_validate(spark, sf):
    with split(model_orders(spark, sf)) as s:
        scores = t.cross_validate(t.logistic, s.train, SPEC)
        mean, deviation = t.mean_and_deviation(scores)
        rows = [(f"fold {n}", round(f1, 4)) for n, f1 in enumerate(scores)]
        return spark.createDataFrame([*rows, ("mean", round(mean, 4)), ("std", round(deviation, 4))], "part string, f1 double")


@query("ml_ablation")
def ml_ablation(spark, sf):
    with split(model_orders(spark, sf)) as s:
        return spark.createDataFrame([training.ablation(s, SPEC)],
                                     "f1_operational_only double, f1_with_external double, difference double")


@query("ml_top_features")
def ml_top_features(spark, sf):
    with split(model_orders(spark, sf)) as s:
        model = t.fit(t.logistic(s.n), s.train, SPEC, s.n)
        top = ev.top_features(model, SPEC, model.transform(s.train))
        return top.select("feature", F.round("weight", 4).alias("weight"))


def fitted_model(orders):
    with split(orders) as s:
        return t.fit(t.logistic(s.n), s.train, SPEC, s.n)


@query("ml_score")
def ml_score(spark, sf):
    orders = model_orders(spark, sf)
    scored = score(orders, fitted_model(orders))
    return scored.select("order_id", "late", F.round("late_probability", 6).alias("late_probability"), "at_risk")


@query("ml_scenarios")
def ml_scenarios(spark, sf):
    """Every order as it is, as an urgent one, and from a new courier at rush hour: mean risk per district."""
    raw = raw_orders(spark, sf)
    orders = model_orders(spark, sf, raw)
    asked = scenarios(
        raw,
        {"as is": {}, "urgent": {"priority": "1-URGENT"}, "new courier, rush hour": {"experience_months": 1, "hour": 20}},
        FEATURES, i.reference(context(orders, "district", EXTERNAL)), "district").fillna({"value_per_item": 0.0})
    scored = score(asked, fitted_model(orders))
    return scored.groupBy("district", "scenario").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("late_probability"), 4).alias("late_probability"),
        F.sum("at_risk").alias("n_at_risk")).orderBy("district", "scenario")


@query("st_score_stream")
def st_score_stream(spark, sf):
    """New orders arrive as files; each is enriched, scored and appended once."""
    incoming = scratch_path(spark, "incoming")
    raw = raw_orders(spark, sf)
    raw.write.parquet(incoming)
    orders = model_orders(spark, sf, raw)
    known = i.reference(context(orders, "district", EXTERNAL))
    scored, unscored = scratch_path(spark, "scored"), scratch_path(spark, "unscored")
    st.score_stream_to(st.read_orders(spark, incoming, raw.schema), fitted_model(orders), lambda: known, "district", scored, unscored,
                       scratch_path(spark, "offsets"), FEATURES, {"value_per_item": 0.0}, ["order_id"]).awaitTermination()
    return spark.read.schema("order_id long, late_probability double, at_risk int").parquet(f"{scored}/batch=*") \
        .select("order_id", F.round("late_probability", 6).alias("late_probability"), "at_risk")


def saturated_tree(spark, sf):
    """A tree that knows the rate of every priority."""
    orders = saturated_orders(spark, sf)
    with split(orders, SATURATED_SPEC) as s:
        run = t.grid_search(s.parts, SATURATED_SPEC, {"maxDepth": [4], "minInstancesPerNode": [1]})
        return orders, run.grown.model(run.best("decision_tree").place)


@query("st_two_sinks", f"""
WITH {SATURATED}
SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority <> '5-LOW' THEN round(rate, 6) END AS late_probability,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(rate >= 0.5 AS INT) END AS at_risk,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'scored' ELSE 'unscored' END AS sink
FROM parts JOIN rates USING (o_orderpriority)""")
def st_two_sinks(spark, sf):
    """Orders with and without a context in two tables; a batch that is played again adds nothing."""
    orders, model = saturated_tree(spark, sf)
    incoming, scored, unscored = (scratch_path(spark, n) for n in ("incoming", "scored", "unscored"))
    orders.select("order_id", "priority").repartition(4).write.parquet(incoming)
    known = i.reference(orders.where("priority <> '5-LOW'").select("priority").distinct().withColumn("one", F.lit(1.0)))
    rows = st.read_orders(spark, incoming, spark.read.parquet(incoming).schema, files_per_batch=2)
    st.score_stream_to(rows, model, lambda: known, "priority", scored, unscored, scratch_path(spark, "offsets"), columns=["order_id"]).awaitTermination()
    again = spark.read.parquet(f"{scored}/batch=0").select("order_id").unionByName(spark.read.parquet(f"{unscored}/batch=0").select("order_id"))
    replayed = stage(spark.read.parquet(incoming).join(again, "order_id"), "replayed")
    st.score_batch(replayed, 0, model, lambda: known, "priority", scored, unscored, columns=["order_id"])
    done = spark.read.parquet(f"{scored}/batch=*").select("order_id", F.round("late_probability", 6).alias("late_probability"), "at_risk", F.lit("scored").alias("sink"))
    rest = spark.read.parquet(f"{unscored}/batch=*").select("order_id", F.lit(None).cast("double"), F.lit(None).cast("int"), F.lit("unscored"))
    return done.unionAll(rest)


@query("ml_scenarios_saturated", f"""
WITH {SATURATED}, s AS (
  SELECT 'as is' AS scenario, rate FROM parts JOIN rates USING (o_orderpriority)
  UNION ALL SELECT 'urgent', r.rate FROM parts, rates r WHERE r.o_orderpriority = '1-URGENT')
SELECT scenario, count(*) AS n, round(avg(rate), 6) AS late_probability, sum(CAST(rate >= 0.5 AS INT))::BIGINT AS n_at_risk FROM s GROUP BY 1""")
def ml_scenarios_saturated(spark, sf):
    orders, model = saturated_tree(spark, sf)
    scored = score(scenarios(orders, {"as is": {}, "urgent": {"priority": "1-URGENT"}}), model)
    return scored.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("late_probability"), 6).alias("late_probability"),
                                          F.sum("at_risk").alias("n_at_risk"))


RAW = """
raw AS (
  SELECT o_orderkey AS order_id, coalesce(items, 0) AS items, coalesce(n_lines, 0)::DOUBLE AS n_lines, o_totalprice AS value,
    CAST(o_orderkey % 24 AS INT) AS hour, CAST(isodow(o_orderdate) AS INT) AS dow, CAST(o_custkey % 61 AS INT) AS experience_months,
    n_name AS district, c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS items, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_TOP = "(SELECT {0} FROM raw GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("ml_default_scenario", f"""
WITH {RAW}, {i.DISTRICTS}, base AS (
  SELECT median(items) AS items, median(value) AS value, round_even(median(hour), 0)::INT AS hour, round_even(median(dow), 0)::INT AS dow,
    round_even(median(experience_months), 0)::INT AS experience_months, {_TOP.format("segment")} AS segment, {_TOP.format("priority")} AS priority FROM raw
), s(scenario, new_hour, new_priority, new_months) AS (VALUES ('as usual', NULL, NULL, NULL), ('rush hour', 20, NULL, NULL), ('urgent, new courier', NULL, '1-URGENT', 1)
), made AS (
  SELECT scenario, items, value, coalesce(new_hour, hour) AS hour, dow, coalesce(new_months, experience_months) AS experience_months, segment,
    coalesce(new_priority, priority) AS priority FROM base, s)
SELECT scenario, d.district, items, value, hour, dow, experience_months, segment, priority, CAST(hour IN (13, 14, 20, 21) AS INT) AS is_rush_hour,
  CAST(dow >= 6 AS INT) AS is_weekend, round_even(value / items, 0) AS value_per_item, CAST(experience_months < 6 AS INT) AS is_novice, density
FROM made, district_dim d""")
def ml_default_scenario(spark, sf):
    """What-if orders that start from the usual one, in every district, with features and context derived again."""
    raw = raw_orders(spark, sf)
    usual = default_order(raw, ["items", "value", "hour", "dow", "experience_months"], ["segment", "priority"])
    places = i.reference(i.district_dim(spark, sf).select("district", "density"))
    each = usual.join(places.select("district"))  # one usual order for each district
    asked = scenarios(each, {"as usual": {}, "rush hour": {"hour": 20}, "urgent, new courier": {"priority": "1-URGENT", "experience_months": 1}},
                      FEATURES, places, "district")
    return asked.select("scenario", "district", "items", "value", "hour", "dow", "experience_months", "segment", "priority", "is_rush_hour",
                        "is_weekend", "value_per_item", "is_novice", "density")


@query("ml_feature_catalog", f"""
WITH {RAW} SELECT 'items' AS feature, 'number' AS kind, 'operational' AS origin, count(items) AS n FROM raw
UNION ALL SELECT 'value', 'number', 'operational', count(value) FROM raw UNION ALL SELECT 'segment', 'category', 'operational', count(segment) FROM raw
UNION ALL SELECT 'district', 'category', 'external', count(district) FROM raw
UNION ALL SELECT 'late', 'refused', 'target', count(*) FROM raw UNION ALL SELECT 'minutes', 'refused', 'known afterwards', count(*) FROM raw""")
def ml_feature_catalog(spark, sf):
    """Columns a model may learn from, with their values, and those that the guard refuses."""
    orders = planted(raw_orders(spark, sf))
    spec = FeatureSpec(("items", "value"), (), ("segment",), "late", "order_id", ("minutes",), ("district",))
    rows = [(c, "number" if c in spec.numeric else "category", "external" if c in (*spec.external, *spec.external_categorical) else "operational") for c in spec.features]
    for column, why in (("late", "target"), ("minutes", "known afterwards")):
        try:
            FeatureSpec(("items", column), (), (), "late", "order_id", ("minutes",))
        except LeakageError:
            rows.append((column, "refused", why))
    counted = orders.agg(*[F.count(c).alias(c) for c, _, _ in rows]).unpivot([], [c for c, _, _ in rows], "feature", "n")
    return spark.createDataFrame(rows, "feature string, kind string, origin string").join(counted, "feature")


ROOT_SPEC = FeatureSpec(("n_lines", "dow", "hour"), (), ("segment", "priority"), "late", "order_id", ("minutes",))


@query("ml_tree_root", f"""
WITH {RAW}, labelled AS (
  SELECT *, CAST(15.0::DOUBLE + n_lines * 4 + CASE WHEN dow >= 6 THEN 8.0::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN segment = 'MACHINERY' THEN 6.0::DOUBLE ELSE 0.0::DOUBLE END + ((order_id * 6151) % 101) / 101 * 20 > 45 AS INT) AS late FROM raw
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY late ORDER BY {hash_sql("order_id", 42)}) AS place, count(*) OVER (PARTITION BY late) AS total FROM labelled
), train AS (SELECT * FROM placed WHERE place > CAST(floor(total * 0.25 + 0.5) AS BIGINT)
), numbers AS (UNPIVOT (SELECT late, n_lines, dow::DOUBLE AS dow, hour::DOUBLE AS hour FROM train) ON n_lines, dow, hour INTO NAME feature VALUE x
), cells AS (SELECT feature, x, sum(late) AS late, count(*) AS n FROM numbers GROUP BY 1, 2
), levels AS (UNPIVOT (SELECT late, segment, priority FROM train) ON segment, priority INTO NAME feature VALUE level
), whole AS (SELECT sum(late)::DOUBLE AS late, count(*)::DOUBLE AS n FROM train
), sides AS (
  SELECT feature, x AS cut, sum(late) OVER w AS late, sum(n) OVER w AS n FROM cells WINDOW w AS (PARTITION BY feature ORDER BY x)
  UNION ALL SELECT feature || '_' || level, NULL, (SELECT late FROM whole) - sum(late), (SELECT n FROM whole) - count(*) FROM levels GROUP BY feature, level
), judged AS (
  SELECT feature, cut, s.late / s.n AS share_left, (w.late - s.late) / (w.n - s.n) AS share_right,
    2 * s.late * (s.n - s.late) / s.n + 2 * (w.late - s.late) * ((w.n - w.late) - (s.n - s.late)) / (w.n - s.n) AS impurity
  FROM sides s, whole w WHERE s.n < w.n
)
SELECT feature, cut, round(share_left, 6) AS share_left, round(share_right, 6) AS share_right FROM judged ORDER BY impurity, feature LIMIT 1""")
def ml_tree_root(spark, sf):
    """The first split of a tree whose numbers have a bin for every value: the best of all cuts there are."""
    with split(planted(raw_orders(spark, sf)), ROOT_SPEC) as s:
        run = t.grid_search(s.parts, ROOT_SPEC, {"maxDepth": [1], "minInstancesPerNode": [1]})
        model = run.grown.model(run.best("decision_tree").place)
    encoding, f = model.encoding, int(model.feature[0])
    cut = float(encoding.cuts[f][int(model.cut[0])]) if f < len(encoding.numeric) else None
    left = int(model.left[0])
    return spark.createDataFrame([(encoding.features()[f], cut, round(float(model.share[left]), 6), round(float(model.share[left + 1]), 6))],
                                 "feature string, cut double, share_left double, share_right double")


# --- segmentation ----------------------------------------------------------------------------------

SEGMENTS = SegmentSpec(
    variables=("population", "area", "density", "temperature_c", "humidity_pct", "wind_kmh"),
    descriptive=("n_orders", "late_rate", "mean_items", "mean_lead"),
    label_columns=("late", "late_rate", "lead_days"),
)


def segment_input(spark, sf):
    return attach(districts_of_orders(spark, sf), i.reference(i.weather_dim(spark, sf)), "district").fillna({"density": 0.0})


def segment_features(spark, sf, variables=SEGMENTS.variables):
    return sg.scaled_features(segment_input(spark, sf), variables)


@query("ml_kmeans")
def ml_kmeans(spark, sf):
    features = segment_features(spark, sf)
    model = sg.kmeans(features, 2)
    named = sg.name_segments(model.transform(features), "prediction", "density", ("low density", "high density"))
    return named.select("district", "segment", "population", "area", "density")


@query("ml_k_sweep")
def ml_k_sweep(spark, sf):
    features = segment_features(spark, sf)
    table = sg.k_sweep(features, "district_key", sg.best_kmeans(features, (2, 3, 4, 5, 6)), exact=True)
    return spark.createDataFrame(table, "k int, inertia double, silhouette double, metric string")


@query("ml_pca")
def ml_pca(spark, sf):
    placed, shares = sg.principal_components(segment_features(spark, sf))
    return placed.select("district", F.round("PC1", 4).alias("PC1"), F.round("PC2", 4).alias("PC2"),
                         F.lit(round(shares[0], 4)).alias("share_1"), F.lit(round(shares[1], 4)).alias("share_2"))


@query("ml_pca_two", """
WITH z AS (SELECT c_custkey, c_acctbal, c_acctbal + (c_custkey * 7919 % 5000) AS other FROM customer),
m AS (SELECT avg(c_acctbal) AS a, stddev_pop(c_acctbal) AS sa, avg(other) AS b, stddev_pop(other) AS sb, corr(c_acctbal, other) AS r FROM z)
SELECT c_custkey, round(((c_acctbal - a) / sa + (other - b) / sb) / sqrt(2), 6) AS "PC1", round(abs((c_acctbal - a) / sa - (other - b) / sb) / sqrt(2), 6) AS "PC2",
  round((1 + r) / 2, 6) AS share_1, round((1 - r) / 2, 6) AS share_2 FROM z, m""")
def ml_pca_two(spark, sf):
    """Of two z-scores the components are their sum and difference; the second one's sign is free."""
    df = i.table(spark, sf, "customer").select("c_custkey", "c_acctbal", (F.col("c_acctbal") + F.col("c_custkey") * 7919 % 5000).alias("other"))
    placed, shares = sg.principal_components(sg.scaled_features(df, ("c_acctbal", "other")))
    return placed.select("c_custkey", F.round("PC1", 6).alias("PC1"), F.round(F.abs("PC2"), 6).alias("PC2"),
                         F.lit(round(shares[0], 6)).alias("share_1"), F.lit(round(shares[1], 6)).alias("share_2"))


@query("ml_kmeans_planted", """
WITH p AS (SELECT c_custkey, c_custkey % 4 AS g, c_custkey % 4 * 100 + c_acctbal / 1000 AS x, (c_custkey % 4) % 2 * 50 + (c_custkey * 31 % 7) AS y FROM customer),
m AS (SELECT g, avg(x) AS mean FROM p GROUP BY 1), o AS (SELECT g, row_number() OVER (ORDER BY mean) AS place FROM m)
SELECT c_custkey, 'segment ' || place AS segment FROM p JOIN o USING (g)""")
def ml_kmeans_planted(spark, sf):
    """Four groups far apart: the best clustering is known."""
    g = F.col("c_custkey") % 4
    df = i.table(spark, sf, "customer").select(
        "c_custkey", (g * 100 + F.col("c_acctbal") / 1000).alias("x"), (g % 2 * 50 + F.col("c_custkey") * 31 % 7).cast("double").alias("y"))
    features = sg.scaled_features(df, ("x", "y"))
    return sg.name_segments(sg.kmeans(features, 4, starts=20).transform(features), "prediction", "x", ()).select("c_custkey", "segment")


@query("job_segment")
def job_segment(spark, sf):
    """The whole segmentation job; the profile it stored is read back."""
    root = scratch_path(spark, "segments")
    run_segmentation(segment_input(spark, sf), "district", "district_key", SEGMENTS, "density", "late_rate", root, exact=True)
    schema = ("segment string, n_districts long, population double, area double, density double, temperature_c double, humidity_pct double, wind_kmh double, "
              "n_orders double, mean_items double, mean_lead double, late_rate double, districts string")
    return spark.read.schema(schema).json(f"{VersionedFolder(spark, root).current()}/profile")


@query("ml_silhouette", """
WITH d AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, sqrt(sum(power(x.a - x.b, 2))) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id,
       LATERAL (SELECT unnest(a.embedding)::DOUBLE AS a, unnest(b.embedding)::DOUBLE AS b) x
  GROUP BY 1, 2, 3, b.vec_id
), m AS (SELECT vec_id, own, other, avg(dist) AS mean FROM d GROUP BY ALL),
s AS (SELECT vec_id, max(mean) FILTER (own = other) AS a, min(mean) FILTER (own <> other) AS b FROM m GROUP BY 1)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n FROM s""")
def ml_silhouette(spark, sf):
    result = euclidean_silhouette(i.table(spark, sf, "embeddings"), "vec_id", "label", "embedding")
    return result.select(F.round("silhouette", 6).alias("silhouette"), "n")


@query("ml_design_compare")
def ml_design_compare(spark, sf):
    """Best silhouette of three designs, k from 2 to 6: orders, districts with operational columns, districts without."""
    k_range, rows = (2, 3, 4, 5, 6), []
    orders = sg.scaled_features(raw_orders(spark, sf), ("items", "value", "hour", "experience_months"))
    designs = [("orders", orders, "order_id", 10, False)]
    for name, variables in (("districts, operational and external", [*SEGMENTS.variables, "n_orders", "mean_items"]),
                            ("districts, external only", SEGMENTS.variables)):
        designs.append((name, segment_features(spark, sf, variables), "district_key", sg.STARTS, True))
    for name, features, key, starts, exact in designs:
        table = sg.k_sweep(features, key, sg.best_kmeans(features, k_range, starts), exact)
        chosen = next(r for r in table if r["k"] == sg.choose_k(table))
        rows.append((name, chosen["k"], chosen["silhouette"], chosen["metric"]))
    return spark.createDataFrame(rows, "design string, k int, silhouette double, metric string")
