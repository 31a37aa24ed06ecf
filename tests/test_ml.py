import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ontime.functions.numeric import density
from ontime.ml import evaluate as ev
from ontime.ml import segment as sg
from ontime.ml import train as t
from ontime.ml.preprocess import feature_names, preprocessor, zscore
from ontime.ml.score import scenarios, score
from ontime.ml.silhouette import euclidean_silhouette, parts_of
from ontime.ml.spec import FeatureSpec, SegmentSpec
from ontime.ml.split import stratified_folds, stratified_parts, stratified_split
from ontime.ml.store import ModelStore
from ontime.operators.features import FeatureRules
from ontime.plans import training
from ontime.plans.segmentation import run_segmentation, segment_districts
from ontime.plans.training import split_orders, train_and_compare
from ontime.streaming.score_stream import read_orders, score_stream, write_scores
from ontime.sources.versions import VersionedFolder
from tests.fixtures import districts, weather

VARIABLES = ("population", "area_km2", "density", "temperature_c", "humidity_pct", "wind_kmh")

# Members of the best clusterings of the 14 districts.
EXTENSIVE = {"La Florida", "Las Condes", "Maipú", "Peñalolén", "Puente Alto"}
FOUR = [{"La Florida", "Las Condes", "Peñalolén", "Puente Alto"}, {"Maipú"},
        {"Estación Central", "Macul", "San Miguel", "Ñuñoa"},
        {"Independencia", "Providencia", "Recoleta", "Santiago Centro", "Vitacura"}]
SIX = [{"La Florida", "Las Condes", "Peñalolén", "Puente Alto"}, {"Maipú"}, {"Estación Central"}, {"Santiago Centro"},
       {"Macul", "San Miguel", "Ñuñoa"}, {"Independencia", "Providencia", "Recoleta", "Vitacura"}]


@pytest.fixture(scope="module")
def places(spark):
    df = districts(spark).join(weather(spark), "district").withColumn("density", density(F.col("population"), F.col("area_km2")))
    return df.withColumn("key", F.xxhash64("district")).withColumn("late_rate", F.lit(0.38)).withColumn("n_orders", F.lit(10))


@pytest.fixture(scope="module")
def features(places):
    return sg.scaled_features(places, VARIABLES)


def members(df, column="prediction"):
    groups = {}
    for r in df.collect():
        groups.setdefault(r[column], set()).add(r["district"])
    return sorted(map(sorted, groups.values()))


def test_zscore(spark, places):
    z = zscore(places.withColumn("one", F.lit(3)), ["population", "one"])
    row = z.agg(F.avg("population_z"), F.stddev_pop("population_z"), F.max("one_z")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_sweep_reproduces_known_values(features):
    models = sg.best_kmeans(features, (2, 3, 4, 5, 6))
    table = {r["k"]: r for r in sg.k_sweep(features, "key", models, exact=True)}
    assert [table[k]["inertia"] for k in (2, 3, 4, 5, 6)] == [50.86, 38.12, 26.81, 20.55, 14.30]
    assert [table[k]["silhouette"] for k in (2, 3, 4, 5, 6)] == pytest.approx([0.3308, 0.3147, 0.2894, 0.3007, 0.2996], abs=1e-4)
    assert sorted(EXTENSIVE) in members(models[2].transform(features))
    squared = {r["k"]: r["silhouette"] for r in sg.k_sweep(features, "key", {2: models[2]})}
    assert squared[2] == pytest.approx(0.5119, abs=1e-4)


@pytest.mark.parametrize("groups, inertia, silhouette", [(FOUR, 26.81, 0.2894), (SIX, 14.30, 0.2996)])
def test_fixed_memberships(features, groups, inertia, silhouette):
    cluster = F.lit(None).cast("int")
    for n, group in enumerate(groups):
        cluster = F.when(F.col("district").isin(list(group)), F.lit(n)).otherwise(cluster)
    df = features.withColumn("c", cluster).withColumn("x", vector_to_array("features"))
    for block in (2_000, 5):  # one block, and several blocks that must add up to the same
        got = euclidean_silhouette(df, "key", "c", "x", block=block).first()
        assert got["silhouette"] == pytest.approx(silhouette, abs=1e-4) and got["n"] == 14
    rows = df.select("c", "x").collect()
    cost = 0.0
    for n in range(len(groups)):
        points = [r["x"] for r in rows if r["c"] == n]
        centre = [sum(v) / len(points) for v in zip(*points)]
        cost += sum((a - b) ** 2 for p in points for a, b in zip(p, centre))
    assert cost == pytest.approx(inertia, abs=0.01)


def test_pca(features):
    placed, shares = sg.principal_components(features)
    assert [round(s, 4) for s in shares] == [0.4487, 0.2469] and placed.count() == 14


def test_segment_districts(places):
    spec = SegmentSpec(VARIABLES, ("n_orders", "late_rate"), ("late", "late_rate"))
    result = segment_districts(places, "district", "key", spec, "density", "late_rate", exact=True)
    assert result.report["k"] == 2 and result.report["pca"]["total"] == 0.6956
    low, high = sorted(result.profile.collect(), key=lambda r: r["density"])
    assert (low["area_km2"], low["density"]) == (89.6, 4576.9) and (high["area_km2"], high["density"]) == (15.8, 10820.5)
    assert low["districts"] == ", ".join(sorted(EXTENSIVE)) and low["segment"].startswith("wide")
    assert {r["variable"]: r["cv"] for r in result.homogeneity.collect()}["late_rate"] == 0.0


def test_all_starts_move_as_each_would_alone(spark):
    """Centres and costs after joint steps against plain Lloyd steps; an empty cluster keeps its centre."""
    import numpy as np
    draw = np.random.default_rng(3)
    x = draw.normal(0, 1, (700, 2)) + draw.integers(0, 3, (700, 1)) * 3
    df = spark.createDataFrame([(n, float(a), float(b)) for n, (a, b) in enumerate(x)], "id long, a double, b double").repartition(3)
    features = sg.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    for k, model in sg.best_kmeans(features, (2, 4), starts=5).items():
        distance = ((x[:, None] - model.centres[None]) ** 2).sum(2)
        assert model.cost == pytest.approx(distance.min(1).sum()) and model.steps < 100
        own = distance.argmin(1)
        assert np.allclose(model.centres, [x[own == c].mean(0) for c in range(k)], atol=1e-3)
        assert [r[0] for r in model.transform(features).orderBy("id").select("prediction").collect()] == own.tolist()
    same = sg.VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.range(5).select(F.lit(1.0).alias("a")))
    assert sg.kmeans(same, 3, starts=2).cost == 0.0


def test_segmentation_stores_its_tables(spark, places, tmp_path):
    spec = SegmentSpec(VARIABLES, ("n_orders", "late_rate"), ("late", "late_rate"))
    odd = places.withColumn("wind_kmh", F.when(F.col("district") == "Macul", None).otherwise(F.col("wind_kmh")))
    report = run_segmentation(odd, "district", "key", spec, "density", "late_rate", str(tmp_path / "s"), exact=True)
    assert report["n"] == 13 and report["n_left_out"] == 1
    path = VersionedFolder(spark, str(tmp_path / "s")).current()
    assert spark.read.option("header", True).csv(f"{path}/districts").count() == 13
    assert spark.read.json(f"{path}/left_out").first()["district"] == "Macul"
    assert spark.read.json(f"{path}/k_sweep").count() == 5 and spark.read.json(f"{path}/report").first()["k"] == report["k"]


# --- supervised ------------------------------------------------------------------------------------

SPEC = FeatureSpec(("distance", "hour", "is_rush_hour"), ("density",), ("traffic",), "late", "id", ("minutes",), ("class",))


@pytest.fixture(scope="module")
def orders(spark):
    i = F.col("id")
    df = spark.range(1_200).select(
        i, (F.pmod(i * 7919, F.lit(97)) / 10).alias("distance"), F.pmod(i, F.lit(24)).cast("double").alias("hour"),
        F.pmod(i, F.lit(5)).cast("double").alias("density"),
        F.when(F.pmod(i * 31, F.lit(7)) < 3, "high").otherwise("low").alias("traffic"),
        F.when(i % 2 == 0, "A").otherwise("B").alias("class"))
    df = df.withColumn("is_rush_hour", F.col("hour").isin([13.0, 20.0]).cast("int"))
    df = df.withColumn("minutes", 20 + F.col("distance") * 3 + F.when(F.col("traffic") == "high", 12).otherwise(0)
                       + F.pmod(i * 131, F.lit(17)))
    return df.withColumn("late", (F.col("minutes") > 50).cast("int"))


def test_split_and_folds(orders):
    split = stratified_split(orders, "late", "id")
    for r in split.groupBy("late").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect():
        assert r["t"] == math.floor(r["n"] * 0.25 + 0.5)
    sizes = stratified_folds(orders, "late", "id").groupBy("late", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["late"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    parts = stratified_parts(orders, "late", "id")
    same = parts.join(split.select("id", "is_test"), "id").filter((F.col("fold") < 0) != (F.col("is_test") == 1))
    assert same.count() == 0 and parts.count() == 1_200
    unlabelled = stratified_folds(orders.withColumn("late", F.when(F.col("id") % 10 > 0, F.col("late"))), "late", "id")
    assert unlabelled.count() == 1_200 and unlabelled.filter("fold is null").count() == 120
    tiny = orders.filter("id < 3").withColumn("late", F.lit(1))
    assert stratified_folds(tiny, "late", "id").count() == 3


def test_one_hot_keeps_all_levels_and_blanks_unseen_ones(spark, orders):
    model = preprocessor(SPEC).fit(orders)
    seen = model.transform(orders)
    assert feature_names(SPEC, seen) == ["distance", "hour", "is_rush_hour", "density", "traffic_high", "traffic_low", "class_A", "class_B"]
    row = model.transform(orders.limit(1).withColumn("traffic", F.lit("new")).withColumn("class", F.lit(None).cast("string"))).first()
    assert list(row["features"].toArray()[4:]) == [0.0, 0.0, 0.0, 0.0]


def test_population_scaling(orders):
    n = orders.count()
    model = preprocessor(SPEC, n).fit(orders)
    scaled = model.transform(orders).select(vector_to_array("features")[0].alias("x"))
    assert scaled.agg(F.stddev_pop("x")).first()[0] == pytest.approx(1.0, abs=1e-9)


def test_logistic_matches_newton(orders):
    """Independent solution of the same penalized problem."""
    import numpy as np
    n = orders.count()
    model = t.fit(t.logistic(n).setTol(1e-12), t.with_label(orders, SPEC), SPEC, n)
    rows = model.transform(t.with_label(orders, SPEC)).select("label", vector_to_array("features").alias("x")).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    x1, w = np.hstack([x, np.ones((n, 1))]), np.zeros(x.shape[1] + 1)
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (p - y) + ridge @ w)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(w[:-1], abs=1e-3)


def test_metrics_auc_and_confusion(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.4), (0, 0, 0.1)], "label int, prediction int, score double")
    assert ev.metrics(df).first().asDict() == {"accuracy": 0.6, "precision": 0.5, "recall": 0.5, "f1": 0.5}
    assert ev.roc_auc(df) == pytest.approx((3 + 1.5) / 6)
    assert [tuple(r) for r in ev.confusion_matrix(df).collect()] == [(0, 2, 1), (1, 1, 1)]
    assert ev.metrics(df.filter("label = 0 and prediction = 0")).first()["f1"] == 0.0


def test_train_compare_score_and_stream(spark, orders, tmp_path):
    split = split_orders(orders, SPEC, folds=3)
    result = train_and_compare(split, SPEC, {"maxDepth": [2, 5], "minInstancesPerNode": [1]}, {"numTrees": [5, 10], "maxDepth": [5]}, folds=3)
    report = result.report
    assert set(report["results"]) == {"logistic_regression", "decision_tree", "random_forest"}
    assert report["best_model"] == max(report["results"], key=lambda m: report["results"][m]["f1"])
    share = split.test.agg(F.avg("label")).first()[0]
    always_late = 2 * share / (1 + share)  # F1 of calling every order late
    assert all(r["f1"] > always_late and r["roc_auc"] > 0.8 for r in report["results"].values())
    assert report["results"]["decision_tree"]["params"]["maxDepth"] == 5
    assert len(report["cross_validation"]["f1_by_fold"]) == 3 and "difference" in report["external_features"]

    model = result.model("logistic_regression")
    top = ev.top_features(model, SPEC, model.transform(split.train), 3).collect()
    assert top[0]["feature"] in ("distance", "traffic_high", "traffic_low")
    forest = result.model("random_forest")
    assert ev.top_features(forest, SPEC, split.train, 1).first()["feature"] == "distance"
    again = forest.transform(split.test).select("label", "prediction")
    assert ev.evaluate(training.tree_scores(result.grid, result.grid.best("random_forest"), False), again.withColumn("score", F.lit(0.5)))["f1"] \
        == report["results"]["random_forest"]["f1"]
    split.close()

    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    scored = score(orders, loaded)
    assert scored.filter((F.col("late_probability") >= 0.5) != (F.col("at_risk") == 1)).count() == 0

    asked = scenarios(orders.filter("id < 50"), {"as is": {}, "heavy": {"traffic": "high", "distance": 9.0}})
    mean = {r["scenario"]: r["p"] for r in score(asked, loaded).groupBy("scenario").agg(F.avg("late_probability").alias("p")).collect()}
    assert mean["heavy"] > mean["as is"]

    orders.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = score_stream(read_orders(spark, str(tmp_path / "in"), orders.schema, files_per_batch=1), loaded)
    write_scores(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 1_200
    late = out.join(scored.select("id", F.col("late_probability").alias("p")), "id")
    assert late.filter(F.abs(F.col("p") - F.col("late_probability")) > 1e-12).count() == 0


def test_training_job_stores_all_it_found(spark, orders, tmp_path):
    root = str(tmp_path / "late")
    report = training.run_training(orders, SPEC, root, {"maxDepth": [2, 4], "minInstancesPerNode": [1, 20]}, {"numTrees": [4], "maxDepth": [3]}, folds=3)
    store = ModelStore(spark, root)
    results = {r["model"]: r for r in store.table("results", training.RESULT).collect()}
    assert {m: r["f1"] for m, r in results.items()} == {m: r["f1"] for m, r in report["results"].items()}
    assert [m for m, r in results.items() if r["best"]] == [report["best_model"]]
    assert store.table("grid", "model string, params string, f1 double").count() == 5
    assert store.table("folds", "part string, f1 double").where("part = 'mean'").first()["f1"] == report["cross_validation"]["f1_mean"]
    matrix = store.table("confusion", "actual int, predicted_0 long, predicted_1 long").collect()
    assert abs(sum(r["predicted_0"] + r["predicted_1"] for r in matrix) - 300) <= 1  # a quarter of each class
    assert store.table("top_features", "feature string, weight double").count() > 2
    assert store.table("external_features", "difference double").count() == 1
    scored = score(orders, store.load())
    assert scored.count() == 1_200 and scored.where("late_probability is null").count() == 0
    with pytest.raises(FileNotFoundError):
        ModelStore(spark, str(tmp_path / "none")).load()


def test_scenarios_derive_features_again(spark):
    df = spark.createDataFrame([(1, "a", 10, 2, 100.0, 3, 12)], "id int, district string, hour int, dow int, value double, items int, experience_months int")
    context = spark.createDataFrame([("a", 5.0)], "district string, density double")
    rows = {r["scenario"]: r for r in scenarios(
        df, {"now": {}, "rush": {"hour": 20, "items": 4}}, FeatureRules(), context, "district").collect()}
    assert (rows["now"]["is_rush_hour"], rows["rush"]["is_rush_hour"]) == (0, 1)
    assert (rows["now"]["value_per_item"], rows["rush"]["value_per_item"]) == (33.0, 25.0)
    assert rows["rush"]["density"] == 5.0


def test_a_step_of_all_designs_like_one_by_one():
    draw = np.random.default_rng(7)
    x = np.round(draw.normal(size=(1_300, 3)), 1)
    centres = [x[draw.integers(0, 1_300, k)] for k in (2, 2, 3, 4)]
    centres.append(np.repeat(x[:1], 3, axis=0))  # equal centres: the first wins
    got = pa.Table.from_batches(list(sg._step(centres)(iter([pa.RecordBatch.from_arrays([pa.array(x[a: a + 700].tolist())], ["x"]) for a in (0, 700)]))))
    want = []
    for d, own in enumerate(centres):
        apart = ((x[:, None, :] - own[None]) ** 2).sum(2)
        nearest = apart.argmin(1)
        want += [[d, c, (nearest == c).sum(), apart[nearest == c, c].sum(), *x[nearest == c].sum(0)] for c in range(len(own))]
    assert np.allclose(got.to_pandas().to_numpy(), want)


def test_silhouette_copies_of_a_point_do_not_grow_with_the_points(spark):
    assert parts_of(2_000) == 1 and parts_of(20_000) == parts_of(1_600_000) == 16 and parts_of(16_000_000) == 160
    df = spark.range(500).select("id", (F.col("id") % 3).cast("int").alias("c"), F.array(F.pmod(F.col("id") * 37, F.lit(101)).cast("double"), (F.col("id") % 3 * 40).cast("double")).alias("x"))
    one, many = (euclidean_silhouette(df, "id", "c", "x", block=block).first() for block in (500, 20))
    assert many["n"] == one["n"] == 500 and many["silhouette"] == pytest.approx(one["silhouette"], abs=1e-12)


def test_marking_parts_moves_no_rows(spark, capsys):
    """Cuts are a few counted rows: the table that is marked with them is not shuffled by its two labels."""
    df = spark.range(5_000).select("id", (F.col("id") % 2).alias("label"))
    parts = stratified_parts(df, "label", "id")
    parts.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert parts.where("fold < 0").count() == 1_250


def test_cells_give_the_sums_of_their_points():
    """Many points of a packed table are added cell by cell, to the numbers that comparing each of them gives."""
    draw = np.random.default_rng(11)
    x = np.concatenate([np.round(draw.normal(size=(5_000, 4)), 1), np.zeros((200, 4))])
    lists = pa.RecordBatch.from_arrays([pa.array(x.tolist())], ["x"])
    packed = list(sg._cut(iter([lists])))
    assert sum(b.column("n")[0].as_py() for b in packed) == len(x) and sum(b.num_rows for b in packed) < 3
    cells = list(sg._cells_of(packed[0], 4))[0]
    assert cells.points.max() <= sg.CELL_ROWS and sorted(map(tuple, cells.x.T.tolist())) == sorted(map(tuple, x.tolist()))
    centres = [x[draw.integers(0, len(x), k)] for k in (2, 3, 6)]
    near = sg._near(cells.middle, cells.reach, centres[0])[1]
    assert cells.points[near.sum(1) == 1].sum() > len(x) / 10
    got = pa.Table.from_batches(list(sg._step(centres)(iter(packed)))).to_pandas().to_numpy()
    want = pa.Table.from_batches(list(sg._step(centres)(iter([lists])))).to_pandas().to_numpy()
    assert np.array_equal(got[:, 2], want[:, 2]) and np.allclose(got, want)
