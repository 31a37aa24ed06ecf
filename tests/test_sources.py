import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.session import drop_staged, path_exists, scratch_path, stage
from ontime.sources import api, readers, schemas, sinks
from ontime.sources.versions import VersionedFolder, current_or_plain
from tests.fixtures import DISTRICTS, dirty_orders, districts, weather


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_csv_round_trip_and_na_tokens(spark, tmp_path):
    source = dirty_orders(spark)
    sinks.write_csv(source, str(tmp_path / "orders"))
    assert rows(readers.read_csv(spark, str(tmp_path / "orders"), source.schema)) == rows(source)
    (tmp_path / "raw.csv").write_text("id,name\n1, x \nNA,\nnan,N/A\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert rows(readers.read_csv(spark, str(tmp_path / "raw.csv"), schema)) == rows(
        spark.createDataFrame([(1, " x "), (None, None), (None, None)], schema))


def test_reference_table_is_created_once_and_replaced_on_demand(spark, tmp_path):
    path = str(tmp_path / "districts")
    assert readers.read_reference(spark, path, lambda: districts(spark)).count() == 14
    few = lambda: districts(spark).limit(3)
    assert readers.read_reference(spark, path, few).count() == 14
    assert readers.read_reference(spark, path, few, replace=True).count() == 3


def test_snapshot_resolution(spark, tmp_path):
    path, schema = str(tmp_path / "weather"), schemas.envelope(schemas.WEATHER)
    fallbacks = []

    def broken():
        raise ConnectionError("no network")

    with pytest.raises(RuntimeError, match="no network"):
        readers.resolve_snapshot(spark, path, schema, broken)
    assert readers.resolve_snapshot(spark, path, schema, lambda: weather(spark)).count() == 14
    assert rows(readers.resolve_snapshot(spark, path, schema, broken)) == rows(weather(spark))  # stored one is used
    kept = readers.resolve_snapshot(spark, path, schema, broken, refresh=True, on_fallback=fallbacks.append)
    assert kept.count() == 14 and isinstance(fallbacks[0], ConnectionError)

    def fails_late():
        return weather(spark).withColumn("temperature_c", F.raise_error(F.lit("boom")).cast("double"))

    assert readers.resolve_snapshot(spark, path, schema, fails_late, refresh=True).count() == 14
    changed = readers.resolve_snapshot(spark, path, schema, lambda: weather(spark, constant=True), refresh=True)
    assert {r["temperature_c"] for r in changed.collect()} == {12.0}


def test_versioned_folder(spark, tmp_path):
    folder = VersionedFolder(spark, str(tmp_path / "versions"))
    count = lambda: spark.read.parquet(folder.current()).count()
    assert folder.current() is None and current_or_plain(spark, folder.root) is None
    folder.publish(lambda path: spark.range(3).write.parquet(path))
    with pytest.raises(Exception, match="half way"):
        folder.publish(lambda path: spark.range(1000).select(
            F.when(F.col("id") == 999, F.raise_error(F.lit("half way")).cast("long")).otherwise(F.col("id")).alias("id")).write.parquet(path))
    assert count() == 3 and len(folder.history()) == 1
    folder.publish(lambda path: spark.range(5).write.parquet(path))
    assert count() == 5 and current_or_plain(spark, folder.root) == folder.current()
    folder.restore()
    assert count() == 3
    with pytest.raises(LookupError):
        folder.restore()
    assert len(folder.prune(1)) == 2 and count() == 3
    plain = str(tmp_path / "plain")
    spark.range(2).write.parquet(plain)
    assert current_or_plain(spark, plain) == plain


def test_a_first_write_that_fails_leaves_nothing_to_read(spark, tmp_path):
    path, schema = str(tmp_path / "weather"), schemas.envelope(schemas.WEATHER)
    late = lambda: weather(spark).withColumn("temperature_c", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(RuntimeError, match="no snapshot"):
        readers.resolve_snapshot(spark, path, schema, late)
    assert current_or_plain(spark, path) is None
    with pytest.raises(readers.MissingSourceError):
        readers.read_snapshot(spark, path, schema)


def test_envelopes_of_bounded_size(spark):
    many = spark.range(25).withColumn("v", F.col("id") * 2)
    folded = {r["part"]: [x["id"] for x in r["records"]] for r in sinks.envelopes(many, "s", "id", records=10).collect()}
    assert folded == {0: list(range(10)), 1: list(range(10, 20)), 2: list(range(20, 25))}
    lost = sinks.envelopes(spark.createDataFrame([(None, 1), (5, 2), (None, 3)], "id long, v long"), "s", "id").collect()
    assert sorted((str(r["part"]), len(r["records"])) for r in lost) == [("0", 1), ("None", 2)]
    one = sinks.envelopes(districts(spark), "s", "district").first()
    assert [r["district"] for r in one["records"]] == sorted(d[0] for d in DISTRICTS)


def test_requests_and_responses(spark):
    places = spark.createDataFrame([(n, -33.0 - n, -70.0) for n in range(5)], "id long, lat double, lon double")
    batched = api.assign_batches(places, "id", size=2)
    assert sorted(r["n"] for r in batched.groupBy("batch").agg(F.count("*").alias("n")).collect()) == [1, 2, 2]
    asked = {r["batch"]: r["lat"] for r in api.ordered_concat(batched, "id", ["lat", "lon"], "batch").collect()}
    assert asked[0] == "-33.0,-34.0" and asked[2] == "-37.0"
    point = '{"current": {"temperature_2m": %s, "relative_humidity_2m": 70, "wind_speed_10m": 2.0, "precipitation": 0.0}}'
    answers = spark.createDataFrame([
        (0, f"[{point % 1.5}, {point % 2.5}]"),
        (1, f"[{point % 3.5}]"),  # shorter than asked: the last place drops out
        (2, point % 5.5),  # one bare object
    ], "batch long, body string")
    got = api.rows_from_responses(batched, answers, "id", "batch", "body").orderBy("id").collect()
    assert [(r["id"], r["temperature_c"], r["humidity_pct"]) for r in got] == [(0, 1.5, 70), (1, 2.5, 70), (2, 3.5, 70), (4, 5.5, 70)]


def test_first_existing_and_reports(spark, tmp_path):
    sinks.write_report(spark.range(1).select(F.struct(F.lit(0.5).alias("f1")).alias("best")), str(tmp_path / "b"))
    schema = T.StructType([T.StructField("best", T.StructType([T.StructField("f1", T.DoubleType())]))])
    read = lambda p: readers.read_report(spark, p, schema)
    assert readers.read_first(spark, [str(tmp_path / "a"), str(tmp_path / "b")], read).select("best.f1").first()[0] == 0.5
    assert readers.read_first(spark, [str(tmp_path / "a")], read, optional=True) is None
    with pytest.raises(readers.MissingSourceError):
        readers.read_first(spark, [str(tmp_path / "a")], read)


def test_staged_tables_live_in_the_scratch_folder(spark):
    df = stage(spark.range(3), "t")
    folder = df.inputFiles()[0].rsplit("/", 1)[0]
    assert scratch_path(spark, "t").rsplit("/", 1)[0] in folder
    drop_staged(spark, df)
    assert not path_exists(spark, folder)
