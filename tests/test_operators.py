import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ontime.functions import numeric, text
from ontime.operators import keytree, perturb, quality, reports, selection
from ontime.operators.clean import CleanRules, clean
from ontime.operators.skew import expand_copies


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, fn, values, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(fn(F.col("v"))).collect()]


def test_text(spark):
    assert apply(spark, text.strip, ["\t a b \n", " x　", None]) == ["a b", "x", None]
    assert apply(spark, text.capitalize, ["comida RÁPIDA", "ñuñoa", "", None]) == ["Comida rápida", "Ñuñoa", "", None]
    names = ["las condes", "o'higgins-sur", "ÑUÑOA", "a1b c", ""]
    assert apply(spark, text.title_case, names) == [n.title() for n in names]
    assert apply(spark, lambda c: text.normalize_category(c, ["nan"]), [" nan ", " LLUVIA"]) == [None, "Lluvia"]


def test_numeric(spark):
    assert apply(spark, lambda c: numeric.ratio(c, F.lit(2)), [5.0, 7.0, None], "double") == [2.0, 4.0, None]
    assert apply(spark, lambda c: numeric.ratio(c, F.lit(0)), [5.0], "double") == [None]
    assert apply(spark, lambda c: numeric.clip(c, 1.0, 2.0), [0.0, 1.5, 9.0, None], "double") == [1.0, 1.5, 2.0, None]
    assert apply(spark, lambda c: numeric.floor_bin(c, 6), [0, 5, 6, 13], "int") == [0, 0, 6, 12]
    assert apply(spark, lambda c: numeric.flag(c.isin([1])), [1, 2, None], "int") == [1, 0, 0]
    assert apply(spark, lambda c: numeric.code_label(c, {0: "a", 1: "b"}), [0, 1, 2], "int") == ["a", "b", None]
    assert numeric.nan_to_null(column(spark, [float("nan"), 1.0])).filter("v is null").count() == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.sampled_from([0.0, 1.0, 7.5]), st.floats(-1e6, 1e6)), min_size=1, max_size=120))
def test_exact_median(spark, values):
    df = column(spark, [*values, None, float("nan")])
    assert selection.exact_medians(df, ["v"])["v"] == pytest.approx(statistics.median(values), abs=1e-12)


def test_median_with_one_value_on_most_rows(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"),
                                    (F.col("id") * 3.5).alias("w"), F.lit(None).cast("double").alias("empty"))
    got = selection.exact_medians(df, ["v", "w", "empty"])
    values = sorted(5.0 if k % 3 == 0 else float(k) for k in range(30_000))
    assert got == {"v": statistics.median(values), "w": 14_999.5 * 3.5, "empty": None}
    assert selection.exact_medians(column(spark, [float("nan"), 1.0, 2.0]), ["v"]) == {"v": 1.5}
    assert selection.exact_medians(column(spark, [float("nan"), None]), ["v"]) == {"v": None}


def test_weighted_median_and_mode(spark):
    df = column(spark, [1.0, 1.0, 2.0, 4.0, None])
    assert selection.weighted_median(df, "v").first()[0] == 1.5
    assert tuple(selection.exact_mode(column(spark, ["b", "a", "b", "a", None], "string"), "v").first()) == ("a", 2)


def test_sample_and_numbering(spark):
    df = spark.range(5_000).withColumn("id", F.col("id") * 3)
    for n in (0, 1, 700, 5_000, 9_000):
        assert selection.sample_rows(df, n, "id", 3).count() == min(n, 5_000)
    again = selection.sample_rows(df.repartition(7), 50, "id", 3)
    assert selection.sample_rows(df, 50, "id", 3).exceptAll(again).count() == 0
    ids = perturb.format_ids(df, "id", "order_id").orderBy("id").limit(2).collect()
    assert [r["order_id"] for r in ids] == ["PED_00001", "PED_00002"]
    shuffled = [r["id"] for r in selection.shuffle_rows(df, "id").collect()]
    assert sorted(shuffled) == [3 * n for n in range(5_000)] and shuffled != sorted(shuffled)


def test_cuts_by_more_digits_are_the_same_cuts(spark):
    df = spark.range(3_000).withColumn("g", F.col("id") % 3)
    ask = [lambda n: F.lit(100), lambda n: F.floor(n / 2), lambda n: n]
    cuts = lambda **more: sorted(map(tuple, selection.hash_cuts(df, "id", 5, ask, ["g"], **more).collect()))
    assert cuts() == cuts(edge_rows=0) and len(cuts()) == 3


def test_numbers_of_whole_numbers_beyond_doubles(spark):
    """Keys around 2^53, negative ones, both ends of the range, and steps of one and of 2^40."""
    keys = sorted({*range(2 ** 53 - 3, 2 ** 53 + 90_000, 7), *range(-5, 5), *(n << 40 for n in range(-300, 300)), -2 ** 63, 2 ** 63 - 1})
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "id long").repartition(5)
    numbered = keytree.number_rows(df, "id", "no")
    assert [tuple(r) for r in numbered.orderBy("no").collect()] == [(k, n) for n, k in enumerate(keys, 1)]


def test_numbers_of_texts_dates_and_missing_keys(spark):
    words = ["", "a", "ab", "é", "日本", "zz"] + [f"NATION_{n:06d}" for n in range(700)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,), (None,)], "w string").repartition(3)
    numbered = keytree.number_rows(df, "w", "no", leaf_rows=50)
    want = {w: n for n, w in enumerate(sorted(words, key=str.encode), 1)}
    assert {r["w"]: r["no"] for r in numbered.where("w is not null").collect()} == want
    assert numbered.where("w is null and no is null").count() == 2
    days = spark.sql("select date_add(date'1969-12-30', cast(id as int)) d from range(5)")
    assert [r["no"] for r in keytree.number_rows(days, "d", "no").orderBy("d").collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(TypeError):
        keytree.number_rows(column(spark, [1.0]), "v")


def test_ordered_text_of_leaves(spark):
    rows = [(n % 2, n, None if n % 10 == 3 else f"t{n}") for n in range(2_000)]
    df = spark.createDataFrame(rows, "g int, k long, t string").repartition(4)
    want = {g: ",".join(t for a, _, t in rows if a == g and t is not None) for g in (0, 1)}
    assert {r["g"]: r["t"] for r in keytree.ordered_text(df, ["g"], "k", ["t"]).collect()} == want
    texts = df.where("t is not null")
    got = {r["g"]: r["t"] for r in keytree.ordered_text(texts, ["g"], "t", ["t"], "|", leaf_rows=40).collect()}
    assert got == {g: "|".join(sorted(t for a, _, t in rows if a == g and t is not None)) for g in (0, 1)}


@pytest.mark.parametrize("values", [
    [5e-324, 1e-310, -5e-324, 0.0, -0.0], [float("inf"), float("-inf"), 1.0], [1.7e308, -1.7e308, 1.6e308], [1.0, 1.0 + 2 ** -52, 1.0 + 2 ** -51, 1.0 + 3 * 2 ** -51],
    [float("inf"), float("inf"), 3.0], [2.0 ** k for k in range(-40, 41)]])
def test_exact_median_of_odd_numbers(spark, values):
    assert selection.exact_medians(column(spark, values), ["v"])["v"] == statistics.median(values)


def test_duplicates_with_one_huge_group(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") < 1_000, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                     F.lit(None).cast("string").alias("c"))
    assert quality.duplicate_count(rows).first()[0] == 999
    assert quality.duplicate_members(rows).count() == 1_000
    marked = quality.mark_copies(rows)
    assert marked.count() == 3_000 and marked.filter("is_copy = 1").count() == 999
    chunked = expand_copies(quality.copies(rows), "copies", chunk=7)
    assert chunked.filter("k = -1").select("copy_no").distinct().count() == 1_000
    assert chunked.count() == 3_000


def test_duplicate_key_members_with_a_hot_null_key(spark):
    rows = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    got = quality.duplicate_key_members(rows, ["k"])
    sizes = {}
    for r in rows.collect():
        sizes[r["k"]] = sizes.get(r["k"], 0) + 1
    assert sorted(map(tuple, got.select("v", "n").collect())) == sorted(
        (r["v"], sizes[r["k"]]) for r in rows.collect() if sizes[r["k"]] > 1)


def test_null_profile_domain(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", None), (3, None, None)], "x int, y string, z double")
    assert [tuple(r) for r in quality.null_counts(df).collect()] == [("z", 3), ("x", 1), ("y", 1)]
    assert [tuple(r) for r in quality.profile(df).collect()][0] == (0, "x", "int", 3, 2)
    assert [tuple(r) for r in quality.domain_violations(df, "y", ["a"]).collect()] == [("b", 1)]
    assert quality.shape(df).first().asDict() == {"n_rows": 3, "n_columns": 3}


def test_reports(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 0, 5.0), ("b", 1, 10.0), (None, 1, None)], "k string, late int, x double")
    assert [r["k"] for r in reports.rate_by(df, "k", "late").collect()] == ["a", "b"]
    assert [r["k"] for r in reports.rate_by(df, "k", "late", descending=True).collect()] == ["b", "a"]
    assert [tuple(r) for r in reports.histogram(df, "x", 2).collect()] == [(1, 1), (2, 2)]
    assert reports.filter_in(df, {"k": None}).count() == 4
    assert reports.top_abs(df.dropna(), "x", "k", 1).first()["k"] == "b"
    assert [r["names"] for r in reports.sorted_concat(df, "late", "k").orderBy("late").collect()] == ["a", "a, b"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(0, 200)), st.sampled_from([" alto", "ALTO ", "bajo", None]),
                          st.sampled_from([-1.0, 5.0, 60.0])), min_size=1, max_size=20))
def test_clean_leaves_no_nulls_where_a_value_exists(spark, rows):
    df = spark.createDataFrame(rows, "d double, c string, t double")
    result = clean(df, CleanRules(text=("c",), limits={"d": 40}, positive=("t",), impute_median=("d",), impute_mode=("c",)))
    kept = result.df.collect()
    for name in ("d", "c"):
        nulls = [r[name] is None for r in kept]
        assert all(nulls) or not any(nulls)
    assert {r["c"] for r in kept} <= {"Alto", "Bajo", None}
    assert result.report["rows_out"] == len(kept) and all(r["d"] is None or r["d"] <= 40 for r in kept)
    assert len({tuple(map(str, r)) for r in rows if r[2] > 0}) == len(kept)
