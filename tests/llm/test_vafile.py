"""Vector-approximation search against scoring every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.llm import vafile

SCHEMA = "vec_id long, embedding array<float>, label int, x string, row int, score string"


def brute(rows, queries, k):
    whole = []
    for at, (key, vector) in enumerate(rows):
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            whole.append((at, key, [math.floor(256 * float(np.float32(c))) for c in vector]))
    out = []
    for at, key, q in whole:
        if queries(key):
            scored = [(-sum(a * b for a, b in zip(q, x)), other is None, other or 0, place, other) for place, other, x in whole if place != at]
            out += [(key, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, k=5, every=7, **sizes):
    table = spark.createDataFrame([(key, v, 1, "x", 2, "s") for key, v in rows], SCHEMA)
    got = vafile.top_k(table, F.col("vec_id") % every == 0, k, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 6])
def test_like_all_pairs(spark, bits):
    draw = np.random.default_rng(1)
    rows = [(n, draw.normal(0, 0.2, 12).round(3).tolist()) for n in range(400)]
    assert run(spark, rows, bits=bits, block_rows=90, group_queries=20) == brute(rows, lambda key: key is not None and key % 7 == 0, 5)


def test_copies_ties_nulls_and_odd_vectors(spark):
    draw = np.random.default_rng(2)
    common = [0.5, -0.25, 0.125, 0.5]
    rows = [(n, common) for n in range(60)]  # a group far larger than k
    rows += [(100 + n, draw.choice([-0.5, 0.0, 0.5], 4).tolist()) for n in range(120)]  # scores tie
    rows += [(300, None), (301, [None, 1.0, 0.0, 0.0]), (302, [float("nan"), 0.0, 0.0, 0.0]), (303, [float("-inf"), 0.0, 0.0, 0.0]),
             (308, []), (315, [0.5]), (316, [0.25, 0.5, 0.125, 0.5, 0.25]), (None, common), (None, common), (0, common), (7, [0.75, 0.0, 0.0, 0.0]), (7, [0.75, 0.0, 0.0, 0.0])]
    want = brute(rows, lambda key: key is not None and key % 7 == 0, 5)
    assert run(spark, rows, block_rows=50, group_queries=7) == want
    assert run(spark, rows, bits=2) == want


def test_large_numbers_stay_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(n, (draw.normal(0, 1, 6) * 2.0 ** 20).tolist()) for n in range(120)]  # sums beyond 2^53
    assert run(spark, rows) == brute(rows, lambda key: key % 7 == 0, 5)
    rows.append((500, [3e38] * 6))
    assert len(run(spark, rows)) == 18 * 5


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(7, [1.0, 2.0])]) == []
    assert run(spark, [(7, [1.0, 2.0]), (8, [1.0, 0.5])]) == [(7, 1, 8, 131072)]
    assert run(spark, [(7, []), (8, [])]) == [(7, 1, 8, 0)]


def test_reads_go_on_until_the_last_answer_is_certain(spark):
    """Two cells per dimension say little: many classes must be read, over several rounds."""
    draw = np.random.default_rng(4)
    rows = [(n, draw.normal(0, 0.2, 3).tolist()) for n in range(300)]
    assert run(spark, rows, k=3, bits=1) == brute(rows, lambda key: key % 7 == 0, 3)


def test_tiles_are_not_gathered_in_the_driver(spark):
    """The copies of small groups are as many as there are blocks: no broadcast, whatever their file's size."""
    cells = vafile.staged(spark.createDataFrame([(b, b"c" * 9, b"x" * 50) for b in range(4)], "block int, classes binary, cells binary"), "va-file")
    groups = vafile.staged(spark.createDataFrame([(p, b"a" * 9, b"q" * 50) for p in range(3)], "part int, asks binary, q binary"), "va-queries")
    tiles = vafile.tiles(cells, groups, 4, 3)
    assert sorted((r["block"], r["part"]) for r in tiles.collect()) == [(b, p) for b in range(4) for p in range(3)]
    assert "Broadcast" not in tiles._jdf.queryExecution().executedPlan().toString()
