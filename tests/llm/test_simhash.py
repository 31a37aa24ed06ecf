import random

import numpy as np
from pyspark.sql import functions as F

from ontime.llm.simhash import anchors, components, fingerprint, home, links, near_dedup, near_groups
from tests.llm.brute import SCHEMA, groups, odd_documents, simhash


def near(values, bits=2):
    return lambda x: [y for y in values if bin((x ^ y) & (2**64 - 1)).count("1") <= bits]


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_fingerprint_matches_plain_counting():
    rng = random.Random(1)
    texts = ["", " \n", "a", "A b", "a B c", "a b c d"] + [" ".join(rng.choices(["x", "yy", "Zé", "t u"], k=rng.randint(1, 400))) for _ in range(40)]
    assert [fingerprint(t.encode()) for t in texts] == [simhash(t) for t in texts]


def test_every_close_pair_meets_at_the_probes_anchor():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, i % 3, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    row, anchor, probe = anchors(y)
    met = set(zip(row.tolist(), anchor.tolist()))
    assert all((i, a) in met for i, a in enumerate(home(x).tolist()))
    assert probe.sum() == len(y) and len(met) == len(row)


def clustered(seed=3, n=900):
    """Chains and clouds of fingerprints, one of them large."""
    rng = random.Random(seed)
    values = {0}
    for size in [n // 2] + [rng.randint(1, 20) for _ in range(40)]:
        x = rng.getrandbits(64)
        own = [x]
        for _ in range(size):
            own.append(rng.choice(own) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        values.update(own)
    return sorted(values)


def test_links_join_what_brute_force_joins(spark):
    values = clustered()
    want = groups(values, near(values))
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long").repartition(4)
    for chunk in (512, 7):
        root = {r.u: r.v for r in components(links(fps, chunk=chunk)).collect()}
        got = {v: root.get(signed(v), signed(v)) for v in values}
        assert len(set(want.values())) == len(set(got.values()))
        assert len({(want[v], got[v]) for v in values}) == len(set(got.values()))


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    rows = components(edges).collect()
    assert len(rows) == 300 and {r.v for r in rows} == {0}


def test_groups_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    fp = [simhash(r["text"]) for r in rows]
    root = groups(set(fp), near(set(fp)))
    least = {}
    for r, f in zip(rows, fp):
        if r["doc_id"] is not None:
            least[root[f]] = min(least.get(root[f], r["doc_id"]), r["doc_id"])
    want = sorted(((r["doc_id"], f"{f:016x}", least.get(root[f])) for r, f in zip(rows, fp)), key=str)
    assert sorted((tuple(r) for r in near_groups(docs).collect()), key=str) == want
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(least.values()) and ids.count(None) == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_groups(empty).collect() == [] and near_dedup(empty).collect() == []
