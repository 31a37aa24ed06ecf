import itertools
import random
from collections import defaultdict

import numpy as np

from ontime.llm.packing import best_boundaries, pack
from tests.llm.brute import SCHEMA, WORDS, odd_documents


def padded(lengths, counts, bounds):
    return sum(c * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(7)
    for _ in range(120):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 30) for _ in lengths]
        k = rng.randint(1, 5)
        got = best_boundaries(np.array(lengths), np.array(counts), k)
        assert len(got) <= k and got[-1] == lengths[-1] and got == sorted(set(got))
        best = min(padded(lengths, counts, (*own, lengths[-1])) for n in range(k) for own in itertools.combinations(lengths[:-1], min(n, len(lengths) - 1)))
        assert padded(lengths, counts, got) == best


def check(docs, rows, buckets, budget):
    want = sorted(((r["doc_id"], len(WORDS.findall((r["text"] or "").encode())) + 1) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == want
    lengths = [n for _, n in want]
    values = sorted(set(lengths))
    bounds = best_boundaries(np.array(values), np.array([lengths.count(v) for v in values]), buckets)
    batches = defaultdict(list)
    for r in rows:
        assert r.padded_to == min(b for b in bounds if b >= r.n_tokens) == bounds[r.bucket] and r.padding == r.padded_to - r.n_tokens
        batches[r.bucket, r.batch].append(r.place)
    for (bucket, batch), places in batches.items():
        capacity = max(1, budget // bounds[bucket])
        full = (bucket, batch + 1) in batches
        assert sorted(places) == list(range(len(places))) and (len(places) == capacity if full else len(places) <= capacity)
        assert batch == 0 or (bucket, batch - 1) in batches


def test_odd_documents(spark):
    docs = odd_documents(spark)
    check(docs, pack(docs, buckets=3, token_budget=20, slice_rows=2).collect(), 3, 20)


def test_whole_table_in_small_slices(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs, pack(docs, token_budget=4096, slice_rows=7).collect(), 8, 4096)


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []
