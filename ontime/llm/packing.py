"""Packing into optimal length buckets.

The global histogram of token counts (a map-side aggregation; one row per distinct length) goes to the driver, where a
dynamic programme chooses at most ``buckets`` upper boundaries such that padding every document to its bucket's boundary
wastes the fewest tokens. Its cost function satisfies the quadrangle inequality, so each layer is solved by divide and
conquer. Inside each bucket, documents are numbered and cut into batches of as many rows as the token budget holds.

Numbers come from counts of hashed slices: slices of a bucket hold about ``slice_rows`` rows, a cumulative count over the
slices shifts each of them, and only a slice is ever sorted in one task, whatever the bucket's size.

Defined results: null text counts as empty and has one token, the end; a document longer than the budget gets batches of
one; repeated rows and ids are numbered one by one, in an order that ties do not change visibly; a null id is a value like
any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import SPACES, named, staged

BUCKETS = 8
TOKEN_BUDGET = 65_536
SLICE_ROWS = 50_000


def word_tokens(text: Column) -> Column:
    """Words of the text and one end token."""
    body = F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, " " * len(SPACES))
    return (F.size(F.filter(F.split(body, " +"), lambda w: w != "")) + 1).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper boundaries, each one of the ascending ``lengths``, that minimise the padded total; the fewest that do."""
    m = len(lengths)
    if not m:
        return []
    upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    best = lengths.astype(np.int64) * upto[1:]  # padded tokens of the first i+1 lengths in one bucket
    choices = []
    for _ in range(1, min(buckets, m)):
        layer, choice = best.copy(), np.full(m, -1, np.int64)
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            i = (low + high) // 2
            j = np.arange(first, min(i - 1, last) + 1)
            at = first
            if len(j):
                cost = best[j] + int(lengths[i]) * (upto[i + 1] - upto[j + 1])
                k = int(np.argmin(cost))
                at = int(j[k])
                if cost[k] < layer[i]:
                    layer[i], choice[i] = cost[k], at
            todo += [(low, i - 1, first, at), (i + 1, high, at, last)]
        if layer[-1] == best[-1]:
            break
        best = layer
        choices.append(choice)
    out, i = [], m - 1
    for choice in reversed(choices):
        out.append(int(lengths[i]))
        if choice[i] < 0:
            i = -1
            break
        i = int(choice[i])
    if i >= 0:
        out.append(int(lengths[i]))
    return out[::-1]


def boundaries(sized: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Boundaries for the ``n_tokens`` of a table; the histogram has one row per distinct length."""
    histogram = sized.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    return best_boundaries(np.array([r[0] for r in histogram], np.int64), np.array([r[1] for r in histogram], np.int64), buckets)


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, tokens=word_tokens, id_col: str = "doc_id",
         text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_tokens, bucket, padded_to, batch and place (both from 0, within the bucket), padding."""
    sized = staged(
        docs.select(named(id_col).cast("long").alias("doc_id"), tokens(named(text_col)).alias("n_tokens")), "pack-lengths")
    bounds = boundaries(sized, buckets)
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    placed = sized.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n_tokens"))))
    per_bucket = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / slice_rows).alias("slices"))
    sliced = placed.join(F.broadcast(per_bucket), "bucket").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.col("slices")))
    counts = sliced.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("bucket", "slice").orderBy(F.xxhash64("doc_id", "n_tokens"), "doc_id", "n_tokens")
    numbered = sliced.withColumn("rank", F.row_number().over(inside)).join(shifts, ["bucket", "slice"])
    bound = F.get(edges, F.col("bucket"))
    number = F.col("rank") + F.col("shift") - 1
    capacity = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / bound).cast("long"))
    return numbered.select(
        "doc_id", "n_tokens", F.col("bucket").cast("int"), bound.alias("padded_to"), F.floor(number / capacity).cast("long").alias("batch"),
        F.pmod(number, capacity).cast("long").alias("place"), (bound - F.col("n_tokens")).alias("padding"),
    )
