"""Exact deduplication by skew-safe combining (native).

Texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted.

1. Each task combines its own equal texts (the map side of the first aggregation).
2. The digest groups are merged per salt. The salt is the number of the reading task modulo ``salts``, so a task sends
   one row for each distinct text, and a hot text is merged by up to ``salts`` tasks.
3. The winners of the salts are combined globally.

Every stage groups by digest *and* whole content, so a digest that two contents share is noticed; only such digests are
joined back by content, all others by digest alone.

Defined results: a null text counts as empty, and all empty texts are one group; a null id loses against any other and
is returned as null; a row that repeats both id and text is a copy like any other (it counts in ``group_size``, and just
one of the rows that stay is marked); an empty table gives an empty result; other columns are neither read nor renamed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import SPACES, fresh, named, staged

Digest = Callable[[Column], Column]


def sha256(content: Column) -> Column:
    """Never null, so a join on it needs no null filter that would compute it a second time."""
    return F.coalesce(F.sha2(content, 256), F.lit(""))


def _content(text_col: str) -> Column:
    return F.translate(F.coalesce(named(text_col).cast("string"), F.lit("")), SPACES, "")


def _length(text_col: str) -> Column:
    return F.length(F.coalesce(named(text_col).cast("string"), F.lit(""))).cast("long")


def _winners(docs: DataFrame, id_col: str, text_col: str, digest: Digest, salts: int) -> DataFrame:
    """One staged row per distinct content: digest, best (n_chars, known, minus_id), size, clash, content.

    ``clash`` says that other contents share the digest; only then ``content`` is filled.
    """
    rows = docs.select(
        digest(_content(text_col)).alias("digest"), _content(text_col).alias("content"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
        F.struct(
            _length(text_col).alias("n_chars"), named(id_col).isNotNull().alias("known"),
            F.bitwise_not(named(id_col).cast("long")).alias("minus_id"),
        ).alias("best"),
    )
    merged = rows.groupBy("digest", "salt", "content").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("size"))
    whole = (
        merged.repartition("digest").groupBy("digest", "content")
        .agg(F.max("best").alias("best"), F.sum("size").alias("size"))
        .withColumn("clash", F.count(F.lit(1)).over(Window.partitionBy("digest")) > 1)
        .withColumn("content", F.when(F.col("clash"), F.col("content")))
    )
    return staged(whole, "exact-winners")


def _shared(winners: DataFrame) -> DataFrame:
    """The winners whose digest other contents share: hardly ever any, and a table of its own shows Spark how small it is."""
    return staged(winners.where("clash").drop("clash"), "exact-clashes")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256,
                 salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text stays, then the smallest id.
    """
    winners = _winners(docs, id_col, text_col, digest, salts).select(
        "digest", "content", "clash", "size", F.bitwise_not(F.col("best.minus_id")).alias("keep_id"),
        F.col("best.n_chars").alias("keep_chars"),
    )
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"), _length(text_col).alias("n_chars"), _content(text_col).alias("content"),
        digest(_content(text_col)).alias("digest"), sha256(_content(text_col)).alias("sha"),
    )
    alone = winners.where(~F.col("clash")).drop("content", "clash")
    shared = _shared(winners)
    each = ["doc_id", "n_chars", "digest", "sha"]
    copies = F.count(F.lit(1)).alias("copies")
    by_digest = rows.groupBy(each).agg(copies).join(alone, "digest")
    by_content = (
        rows.join(shared, ["digest", "content"]).groupBy(*each, "keep_id", "keep_chars", "size").agg(copies)
    )
    columns = ["doc_id", "n_chars", "sha", "copies", "keep_id", "keep_chars", "size"]
    return (
        by_digest.select(columns).unionByName(by_content.select(columns))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(
            "doc_id", "keep_id", F.col("size").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")) & (F.col("copy") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = sha256,
                salts: int = 16) -> DataFrame:
    """The rows that stay, with all columns of ``docs``.

    Rows that repeat the winner's id, length and content are copies too: one of them stays.
    """
    winners = _winners(docs, id_col, text_col, digest, salts).select(
        "digest", "content", "clash", F.bitwise_not(F.col("best.minus_id")).alias("keep_id"), F.col("best.n_chars").alias("keep_chars"),
    )
    key, size, body = (fresh(docs, f"exact_{stem}") for stem in ("digest", "chars", "content"))
    rows = docs.withColumns({key: digest(_content(text_col)), size: _length(text_col)})

    def staying(chosen: DataFrame, *also: Column) -> DataFrame:
        same = [F.col(key) == chosen["digest"], named(id_col).cast("long").eqNullSafe(chosen["keep_id"]), F.col(size) == chosen["keep_chars"]]
        return rows.join(chosen, [*same, *also], "left_semi")

    lone, crowded = winners.where(~F.col("clash")), _shared(winners)
    alone = staying(lone).withColumn(body, F.lit(None).cast("string"))
    shared = staying(crowded, _content(text_col) == crowded["content"]).withColumn(body, _content(text_col))
    return alone.unionByName(shared).dropDuplicates([id_col, key, body]).select([named(c) for c in docs.columns])
