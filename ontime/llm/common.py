"""Helpers that several operators of this folder share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import scratch_path

#: The white space of all contracts, [\x20\x09-\x0D]; ``bytes.split()`` splits at exactly these bytes.
SPACES = " \t\n\x0b\x0c\r"

#: Maps A-Z to a-z and leaves every other byte alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:6]}"
    return name


def ids_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, body binary): the whole text as UTF-8, null as empty."""
    return docs.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts; sizes the number of buckets, nothing else."""
    return docs.agg(F.sum(F.octet_length(named(text_col).cast("string")))).first()[0] or 0


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def link_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a list of links and, for each, the smallest node it is connected with."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return nodes, nodes[label]
