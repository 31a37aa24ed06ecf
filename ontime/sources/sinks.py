"""Writing tables, snapshots and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.keytree import number_rows
from ontime.sources.versions import VersionedFolder


def now_iso() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; nulls become empty fields and blanks inside fields survive."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("nullValue", "")
        .csv(path)
    )


def envelopes(df: DataFrame, source: str, key: str, extracted_at: Column | None = None, records: int = 1_000) -> DataFrame:
    """Fold rows into envelopes ``source, extracted_at, part, records[]``: ``records`` rows each, in the order of a unique key.

    Part 0 holds the first rows, and so on; a small dimension is one part. Rows without a key follow in parts of null.
    """
    numbered = number_rows(df, key, "_no").withColumn("part", F.floor((F.col("_no") - 1) / F.lit(records)))
    record = F.struct(F.col("_no"), F.struct(*df.columns).alias("r"))
    return (
        numbered.groupBy("part").agg(F.sort_array(F.collect_list(record)).alias("_sorted"))  # at most ``records`` of them
        .select(
            F.lit(source).alias("source"),
            (extracted_at if extracted_at is not None else now_iso()).alias("extracted_at"),
            "part",
            F.transform("_sorted", lambda x: x["r"]).alias("records"),
        )
    )


def write_snapshot(df: DataFrame, path: str, source: str, key: str, extracted_at: Column | None = None, records: int = 1_000) -> str:
    """Store a snapshot as a new version of ``path``; until it is complete, readers keep the one before. Returns its folder."""
    written = envelopes(df, source, key, extracted_at, records)
    return VersionedFolder(df.sparkSession, path).publish(lambda folder: written.write.json(folder))


def write_report(report: DataFrame, path: str) -> None:
    """A report is one row, written as one JSON file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
