"""Reading orders, reference tables and snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.functions.numeric import nan_to_null
from ontime.session import path_exists
from ontime.sources import sinks
from ontime.sources.versions import VersionedFolder, current_or_plain

# The field texts that pandas reads as "no value".
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
             "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


class MissingSourceError(FileNotFoundError):
    """None of the places a required input may live in exists."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. Blanks inside fields are kept; NA tokens become null in every column.

    Fields are read as text first, so that a token such as ``NA`` in a number column is a null and any other
    text that is no number is an error instead of a silent null.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    columns = []
    for f in schema.fields:
        value = F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name))
        if not isinstance(f.dataType, T.StringType):
            value = F.btrim(value).cast(f.dataType)
        columns.append(value.alias(f.name))
    return raw.select(*columns)


def read_with_query(table: DataFrame, view: str, query: str) -> DataFrame:
    """Reference table read through SQL, so computed columns come from the query."""
    table.createOrReplaceTempView(view)
    return table.sparkSession.sql(query)


def district_query(view: str, key: str, population: str, area: str, others: Sequence[str] = ()) -> str:
    extra = "".join(f", {c}" for c in others)
    return (f"SELECT {key}, {population}, {area}, "
            f"round(try_divide({population}, {area}), 1) AS density{extra} FROM {view} ORDER BY {key}")


def read_reference(spark: SparkSession, path: str, create: Callable[[], DataFrame], replace: bool = False) -> DataFrame:
    """Read a reference table, creating it first when absent or when asked to replace it; a failed replacement leaves the old one."""
    if replace or current_or_plain(spark, path) is None:
        VersionedFolder(spark, path).publish(lambda folder: create().write.parquet(folder))
    return spark.read.parquet(current_or_plain(spark, path))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, records: str = "records") -> DataFrame:
    """Unnest the record array of one or many JSON envelopes: the current version of a stored snapshot, or plain files."""
    found = current_or_plain(spark, path)
    if found is None:
        raise MissingSourceError(f"there is no snapshot at {path}")
    written_here = found != path  # then there is one envelope a line; a file from elsewhere is one envelope
    return spark.read.schema(schema).option("multiLine", not written_here).json(found).select(F.inline(records))


def resolve_snapshot(spark: SparkSession, path: str, schema: T.StructType, fetch: Callable[[], DataFrame],
                     refresh: bool = False, source: str = "api", key: str | None = None,
                     on_fallback: Callable[[Exception], None] | None = None) -> DataFrame:
    """Stored snapshot unless a refresh is asked for; else fetch and store; else fall back; else raise.

    What is fetched is written beside the stored snapshot and takes its place only when it is whole, so a fetch or a write
    that fails, however late, leaves the old rows.
    """
    stored = current_or_plain(spark, path)
    if stored and not refresh:
        return read_snapshot(spark, path, schema)
    try:
        fresh = fetch()
        sinks.write_snapshot(fresh, path, source=source, key=key or fresh.columns[0])
    except Exception as error:
        if stored is None:
            raise RuntimeError(f"fetch failed ({error}) and there is no snapshot at {path}") from error
        if on_fallback:
            on_fallback(error)
    return read_snapshot(spark, path, schema)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored JSON report; nested values are reached as struct fields."""
    return spark.read.schema(schema).json(path)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        if path_exists(spark, path):
            return path
    raise MissingSourceError(f"none of {list(paths)} exists; run the job that writes it first")


def read_first(spark: SparkSession, paths: Sequence[str], read: Callable[[str], DataFrame],
               optional: bool = False) -> DataFrame | None:
    """Read the first path that exists; an optional input that is nowhere gives None."""
    try:
        return read(first_existing(spark, paths))
    except MissingSourceError:
        if optional:
            return None
        raise


def ingest(df: DataFrame) -> DataFrame:
    """NaN becomes null on the way in."""
    return nan_to_null(df)
