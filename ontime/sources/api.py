"""Shaping the weather service's requests and responses. The call itself is the caller's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators.keytree import number_rows, ordered_text
from ontime.sources.schemas import API_FIELDS, API_POINT

# Places one request may ask for.
BATCH = 100


def assign_batches(df: DataFrame, key: str, size: int = BATCH, name: str = "batch") -> DataFrame:
    """Deal places, in the order of their unique key, into requests of ``size``."""
    return number_rows(df, key, "_no").withColumn(name, F.floor((F.col("_no") - 1) / size)).drop("_no")


def ordered_concat(df: DataFrame, order_by: str, columns: Sequence[str], batch: str) -> DataFrame:
    """One request per batch: the values of each column in key order, joined by commas.

    A batch is one request; :func:`assign_batches` keeps it at ``BATCH`` places.
    """
    return ordered_text(df, [batch], order_by, columns)


def parse_response(body, point: T.StructType = API_POINT):
    """JSON text of an array of points, or of one bare point, as an array of points."""
    many = F.from_json(body, T.ArrayType(point))
    one = F.array(F.from_json(body, point))
    return F.when(F.substring(F.ltrim(body), 1, 1) == F.lit("{"), one).otherwise(many)


def rows_from_responses(places: DataFrame, responses: DataFrame, key: str, batch: str, body: str,
                        fields: Mapping[str, str] = API_FIELDS, point: T.StructType = API_POINT) -> DataFrame:
    """Attach each point to the place at the same position of its request.

    Positions follow key order within the batch; the shorter side decides how many rows come out.
    """
    position = F.row_number().over(Window.partitionBy(batch).orderBy(key)) - 1
    asked = places.select(key, F.col(batch), position.alias("_pos"))
    answered = responses.select(batch, F.posexplode(parse_response(F.col(body), point)).alias("_pos", "_point"))
    return asked.join(answered, [batch, "_pos"]).select(
        key, *[F.col(f"_point.current.{src}").alias(dst) for src, dst in fields.items()])
