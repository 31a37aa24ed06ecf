"""Explicit schemas; no source is read by inference."""

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("prep_min", T.DoubleType()),
    T.StructField("items", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("dow", T.IntegerType()),
    T.StructField("district", T.StringType()),
    T.StructField("weather", T.StringType()),
    T.StructField("traffic", T.StringType()),
    T.StructField("vehicle", T.StringType()),
    T.StructField("shop_type", T.StringType()),
    T.StructField("experience_months", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("active_orders", T.IntegerType()),
    T.StructField("delivery_min", T.DoubleType()),
    T.StructField("late", T.IntegerType()),
])

DISTRICTS = T.StructType([
    T.StructField("district", T.StringType(), False),
    T.StructField("population", T.LongType(), False),
    T.StructField("area_km2", T.DoubleType(), False),
    T.StructField("class", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
])

WEATHER = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("humidity_pct", T.LongType()),
    T.StructField("wind_kmh", T.DoubleType()),
    T.StructField("precipitation_mm", T.DoubleType()),
])


def envelope(record: T.StructType, source: str = "source", extracted_at: str = "extracted_at",
             records: str = "records", part: str = "part") -> T.StructType:
    """A snapshot file: where and when the records were taken, which part of them it holds, and the records."""
    return T.StructType([
        T.StructField(source, T.StringType()),
        T.StructField(extracted_at, T.StringType()),
        T.StructField(part, T.LongType()),
        T.StructField(records, T.ArrayType(record)),
    ])


# Measurements of the weather service and the columns they fill.
API_FIELDS = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_kmh",
    "precipitation": "precipitation_mm",
}

API_POINT = T.StructType([
    T.StructField("current", T.StructType([
        T.StructField("temperature_2m", T.DoubleType()),
        T.StructField("relative_humidity_2m", T.LongType()),
        T.StructField("wind_speed_10m", T.DoubleType()),
        T.StructField("precipitation", T.DoubleType()),
    ])),
])
