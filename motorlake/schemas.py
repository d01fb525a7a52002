"""Table schemas, and their CREATE TABLE statements."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ITEMS = _struct(
    id=T.StringType(),
    image_src=T.StringType(),
    p_text=T.StringType(),
    l_text=T.StringType(),
    at_text=T.StringType(),
    ingest_seq=T.LongType(),
)

CARS = _struct(
    id=T.StringType(),
    brand=T.StringType(),
    model=T.StringType(),
    price=T.DoubleType(),
    currency=T.StringType(),
    taxed=T.BooleanType(),
    year=T.IntegerType(),
    original_price_text=T.StringType(),
    scraped_at=T.TimestampType(),
)

TAGS = _struct(
    car_id=T.StringType(),
    attribute=T.StringType(),
    value=T.StringType(),
    seq=T.LongType(),
)

LEARNING_CURVE = _struct(iter=T.IntegerType(), RMSE=T.DoubleType())

def all_strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])
