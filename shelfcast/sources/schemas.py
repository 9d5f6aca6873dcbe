"""Declared input tables; all names are lower snake case."""

from pyspark.sql import types as T

MARKDOWNS = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_STORES = _struct(
    ("store", T.IntegerType()),
    ("type", T.StringType()),
    ("size", T.IntegerType()),
)

# Dates stay text: they come in three formats and are parsed before any join.
RAW_FEATURES = _struct(
    ("store", T.IntegerType()),
    ("date", T.StringType()),
    ("temperature", T.DoubleType()),
    ("fuel_price", T.DoubleType()),
    *[(name, T.DoubleType()) for name in MARKDOWNS],
    ("cpi", T.DoubleType()),
    ("unemployment", T.DoubleType()),
    ("isholiday", T.StringType()),
)

RAW_SALES = _struct(
    ("store", T.IntegerType()),
    ("dept", T.IntegerType()),
    ("date", T.StringType()),
    ("weekly_sales", T.DoubleType()),
    ("isholiday", T.StringType()),
)

PREDICTIONS = _struct(
    ("store", T.IntegerType()),
    ("dept", T.IntegerType()),
    ("date", T.DateType()),
    ("predicted_weekly_sales", T.DoubleType()),
)

# Declared tables by layer, as name -> schema.
SOURCES = {
    "raw": {"stg_stores": RAW_STORES, "stg_features": RAW_FEATURES, "stg_sales": RAW_SALES},
    "analytics": {"predicted_weekly_sales": PREDICTIONS},
}
