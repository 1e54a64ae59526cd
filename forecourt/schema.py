"""Explicit schemas of the tables that cross a storage boundary."""

from pyspark.sql import types as T

RAW_COLUMNS = (
    "make", "model", "year", "price", "mileage", "body_type", "cylinders",
    "transmission", "fuel_type", "color", "location", "description",
)

# Header spellings accepted for the raw columns, in file order.
CSV_HEADER = (
    "Make", "Model", "Year", "Price", "Mileage", "Body Type", "Cylinders",
    "Transmission", "Fuel Type", "Color", "Location", "Description",
)

_RAW_TYPES = {
    "year": T.IntegerType(),
    "price": T.DoubleType(),
    "mileage": T.IntegerType(),
}

RAW = T.StructType(
    [T.StructField("listing_id", T.StringType())]
    + [T.StructField(c, _RAW_TYPES.get(c, T.StringType())) for c in RAW_COLUMNS]
)

PREDICTIONS = T.StructType([
    T.StructField(c, T.DoubleType())
    for c in ("actual", "predicted", "actual_log", "predicted_log")
])

ANOMALIES = T.StructType([
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("mileage", T.IntegerType()),
    T.StructField("body_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
])

METRICS = T.StructType([
    T.StructField("task", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# One isolation tree is a set of these rows; node 0 is its root.
ISOLATION_NODES = T.StructType([
    T.StructField("tree", T.IntegerType(), False),
    T.StructField("node", T.IntegerType(), False),
    T.StructField("feature", T.IntegerType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("path", T.DoubleType(), False),
])
