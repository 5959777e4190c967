"""Explicit schemas of the tables the package reads and writes."""

from pyspark.sql import types as T

FLOATS = T.ArrayType(T.FloatType())
# Without NULL among the values, which Spark then need not look for in each of them.
FILLED_FLOATS = T.ArrayType(T.FloatType(), containsNull=False)

CATALOGUE = T.StructType([
    T.StructField("image_id", T.LongType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("file_name", T.StringType()),
    T.StructField("directory", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("mtime", T.DoubleType()),
])

# Feature tables carry the size and time of the file they were made from, so a
# changed file is noticed without rewriting any vector.
FEATURES = T.StructType([
    T.StructField("image_id", T.LongType(), False),
    T.StructField("file_size", T.LongType()),
    T.StructField("mtime", T.DoubleType()),
    T.StructField("vector", FLOATS),
])

IMAGE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

HITS = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("image_id", T.LongType(), False),
    T.StructField("score", T.DoubleType(), False),
])
