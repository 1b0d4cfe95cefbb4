"""Schemas of the input tables. Nothing is inferred, so no file is read twice."""

from pyspark.sql import types as T

POSITIONS = T.StructType(
    [
        T.StructField("mmsi", T.IntegerType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("accuracy", T.IntegerType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("course", T.DoubleType()),
        T.StructField("rotation", T.DoubleType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The published header repeats one dimension name; the fourth is dim_d here.
MESSAGES = T.StructType(
    [
        T.StructField("mmsi", T.IntegerType()),
        T.StructField("imo", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("draught", T.DoubleType()),
        T.StructField("dim_a", T.IntegerType()),
        T.StructField("dim_b", T.IntegerType()),
        T.StructField("dim_c", T.IntegerType()),
        T.StructField("dim_d", T.IntegerType()),
        T.StructField("type_and_cargo", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

MID_TABLE = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)
