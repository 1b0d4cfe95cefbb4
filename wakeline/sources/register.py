"""Fleet registers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.values import parse_amount


# Fixed value: the encoding of registers as published.
REGISTER_ENCODING = "ISO-8859-1"


def scan_register_text(
    spark: SparkSession, path: str, encoding: str = REGISTER_ENCODING
) -> DataFrame:
    """Semicolon-separated register, every column a string named by the header.

    Characters are read in the encoding, which the header line shares.
    """
    return spark.read.csv(path, sep=";", header=True, encoding=encoding)


def typed_register(register: DataFrame) -> DataFrame:
    """The identity as int and the figures as double; unreadable values are NULL."""
    typed = register.withColumn("mmsi", F.col("mmsi").try_cast("int"))
    for figure in ("ton_gt", "power_main"):
        if figure in register.columns:
            typed = typed.withColumn(figure, parse_amount(F.col(figure).cast("string")))
    return typed


def scan_register(spark: SparkSession, path: str) -> DataFrame:
    return typed_register(scan_register_text(spark, path, encoding="UTF-8"))
