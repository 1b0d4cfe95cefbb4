"""The table of maritime identification digits (MID), the first three of an mmsi."""

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schemas import MID_TABLE

_OWN_TABLE = Path(__file__).resolve().parent.parent / "data" / "mid.csv"


def own_assignments() -> list[tuple[str, str]]:
    """The assignments that come with the package, by digits."""
    with _OWN_TABLE.open(encoding="utf-8", newline="") as lines:
        rows = csv.reader(line for line in lines if not line.startswith("#"))
        next(rows)
        return [(mid, country) for mid, country in rows]


def scan_mid_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """mid and country from a CSV file with those columns, else the package's own table.

    The own table lies beside the code on the driver, so its few hundred rows are
    handed over; executors need not see the file.
    """
    if path is None:
        return spark.createDataFrame(own_assignments(), MID_TABLE)
    return spark.read.schema(MID_TABLE).csv(path, header=True, enforceSchema=True, comment="#")


def bounded(mids: DataFrame) -> DataFrame:
    """One row per three-digit code, so never more than a thousand rows."""
    return (
        mids.where(F.col("mid").rlike("^[0-9]{3}$"))
        .groupBy("mid")
        .agg(F.min("country").alias("country"))
    )
