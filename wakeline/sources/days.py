"""Summaries of vessels by day beside a store of reports, kept up with its files.

A day's summaries lie under the version of the day, which names the files of its reports
and the port. When a late file changes a day, it has another version, and only that day is
read again. A manifest written last names what is complete.
"""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.functions.geo import Box
from wakeline.operators.figures import day_summaries
from wakeline.schemas import POSITIONS
from wakeline.sources import store

_DONE = "date date, version string"


def _versions(spark: SparkSession, reports: str, port: Box) -> DataFrame:
    version = F.sha2(F.concat_ws("|", "files", F.lit(repr(port))), 256)
    return store.files_by_day(spark, reports).select(
        "date", F.concat(F.lit("v"), F.substring(version, 1, 16)).alias("version")
    )


def _done(spark: SparkSession, summaries: str) -> DataFrame:
    try:
        return spark.read.schema(_DONE).parquet(f"{summaries}/manifest").distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _DONE)


def refresh(spark: SparkSession, reports: str, summaries: str, port: Box) -> int:
    """Summarise the stored days that are new or have changed; tells how many.

    Reports without a time belong to no day and are not summarised. Only these days are
    read. Summaries of versions that no longer count stay on disk.
    """
    wanted = _versions(spark, reports, port)
    # One short row for each day of the calendar.
    new = wanted.join(_done(spark, summaries), ["date", "version"], "left_anti").collect()
    if not new:
        return 0
    versions = spark.createDataFrame(new, _DONE)
    days = [row["date"] for row in new]
    positions = store.read_stored(spark, reports, POSITIONS, dates=days)
    (
        day_summaries(positions, port)
        .join(versions, "date")
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "mmsi")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "version")
        .parquet(f"{summaries}/days")
    )
    versions.coalesce(1).write.mode("append").parquet(f"{summaries}/manifest")
    return len(new)


def read_days(
    spark: SparkSession, reports: str, summaries: str, port: Box, first: dt.date, last: dt.date
) -> DataFrame:
    """The summaries of the days from first to last, both included.

    A day whose reports have changed since it was summarised is an error, not an old figure.
    """
    wanted = _versions(spark, reports, port).where(F.col("date").between(first, last))
    behind = wanted.join(_done(spark, summaries), ["date", "version"], "left_anti").limit(3).collect()
    if behind:
        raise ValueError(f"days to refresh first, among them {[str(r['date']) for r in behind]}")
    empty = day_summaries(spark.createDataFrame([], POSITIONS), port)
    if wanted.isEmpty():
        return empty.limit(0)
    fields = [f for f in empty.schema.fields if f.name != "date"]
    partitions = [T.StructField("date", T.DateType()), T.StructField("version", T.StringType())]
    stored = spark.read.schema(T.StructType([*fields, *partitions])).parquet(f"{summaries}/days")
    return (
        stored.where(F.col("date").between(first, last))
        .join(wanted, ["date", "version"], "left_semi")
        .select(empty.columns)
    )
