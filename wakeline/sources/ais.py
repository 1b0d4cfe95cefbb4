"""Position reports and static ship messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schemas import MESSAGES, POSITIONS


def scan_positions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-separated files with one header line; globs and gzip work.

    Column names come from the schema, so files with other or no names in their
    first line read the same. Malformed fields turn into NULL, and a header line
    repeated inside a file becomes a row without mmsi, which no fleet contains.
    """
    return spark.read.schema(POSITIONS).csv(path, header=True, enforceSchema=True)


def scan_messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(MESSAGES).csv(path, header=True, enforceSchema=True)


def observed_between(reports: DataFrame, start: str, end: str) -> DataFrame:
    """Reports with start <= timestamp < end; skips whole days of a stored table."""
    first, after = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    if "date" in reports.columns:
        last = after - F.expr("INTERVAL 1 MICROSECOND")
        reports = reports.where(F.col("date").between(F.to_date(first), F.to_date(last)))
    return reports.where((F.col("timestamp") >= first) & (F.col("timestamp") < after))
