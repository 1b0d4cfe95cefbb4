"""Which vessels belong to a fleet, and their reports.

Identities stay in DataFrames and filter by left semi join. No join is hinted:
Spark broadcasts the identities where their measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where
adaptive execution splits the partitions of vessels with very many reports.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fleet_ids(register: DataFrame) -> DataFrame:
    """All registered identities that can be real ones."""
    return register.where(F.col("mmsi") > 1).select("mmsi").distinct()


def home_port_ids(register: DataFrame, port_code: str) -> DataFrame:
    return (
        register.where((F.col("port_code") == port_code) & F.col("mmsi").isNotNull())
        .select("mmsi")
        .distinct()
    )


def of_vessels(reports: DataFrame, ids: DataFrame) -> DataFrame:
    """Reports or messages of the given vessels."""
    return reports.join(ids, "mmsi", "left_semi")


def of_listed(reports: DataFrame, mmsis: list[int]) -> DataFrame:
    """Reports or messages of a few vessels named one by one."""
    return reports.where(F.col("mmsi").isin(mmsis))


def active_vessels(positions: DataFrame, ids: DataFrame) -> DataFrame:
    """The given vessels that sent at least one position."""
    return of_vessels(positions, ids).select("mmsi").distinct()
