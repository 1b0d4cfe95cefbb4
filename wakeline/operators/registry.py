"""Register statistics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_by_port(register: DataFrame) -> DataFrame:
    """Ships, tonnage and power per port of registration, in order of the port.

    Sums run in exact decimals, so they do not depend on the order of addition.
    """

    def total(figure: str):
        return F.sum(F.col(figure).cast("decimal(24,4)")).cast("decimal(32,2)")

    return (
        register.groupBy("port_code")
        .agg(
            F.count("*").alias("number_of_ships"),
            total("ton_gt").alias("gross_tonnage_gt"),
            total("power_main").alias("power_kw"),
        )
        .orderBy("port_code")
    )
