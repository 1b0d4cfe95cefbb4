"""Session settings the operators rely on, and the folder for written tables."""

from pyspark.sql import SparkSession

SETTINGS = {
    # AIS times are UTC; epoch seconds and date partitions follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    # AQE picks partition counts, joins by measured size and splits skewed join sides.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split them also where the split costs a later shuffle: a fleet too large to
    # broadcast is joined by mmsi, and one vessel can hold much of the reports.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: spark.checkpoint.dir, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
