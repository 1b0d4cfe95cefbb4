"""A store of reports as Parquet by day and file, and the manifest of what it holds.

Each source file is a batch of its own. Its rows go to ``reports`` by date and batch, and
only then its line goes to ``manifest``; readers take the batches that the manifest names.
So a load that was broken off shows nothing and can be repeated, and a late report lies
beside the rows of its day's own file. A file that changed is a new batch, and the newest
one of a file counts.
"""

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.sources.ais import observed_between

_MANIFEST = "file string, size long, modified timestamp, batch string, date date, rows long"
_VERSION = ["file", "size", "modified", "batch"]

# Distinct vessels a row group's filter is made for; it shrinks where there are fewer.
_VESSELS = 100_000


def _batch() -> Column:
    """A file's version as letters and digits, by its path, size and time of change."""
    version = F.concat_ws("|", "file", "size", F.unix_micros("modified"))
    return F.concat(F.lit("b"), F.substring(F.sha2(version, 256), 1, 16))


def _with_version(files: DataFrame) -> DataFrame:
    """The rows of files with the version of the file each comes from."""
    return files.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).withColumn("batch", _batch())


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """A row per version of a source file and day: file, size, modified, batch, date, rows.

    A file without reports has one row without a date.
    """
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{store}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def ingest(
    spark: SparkSession,
    scan: Callable[[SparkSession, list[str]], DataFrame],
    path: str | list[str],
    store: str,
) -> int:
    """Add the files of a glob that the store does not hold yet; tells how many it added.

    Files are known by path, size and time of change, so repeating a load reads nothing,
    and a glob that grew reads its new files. The rebalance gives large days many writers
    and small ones one. Rows lie in order of vessel and time, and row groups have a filter
    of their vessels, so reading one vessel opens few of them.
    """
    # The contents are not selected, so files are listed but not read.
    listed = _with_version(spark.read.format("binaryFile").load(path)).select("path", *_VERSION)
    known = manifest(spark, store).select("batch").distinct()
    new = listed.join(known, "batch", "left_anti").select(listed.columns).collect()
    if not new:
        return 0
    reports = _with_version(scan(spark, [row["path"] for row in new]))
    (
        reports.drop("file", "size", "modified")
        .withColumn("date", F.to_date("timestamp"))
        .hint("rebalance", "date", "batch")
        .sortWithinPartitions("date", "batch", "mmsi", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#mmsi", "true")
        .option("parquet.bloom.filter.expected.ndv#mmsi", str(_VESSELS))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("date", "batch")
        .parquet(f"{store}/reports")
    )
    files = spark.createDataFrame(new, listed.schema).drop("path")
    schema = T.StructType([f for f in reports.schema.fields if f.name not in _VERSION])
    written = _reports(spark, store, schema).join(files.select("batch"), "batch", "left_semi")
    days = written.groupBy("batch", "date").agg(F.count("*").alias("rows"))
    (
        files.join(days, "batch", "left")
        .fillna({"rows": 0})
        .select(*_VERSION, "date", "rows")
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{store}/manifest")
    )
    return len(new)


def _reports(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    partitions = [T.StructField("date", T.DateType()), T.StructField("batch", T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *partitions])).parquet(
        f"{store}/reports"
    )


def _days(held: DataFrame) -> DataFrame:
    """date, batch and place of the newest versions; the first of a day has most rows."""
    newest = held.groupBy("file").agg(
        F.max(F.struct("modified", "size", "batch")).alias("newest")
    )
    current = held.where("rows > 0").join(
        newest.select(F.col("newest.batch").alias("batch")), "batch", "left_semi"
    )
    largest = Window.partitionBy("date").orderBy(F.desc("rows"), "batch")
    return current.select("date", "batch", F.row_number().over(largest).alias("place"))


def files_by_day(spark: SparkSession, store: str) -> DataFrame:
    """Each date that has reports, and the batches they come from as one text."""
    batches = F.array_join(F.array_sort(F.collect_list("batch")), ",")
    return (
        _days(manifest(spark, store))
        .where("date IS NOT NULL")
        .groupBy("date")
        .agg(batches.alias("files"))
    )


def _of(stored: DataFrame, days: DataFrame) -> DataFrame:
    named = days.select(F.col("date").alias("_date"), F.col("batch").alias("_batch"))
    same = (F.col("batch") == F.col("_batch")) & F.col("date").eqNullSafe(F.col("_date"))
    return stored.join(named, same, "left_semi")


def read_stored(
    spark: SparkSession,
    store: str,
    schema: T.StructType,
    start: str | None = None,
    end: str | None = None,
    dates: list[dt.date] | None = None,
) -> DataFrame:
    """Stored reports of the schema, all or those of a window or of some dates.

    A report that several files hold is there as often as in the file that holds it most
    often: copies within a file stay, those across files fold. Of each day the largest
    file is read as it is, and only the rows of the others are grouped and looked for in
    it. Where they are few, Spark broadcasts them by their measured size, and the large
    files do not move.
    """
    days, stored = _days(manifest(spark, store)), _reports(spark, store, schema)
    if start is not None:
        stored = observed_between(stored, start, end)
        first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
        days = days.where(F.col("date").between(first, last))
    if dates is not None:
        days, stored = (rows.where(F.col("date").isin(dates)) for rows in (days, stored))
    columns = schema.names
    main = _of(stored, days.where("place = 1")).select(columns)
    others = days.where("place > 1")
    if others.isEmpty():
        return main
    late = (
        _of(stored, others)
        .groupBy(*columns, "batch")
        .agg(F.count("*").alias("copies"))
        .groupBy(*(F.col(c).alias(f"{c}_late") for c in columns))
        .agg(F.max("copies").alias("copies"))
    )
    pairs = (F.col(c).eqNullSafe(F.col(f"{c}_late")) for c in columns)
    same = reduce(lambda left, right: left & right, pairs)
    held = main.join(late, same, "left_semi").groupBy(columns).agg(F.count("*").alias("held"))
    missing = (
        late.join(held, same, "left")
        .withColumn("missing", F.col("copies") - F.coalesce("held", F.lit(0)))
        .where("missing > 0")
        .select(
            *(F.col(f"{c}_late").alias(c) for c in columns),
            F.explode(F.sequence(F.lit(1), F.col("missing"))).alias("copy"),
        )
    )
    return main.unionAll(missing.select(columns))
