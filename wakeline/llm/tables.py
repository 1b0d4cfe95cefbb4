"""Written tables in the shared folder, and text columns as byte arrays."""

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


# Text a task hands to Python at a time.
_BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Settings of the session that the operators rely on.

    Batches for Python are cut by bytes, as texts differ much in length. Workers on
    the driver's machine find the package wherever they start; a cluster gets it with
    --py-files, as any package.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))
    if spark.sparkContext.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment["PYTHONPATH"] = root


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it again.

    Lost executors then repeat no work from before this point. The files go when the
    session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start of each text and the bytes of all; a missing text is empty."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    starts = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if not len(column) or starts[-1] == starts[0]:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    data = np.frombuffer(column.buffers()[2], np.uint8)[starts[0] : starts[-1]]
    return starts - starts[0], data


def slices(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most max_bytes of text, one row at least."""
    for batch in batches:
        starts, _ = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            end = int(np.searchsorted(starts, starts[first] + max_bytes, "right")) - 1
            end = max(end, first + 1)
            yield batch.slice(first, end - first)
            first = end
