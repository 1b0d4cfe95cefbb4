"""Result files."""

from pyspark.sql import DataFrame


def write_result(
    result: DataFrame, path: str, fmt: str = "csv", files: int | None = None, **options
) -> None:
    """Overwrite ``path`` with the result as it is partitioned, or with ``files`` files.

    The files of a sorted result follow each other in its order, which spreading it
    would lose; and a fixed number is for results that do not grow with the reports.
    """
    if files is not None:
        result = result.repartition(files)
    if fmt == "csv":
        options = {"header": True, **options}
    result.write.mode("overwrite").format(fmt).options(**options).save(path)
