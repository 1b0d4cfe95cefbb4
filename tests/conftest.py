import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wakeline.schemas import POSITIONS  # noqa: E402
from wakeline.session import apply_settings  # noqa: E402

NOON = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture
def reports(spark):
    """Positions from (mmsi, seconds, lon, lat, speed); seconds may be None."""

    def build(rows):
        full = [
            (
                mmsi,
                lon,
                lat,
                0,
                speed,
                0.0,
                0.0,
                0,
                None if s is None else NOON + dt.timedelta(seconds=s),
            )
            for mmsi, s, lon, lat, speed in rows
        ]
        return spark.createDataFrame(full, POSITIONS)

    return build


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
