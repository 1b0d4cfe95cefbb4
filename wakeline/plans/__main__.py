"""Run a job from the command line.

    spark-submit --py-files wakeline.zip wakeline/plans/__main__.py \
        fleet_statistics positions messages register.csv results \
        4.2,51.2,4.6,51.6 YE "2016-01-01 00:00:00,2016-01-02 00:00:00" parquet

The arguments are those of the job in ``jobs.py``, in order; a box is west, south,
east, north, a window is start, end, and ``-`` stands for none.
"""

import sys

from pyspark.sql import SparkSession

from wakeline.functions.geo import Box
from wakeline.plans import jobs
from wakeline.session import apply_settings


def _box(text: str) -> Box:
    return Box(*(float(x) for x in text.split(",")))


def _window(text: str) -> jobs.Window:
    return jobs.Window(*text.split(","))


# What each job's arguments are read as.
JOBS = {
    "store_positions": (str, str),
    "store_messages": (str, str),
    "reference_frame": (str, str, str, str, _window, str),
    "fleet_statistics": (str, str, str, str, _box, str, _window, str),
    "store_days": (str, str, _box),
    "fleet_statistics_of_days": (str, str, str, str, str, _box, str, _window),
    "register_statistics": (str, str),
    "trip": (str, int, _box, str, _window, str),
    "maps": (str, str, int, _window, str),
    "port_positions": (str, str, str, _window, str),
    "complete_register": (str, str, str, str, str),
}


def run(spark: SparkSession, name: str, arguments: list[str]) -> None:
    readers = JOBS[name]
    if len(arguments) > len(readers):
        raise SystemExit(f"{name} takes at most {len(readers)} arguments")
    values = [None if text == "-" else read(text) for read, text in zip(readers, arguments)]
    getattr(jobs, name)(apply_settings(spark), *values)


if __name__ == "__main__":
    if len(sys.argv) < 2 or sys.argv[1] not in JOBS:
        raise SystemExit(f"usage: {sys.argv[0]} JOB ARGUMENT...; jobs: {', '.join(JOBS)}")
    run(SparkSession.builder.appName(sys.argv[1]).getOrCreate(), sys.argv[1], sys.argv[2:])
