"""The published processes as jobs over files.

Each job reads its inputs, runs the operators and writes one folder per result.
Positions and messages are CSV globs, or, with the format ``parquet``, folders
written by ``store_positions`` and ``store_messages``, which is the faster choice for
more than one run. A window narrows both to the time of observation.
"""

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wakeline.functions.geo import Box
from wakeline.operators import cells, dwell, enrich, figures, flags, fleet, ports, registry
from wakeline.schemas import MESSAGES, POSITIONS
from wakeline.sources import ais, days, store
from wakeline.sources.mid import scan_mid_table
from wakeline.session import shared_folder
from wakeline.sources.register import REGISTER_ENCODING, scan_register, scan_register_text
from wakeline.sources.sinks import write_result


# Fixed value: the number of files of results of a fleet.
FLEET_FILES = 5


@dataclass(frozen=True)
class Window:
    """The observation window, start included and end not, in UTC."""

    start: str
    end: str

    @property
    def hours(self) -> float:
        length = dt.datetime.fromisoformat(self.end) - dt.datetime.fromisoformat(self.start)
        return length / dt.timedelta(hours=1)


def store_positions(spark: SparkSession, csv_path: str, out: str) -> int:
    """Add the files of the glob that the store lacks; tells how many."""
    return store.ingest(spark, ais.scan_positions, csv_path, out)


def store_messages(spark: SparkSession, csv_path: str, out: str) -> int:
    return store.ingest(spark, ais.scan_messages, csv_path, out)


def _read(
    spark: SparkSession,
    scan: Callable[[SparkSession, str], DataFrame],
    schema: StructType,
    path: str,
    window: Window | None,
    fmt: str,
) -> DataFrame:
    if fmt == "parquet":
        bounds = (window.start, window.end) if window else ()
        return store.read_stored(spark, path, schema, *bounds)
    if fmt != "csv":
        raise ValueError(f"format is csv or parquet, not {fmt}")
    reports = scan(spark, path)
    return ais.observed_between(reports, window.start, window.end) if window else reports


def read_positions(
    spark: SparkSession, path: str, window: Window | None = None, fmt: str = "csv"
) -> DataFrame:
    return _read(spark, ais.scan_positions, POSITIONS, path, window, fmt)


def read_messages(
    spark: SparkSession, path: str, window: Window | None = None, fmt: str = "csv"
) -> DataFrame:
    return _read(spark, ais.scan_messages, MESSAGES, path, window, fmt)


def reference_frame(
    spark: SparkSession,
    messages_path: str,
    country: str,
    out: str,
    mid_path: str | None = None,
    window: Window | None = None,
    fmt: str = "csv",
) -> None:
    """Fishing vessels of one country from static messages."""
    messages = read_messages(spark, messages_path, window, fmt)
    frame = flags.reference_frame(messages, scan_mid_table(spark, mid_path), country)
    write_result(frame, out, files=FLEET_FILES)


def fleet_statistics(
    spark: SparkSession,
    positions_path: str,
    messages_path: str,
    register_path: str,
    out: str,
    port: Box,
    home_port: str,
    window: Window | None = None,
    fmt: str = "csv",
) -> None:
    """Time in port, fishing activity and movement of a fleet."""
    register = scan_register(spark, register_path)
    positions = read_positions(spark, positions_path, window, fmt)
    messages = read_messages(spark, messages_path, window, fmt)
    messages = fleet.of_vessels(messages, fleet.fleet_ids(register))
    # One row per vessel in port and one at sea: the positions are read once for all.
    of_home = figures.fleet_with_home(register, home_port)
    found = _kept(
        figures.fleet_figures(positions, of_home, port),
        f"{shared_folder(spark)}/wakeline-figures-{uuid.uuid4().hex}",
    )
    _write_fleet(found, messages, window.hours if window else 24, out)


def store_days(spark: SparkSession, positions_path: str, out: str, port: Box) -> int:
    """Summarise the days of stored positions that are new or have changed."""
    return days.refresh(spark, positions_path, out, port)


def fleet_statistics_of_days(
    spark: SparkSession,
    positions_path: str,
    days_path: str,
    messages_path: str,
    register_path: str,
    out: str,
    port: Box,
    home_port: str,
    window: Window,
) -> None:
    """``fleet_statistics`` of whole days out of their summaries; positions are not read.

    The window begins and ends at midnight. Both paths of reports are stores.
    """
    first, end = (dt.datetime.fromisoformat(t) for t in (window.start, window.end))
    if any(t.time() != dt.time() for t in (first, end)):
        raise ValueError("days are whole: a window begins and ends at midnight")
    last = end.date() - dt.timedelta(days=1)
    summaries = days.read_days(spark, positions_path, days_path, port, first.date(), last)
    register = scan_register(spark, register_path)
    messages = read_messages(spark, messages_path, window, "parquet")
    messages = fleet.of_vessels(messages, fleet.fleet_ids(register))
    of_home = figures.fleet_with_home(register, home_port)
    found = _kept(
        figures.fleet_figures_of_days(summaries, of_home),
        f"{shared_folder(spark)}/wakeline-figures-{uuid.uuid4().hex}",
    )
    _write_fleet(found, messages, window.hours, out)


def _write_fleet(found: DataFrame, messages: DataFrame, hours: float, out: str) -> None:
    results = {
        "time_in_port": figures.time_in_port_of(found, hours),
        "time_fishing_activity": figures.fishing_activity_of(found),
        "movement_report": figures.movement_report_of(found, messages),
    }
    for name, result in results.items():
        write_result(result, f"{out}/{name}", files=FLEET_FILES)


def register_statistics(spark: SparkSession, register_path: str, out: str) -> None:
    write_result(registry.register_by_port(scan_register(spark, register_path)), out)


def trip(
    spark: SparkSession,
    positions_path: str,
    mmsi: int,
    port: Box,
    out: str,
    window: Window | None = None,
    fmt: str = "csv",
) -> None:
    """One vessel's reports at sea, in order of time over all files."""
    positions = read_positions(spark, positions_path, window, fmt)
    write_result(dwell.vessel_trip(positions, [mmsi], port), out)


def maps(
    spark: SparkSession,
    positions_path: str,
    out: str,
    mmsi: int | None = None,
    window: Window | None = None,
    fmt: str = "csv",
) -> None:
    """Cells of the traffic map, and of one vessel's route."""
    positions = read_positions(spark, positions_path, window, fmt)
    write_result(cells.traffic_cells(positions), f"{out}/traffic_cells")
    write_result(cells.traffic_intensity(positions), f"{out}/traffic_intensity")
    if mmsi is not None:
        write_result(cells.route_cells(positions, mmsi), f"{out}/route_cells")


def port_positions(
    spark: SparkSession,
    positions_path: str,
    ports_path: str,
    out: str,
    window: Window | None = None,
    fmt: str = "csv",
) -> None:
    """Positions inside the boxes of a ports table, as Parquet by port."""
    boxes = spark.read.csv(
        ports_path,
        header=True,
        schema="port_code string, west double, south double, east double, north double",
    )
    found = ports.positions_by_port(read_positions(spark, positions_path, window, fmt), boxes)
    found.write.mode("overwrite").partitionBy("port_code").parquet(out)


def complete_register(
    spark: SparkSession,
    register_path: str,
    pages_path: str,
    name_column: str,
    out: str,
    encoding: str = REGISTER_ENCODING,
) -> str:
    """Add scraped identities to a register by similar names; tells the result's encoding.

    ``pages_path`` holds downloaded pages as Parquet with page_id and html. The result
    has all matches of a name as comma lists and is written as the register is read, so it
    can be completed again; only where a value does not fit the encoding it is UTF-8. Every
    match is written beside it, as Parquet under ``out`` with ``-matches`` behind, and the
    lists in parts with ``-lists`` behind. ``out`` must not be the register itself.
    """
    register = scan_register_text(spark, register_path, encoding)
    register = register.withColumnRenamed(name_column, "name")
    links = enrich.vessel_links(enrich.page_links(spark.read.parquet(pages_path)))
    # Names and rows of the links are read apart; the pages are parsed once.
    stored = f"{shared_folder(spark)}/wakeline-links-{uuid.uuid4().hex}"
    links.write.parquet(stored)
    links = spark.read.schema(links.schema).parquet(stored)
    base = out.rstrip("/")
    matches = _kept(enrich.fuzzy_register_match(register, links), f"{base}-matches")
    lists = _kept(enrich.match_lists(matches), f"{base}-lists")
    result = enrich.with_match_lists(enrich.register_update(register, matches), lists)
    if encoding.upper() == REGISTER_ENCODING:
        texts = [c for c, kind in result.dtypes if kind == "string"]
        outside = reduce(lambda a, b: a | b, (F.col(c).rlike(r"[^\x00-\xFF]") for c in texts))
        if not result.where(outside).isEmpty():
            encoding = "UTF-8"
    result = result.withColumnRenamed("name", name_column)
    write_result(result, out, sep=";", encoding=encoding)
    return encoding


def _kept(result: DataFrame, path: str) -> DataFrame:
    result.write.mode("overwrite").parquet(path)
    return result.sparkSession.read.schema(result.schema).parquet(path)
