"""The registered queries: each operator over the whole of the given tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import view
from checks.parameters import COUNTRY, END, HOME_PORT, MAP, PORT, START, VESSEL
from wakeline.functions.text import is_match, lcs_length, ratio
from wakeline.functions.values import (
    clipped_speed,
    draught_or_zero,
    epoch_seconds,
    parse_double,
    parse_int,
)
from wakeline.operators import (
    cells,
    dwell,
    enrich,
    figures,
    flags,
    fleet,
    movement,
    ports,
    registry,
)
from wakeline.schemas import POSITIONS
from wakeline.session import apply_settings, shared_folder
from wakeline.sources import ais, register as registers, store
from wakeline.sources.mid import scan_mid_table
from wakeline.sources.sinks import write_result

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The input tables of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self.views: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        if name not in self.views:
            self.views[name] = view(self.spark, self.sf_dir, name)
        return self.views[name]

    @property
    def positions(self) -> DataFrame:
        return self.view("positions")

    @property
    def messages(self) -> DataFrame:
        return self.view("messages")

    @property
    def register(self) -> DataFrame:
        return self.view("register")

    @property
    def fleet(self) -> DataFrame:
        return fleet.fleet_ids(self.register)

    @property
    def home(self) -> DataFrame:
        return fleet.home_port_ids(self.register, HOME_PORT)

    @property
    def fleet_positions(self) -> DataFrame:
        return fleet.of_vessels(self.positions, self.fleet)

    @property
    def fleet_messages(self) -> DataFrame:
        return fleet.of_vessels(self.messages, self.fleet)

    @property
    def at_sea(self) -> DataFrame:
        return dwell.reports_at_sea(self.fleet_positions, self.home, PORT)

    @property
    def track(self) -> DataFrame:
        return movement.track_reports(self.at_sea)

    @property
    def steps(self) -> DataFrame:
        return movement.track_steps(self.track)

    @property
    def mids(self) -> DataFrame:
        return scan_mid_table(self.spark)

    @property
    def page_links(self) -> DataFrame:
        return enrich.page_links(self.view("vessel_pages"))

    @property
    def vessel_links(self) -> DataFrame:
        return enrich.vessel_links(self.page_links)

    def written(self, name: str) -> str:
        """One folder per query and scale, which the next run overwrites."""
        scale = self.sf_dir.rstrip("/").rpartition("/")[2]
        return f"{shared_folder(self.spark)}/wakeline-{scale}-{name}"


def _epoch(reports: DataFrame) -> DataFrame:
    """Times as whole seconds, which compare alike in every engine."""
    seconds = F.unix_seconds("timestamp").alias("ts")
    return reports.select(*(seconds if c == "timestamp" else F.col(c) for c in reports.columns))


def _rounded(result: DataFrame, *columns: str) -> DataFrame:
    return result.withColumns({c: F.round(c, 6) for c in columns})


def _rounded_mean(result: DataFrame, column: str) -> DataFrame:
    """Speeds have few digits, so a mean can lie exactly between two rounded values,
    where the order of addition would decide in either engine. The SQL shifts alike."""
    return result.withColumn(column, F.round(F.col(column) + F.lit(1e-9), 6))


def _scan_positions(i: Inputs) -> DataFrame:
    path = i.written("positions")
    i.positions.write.mode("overwrite").csv(path, header=True, compression="gzip")
    return _epoch(ais.scan_positions(i.spark, path))


def _scan_messages(i: Inputs) -> DataFrame:
    path = i.written("messages")
    i.messages.write.mode("overwrite").csv(path, header=True, compression="gzip")
    return _epoch(ais.scan_messages(i.spark, path))


def _scan_register(i: Inputs) -> DataFrame:
    path = i.written("register")
    write_result(i.register, path, sep=";")
    return registers.scan_register(i.spark, path)


def _scan_latin1(i: Inputs) -> DataFrame:
    path = i.written("latin1")
    write_result(i.view("latin1_register"), path, sep=";", encoding="ISO-8859-1")
    return registers.scan_register_text(i.spark, path)


def _observation_window(i: Inputs) -> DataFrame:
    """Files of two accuracies come one after the other, and with them all days late."""
    files, stored = i.written("files"), f"{i.written('by-date')}-{uuid.uuid4().hex}"
    for accuracy in (0, 1):
        part = i.positions.where(F.col("accuracy") == accuracy)
        part.write.mode("overwrite").csv(f"{files}/{accuracy}", header=True, compression="gzip")
        paths = [f"{files}/{n}" for n in range(accuracy + 1)]
        store.ingest(i.spark, ais.scan_positions, paths, stored)
    return _epoch(store.read_stored(i.spark, stored, POSITIONS, START, END))


def _sink_roundtrip(i: Inputs) -> DataFrame:
    path = i.written("time-in-port")
    result = dwell.time_in_port(i.fleet_positions, PORT)
    write_result(result, path)
    return i.spark.read.schema(result.schema).csv(path, header=True)


def _register_typed(i: Inputs) -> DataFrame:
    text = i.register.select(*(F.col(c).cast("string") for c in i.register.columns))
    comma = F.replace(F.col("ton_gt"), F.lit("."), F.lit(","))
    return registers.typed_register(text.withColumn("ton_gt", comma))


def _register_by_port(i: Inputs) -> DataFrame:
    amounts = {c: F.col(c).cast("double") for c in ("gross_tonnage_gt", "power_kw")}
    return registry.register_by_port(i.register).withColumns(amounts)


def _movement_report(i: Inputs) -> DataFrame:
    report = movement.movement_report(i.at_sea, i.fleet_messages)
    return _rounded_mean(_rounded(report, "draught_avg_meters", "distance_km"), "speed_avg")


def _figures(i: Inputs) -> DataFrame:
    """The three results of a fleet side by side, out of one pass."""
    of_home = figures.fleet_with_home(i.register, HOME_PORT)
    return _three(i, figures.fleet_figures(i.positions, of_home, PORT))


def _figures_by_day(i: Inputs) -> DataFrame:
    """The same out of summaries by day, which are written first."""
    path = i.written("days")
    summaries = figures.day_summaries(i.positions, PORT)
    summaries.write.mode("overwrite").partitionBy("date").parquet(path)
    days = i.spark.read.schema(summaries.schema).parquet(path)
    of_home = figures.fleet_with_home(i.register, HOME_PORT)
    return _three(i, figures.fleet_figures_of_days(days, of_home))


def _three(i: Inputs, found: DataFrame) -> DataFrame:
    in_port = figures.time_in_port_of(found).select("mmsi", "time_in_port_s")
    at_sea = figures.fishing_activity_of(found).select("mmsi", "time_fishing_activity_s")
    moved = figures.movement_report_of(found, i.fleet_messages)
    moved = moved.select("mmsi", "n_records", "speed_max", "distance_km")
    return _rounded(in_port.join(at_sea, "mmsi", "full").join(moved, "mmsi", "full"), "distance_km")


def _trajectory(i: Inputs) -> DataFrame:
    parts = cells.vessel_trajectory(i.track)
    return parts.withColumn("part", F.col("part").cast("int"))


def _name_similarity(i: Inputs) -> DataFrame:
    links = i.vessel_links.select("page_id", F.col("name").alias("link_name"))
    names = i.view("name_register").where(F.col("name") != "").select("reg_id", "name")
    pairs = names.join(links, F.col("reg_id") == F.col("page_id").cast("string"))
    total = F.length("name") + F.length("link_name")
    return pairs.withColumn("lcs", lcs_length(F.lower("name"), F.lower("link_name"))).select(
        "reg_id",
        "name",
        "link_name",
        F.round(ratio(F.col("lcs"), total), 6).alias("ratio"),
        is_match(F.col("lcs"), total).alias("is_match"),
    )


def _links(i: Inputs) -> DataFrame:
    """The links as a table: they are used several times, and pages are read for them once."""
    path = i.written("links")
    i.vessel_links.write.mode("overwrite").parquet(path)
    return i.spark.read.schema(i.vessel_links.schema).parquet(path)


def _matches(i: Inputs) -> DataFrame:
    return enrich.fuzzy_register_match(i.view("name_register"), _links(i))


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and sinks
    "scan_positions_csv": _scan_positions,
    "scan_messages_csv": _scan_messages,
    "scan_register_csv": _scan_register,
    "scan_register_latin1": _scan_latin1,
    "observation_window": _observation_window,
    "sink_csv_roundtrip": _sink_roundtrip,
    # values
    "draught_cleaned": lambda i: _epoch(
        i.messages.select("mmsi", "timestamp", draught_or_zero(F.col("draught")).alias("draught"))
    ),
    "register_typed": _register_typed,
    "vessel_flag_state": lambda i: flags.vessel_flag_state(i.messages, i.mids),
    "safe_numeric": lambda i: i.view("raw_numbers").select(
        "p_partkey",
        parse_double(F.col("raw")).alias("as_double"),
        parse_int(F.col("raw")).alias("as_int"),
    ),
    "speed_clipped": lambda i: _epoch(
        i.positions.select("mmsi", "timestamp", clipped_speed(F.col("speed")).alias("speed"))
    ),
    "epoch_seconds": lambda i: i.positions.select(
        "mmsi", epoch_seconds(F.col("timestamp")).alias("time")
    ),
    "grid_cells": lambda i: cells.grid_cells(i.positions.select("mmsi", "lon", "lat")),
    # filters and fleets
    "fishing_type_messages": lambda i: _epoch(
        flags.fishing_messages(i.messages).select("mmsi", "name", "timestamp")
    ),
    "reference_frame": lambda i: flags.reference_frame(i.messages, i.mids, COUNTRY),
    "fleet_ids": lambda i: i.fleet,
    "home_port_ids": lambda i: i.home,
    "fleet_positions": lambda i: _epoch(i.fleet_positions),
    "fleet_messages": lambda i: _epoch(
        i.fleet_messages.select("mmsi", "imo", "name", "callsign", "draught", "timestamp")
    ),
    "home_port_positions": lambda i: _epoch(fleet.of_vessels(i.positions, i.home)),
    "active_vessels": lambda i: fleet.active_vessels(i.positions, i.home),
    "positions_in_port": lambda i: _epoch(i.fleet_positions.where(PORT.contains())),
    "positions_out_of_port": lambda i: _epoch(i.fleet_positions.where(PORT.excludes())),
    "positions_by_port": lambda i: _epoch(ports.positions_by_port(i.positions, i.view("ports"))),
    # time in port and at sea
    "report_gaps": lambda i: _epoch(dwell.report_gaps(i.fleet_positions)),
    "time_in_port": lambda i: dwell.time_in_port(i.fleet_positions, PORT),
    "time_fishing_activity": lambda i: dwell.time_fishing_activity(i.at_sea),
    "vessel_trip": lambda i: _epoch(dwell.vessel_trip(i.positions, [VESSEL], PORT)),
    # movement
    "draught_stats": lambda i: _rounded(
        movement.draught_stats(i.fleet_messages), "draught_avg_meters"
    ),
    "draught_in_window": lambda i: _rounded(
        movement.draught_stats(ais.observed_between(i.fleet_messages, START, END)),
        "draught_avg_meters",
    ),
    "dedup_reports": lambda i: _epoch(movement.dedup_reports(i.at_sea)),
    "speed_stats": lambda i: _rounded_mean(movement.speed_stats(i.track), "speed_avg"),
    "movement_extent": lambda i: movement.movement_extent(i.track),
    "track_endpoints": lambda i: movement.track_endpoints(i.track),
    "track_steps": lambda i: i.steps,
    "haversine_steps": lambda i: _rounded(movement.with_step_km(i.steps), "step_km").drop(
        "prev_lon", "prev_lat"
    ),
    "valid_steps": lambda i: _rounded(movement.valid_steps(i.steps), "step_km"),
    "distance_travelled": lambda i: _rounded(
        movement.distance_travelled(i.track), "distance_km"
    ),
    "movement_report": _movement_report,
    "fleet_figures": _figures,
    "fleet_figures_by_day": _figures_by_day,
    # register statistics
    "register_by_port": _register_by_port,
    # cells and trajectories
    "traffic_cells": lambda i: _epoch(cells.traffic_cells(i.positions)),
    "traffic_intensity": lambda i: cells.traffic_intensity(i.positions),
    "route_cells": lambda i: _epoch(cells.route_cells(i.positions, VESSEL, MAP)),
    "vessel_trajectory": _trajectory,
    # register completion
    "page_links": lambda i: i.page_links.select("page_id", "href"),
    "page_links_of_pages": lambda i: enrich.page_links(
        i.view("all_pages"), container="body", css_class=None
    ).select("page_id", "href"),
    "vessel_links": lambda i: i.vessel_links.select("page_id", "name", "imo", "mmsi"),
    "name_similarity": _name_similarity,
    "name_matches": lambda i: enrich.name_matches(i.view("name_register"), _links(i)),
    "fuzzy_register_match": lambda i: _matches(i).drop("part", "pos"),
    "register_update": lambda i: enrich.register_update(i.view("name_register"), _matches(i)),
    "match_lists": lambda i: enrich.match_lists(_matches(i)),
}


def registered() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}
