"""Gridded traffic, routes and trajectories."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import Box, grid
from wakeline.functions.tracks import (
    SLICE_SECONDS,
    across_slices,
    inside_slice,
    slice_edges,
    spread_slices,
    with_slice,
)

# The published map windows.
TRAFFIC_WINDOW = Box(2.0, 50.0, 8.0, 55.0)
ROUTE_WINDOW = Box(4.0, 50.0, 6.0, 55.0)

POINTS_PER_PART = 1000


def grid_cells(reports: DataFrame) -> DataFrame:
    """Reports with the two-digit cell they lie in."""
    return reports.withColumn("cell_lon", grid(F.col("lon"))).withColumn(
        "cell_lat", grid(F.col("lat"))
    )


def traffic_cells(reports: DataFrame, window: Box = TRAFFIC_WINDOW) -> DataFrame:
    """One report per cell of the map, the earliest, at the rounded coordinates.

    A minimum instead of a ranking: each task sends at most one row per cell, so a
    crowded cell stays small.
    """
    order = ["timestamp", "mmsi", "lon", "lat", "speed"]
    rest = [c for c in reports.columns if c not in order]
    first = (
        grid_cells(reports.where(window.contains()))
        .groupBy("cell_lon", "cell_lat")
        .agg(F.min(F.struct(*order, *rest)).alias("first"))
    )
    rounded = {"lon": F.col("cell_lon"), "lat": F.col("cell_lat")}
    return first.select(
        *(rounded.get(c, F.col(f"first.{c}")).alias(c) for c in reports.columns)
    )


def traffic_intensity(reports: DataFrame, window: Box = TRAFFIC_WINDOW) -> DataFrame:
    """Reports and vessels per cell, counted per vessel first."""
    return (
        grid_cells(reports.where(window.contains()))
        .groupBy("cell_lon", "cell_lat", "mmsi")
        .agg(F.count("*").alias("n"))
        .groupBy("cell_lon", "cell_lat")
        .agg(F.sum("n").alias("n_reports"), F.count("mmsi").alias("n_vessels"))
    )


def route_cells(reports: DataFrame, mmsi: int, window: Box = ROUTE_WINDOW) -> DataFrame:
    """Cells touched by one vessel, labelled with its identity."""
    cells = traffic_cells(reports.where(F.col("mmsi") == mmsi), window)
    return cells.withColumn("label", F.col("mmsi").cast("string"))


def vessel_trajectory(
    track: DataFrame,
    part_seconds: int = 86400,
    points_per_part: int = POINTS_PER_PART,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Trajectories as ordered lines, cut by day and after ``points_per_part`` places.

    A vessel's line is the sequence of its parts; a single row for a whole vessel
    would grow with its reports. A part ends with the first place of the next one, so
    no stretch of the track is lost at a cut; n_points and end_time count that place.
    """
    if part_seconds % slice_seconds:
        raise ValueError("part_seconds must be a multiple of slice_seconds")
    order = ["time", "lon", "lat"]
    part_start = F.col("slice") - F.pmod("slice", F.lit(part_seconds))
    sliced = with_slice(track.where("on_track"), F.col("time"), ["lon", "lat"], slice_seconds)
    places = spread_slices(sliced.select("mmsi", "slice", *order))
    earlier = (
        Window.partitionBy("mmsi", "part_start")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = (
        slice_edges(places, n=F.count("*"), head=F.min(F.struct(*order)))
        .withColumn("part_start", part_start)
        .select(
            "mmsi",
            "slice",
            "part_start",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.lead("head").over(across_slices()).alias("far"),
        )
    )
    inside = inside_slice(order)
    numbered = (
        places.withColumn("rank", F.row_number().over(inside))
        .withColumn("near", F.lead(F.struct(*order)).over(inside))
        .join(edges, ["mmsi", "slice"], "left")
        .withColumn("next", F.coalesce("near", "far"))
        .withColumn("part", F.floor((F.col("before") + F.col("rank") - 1) / points_per_part))
    )
    point = F.struct(*order)
    ends = F.max_by("next", point)
    line = F.array_compact(F.concat(F.array_sort(F.collect_list(point)), F.array(ends)))
    text = F.transform("line", lambda p: F.format_string("%.4f %.4f", p["lon"], p["lat"]))
    shape = F.when(F.size("line") == 1, F.lit("POINT (")).otherwise(F.lit("LINESTRING ("))
    return (
        numbered.groupBy("mmsi", "part_start", "part")
        .agg(line.alias("line"))
        .select(
            "mmsi",
            "part_start",
            "part",
            F.size("line").alias("n_points"),
            F.get("line", F.lit(0))["time"].alias("start_time"),
            F.element_at("line", -1)["time"].alias("end_time"),
            F.concat(shape, F.array_join(text, ", "), F.lit(")")).alias("wkt"),
        )
    )
