"""Gaps between reports, and the time they add up to."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import Box
from wakeline.functions.tracks import (
    SLICE_SECONDS,
    across_slices,
    inside_slice,
    spread_slices,
    with_next,
    with_slice,
)
from wakeline.functions.values import epoch_seconds, hours
from wakeline.operators.fleet import of_vessels

# Below MOORED_SPEED a report in port counts as lying still; between
# the other two a report at sea counts as fishing or steaming.
MOORED_SPEED = 4.0
MIN_SEA_SPEED = 0.5
MAX_SEA_SPEED = 20.0

# Reports with the same time follow each other in this order.
TIE_BREAK = ["timestamp", "lon", "lat", "speed"]

_COPIES_PER_ARRAY = 1_000_000


def gap_time(
    reports: DataFrame, counted: Column, alias: str, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Seconds per vessel from each counted report to the vessel's next report.

    Vessels without a counted report are absent; the last report has no gap, so a
    vessel whose only counted report is its last one has NULL.
    """
    # Copies of a report collapse before anything is shuffled by vessel. All but one
    # of them have a gap of zero.
    distinct = reports.groupBy("mmsi", *TIE_BREAK).agg(F.count("*").alias("copies"))
    seconds = F.unix_seconds("timestamp")
    sliced = spread_slices(with_slice(distinct, seconds, ["lon", "lat", "speed"], slice_seconds))
    gap = F.lead(seconds).over(inside_slice(TIE_BREAK)) - seconds
    zero_of_copies = F.when((F.col("copies") > 1) & F.col("timestamp").isNotNull(), F.lit(0))
    per_slice = (
        sliced.withColumn("gap", gap)
        .withColumn("counted", counted)
        .groupBy("mmsi", "slice")
        .agg(
            F.sum(
                F.when(F.col("counted"), F.coalesce(F.col("gap"), zero_of_copies))
            ).alias("inside"),
            F.max("counted").alias("any_counted"),
            F.max(F.col("counted") & F.col("gap").isNull()).alias("last_counted"),
            F.min(seconds).alias("first_s"),
            F.max(seconds).alias("last_s"),
        )
    )
    to_next_slice = F.lead("first_s").over(across_slices()) - F.col("last_s")
    inside, between = F.sum("inside"), F.sum("between")
    return (
        per_slice.withColumn("between", F.when(F.col("last_counted"), to_next_slice))
        .groupBy("mmsi")
        .agg(
            F.coalesce(inside + between, inside, between).alias(alias),
            F.max("any_counted").alias("any_counted"),
        )
        .where("any_counted")
        .drop("any_counted")
    )


def time_in_port(
    fleet_positions: DataFrame,
    port: Box,
    window_hours: float = 24,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Time each vessel lay in the port, and the rest of the observation window.

    The gap runs to the vessel's next report *in port*: an absence between two
    reports in port counts as port time when the report before it is slow.
    """
    in_port = fleet_positions.where(port.contains())
    total = gap_time(in_port, F.col("speed") < MOORED_SPEED, "time_in_port_s", slice_seconds)
    return total.withColumn("time_in_port_h", hours(F.col("time_in_port_s"))).withColumn(
        "time_out_port_or_no_signal_h",
        F.round(F.abs(F.col("time_in_port_h") - float(window_hours)), 2),
    )


def reports_at_sea(fleet_positions: DataFrame, home_ids: DataFrame, port: Box) -> DataFrame:
    """Out-of-port reports of the vessels of the home port."""
    return of_vessels(fleet_positions.where(port.excludes()), home_ids)


def time_fishing_activity(
    at_sea: DataFrame, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    moving = (F.col("speed") > MIN_SEA_SPEED) & (F.col("speed") < MAX_SEA_SPEED)
    total = gap_time(at_sea, moving, "time_fishing_activity_s", slice_seconds)
    return total.withColumn(
        "time_fishing_activity_h", hours(F.col("time_fishing_activity_s"))
    )


def _distinct_gaps(reports: DataFrame, slice_seconds: int) -> DataFrame:
    rest = [c for c in reports.columns if c not in ("mmsi", *TIE_BREAK)]
    order = [*TIE_BREAK, *rest]
    distinct = reports.groupBy(*reports.columns).agg(F.count("*").alias("copies"))
    sliced = with_slice(
        distinct, F.unix_seconds("timestamp"), ["lon", "lat", "speed"], slice_seconds
    )
    linked = with_next(
        sliced, order, F.col("timestamp"), F.min("timestamp"), "next_timestamp"
    )
    return linked.withColumn(
        "time_diff_next", F.unix_seconds("next_timestamp") - F.unix_seconds("timestamp")
    ).drop("slice", "next_timestamp")


def _repeat_copies(distinct: DataFrame) -> DataFrame:
    """One row per copy again; only the last copy keeps the gap, the others have zero."""
    block = F.lit(_COPIES_PER_ARRAY)
    blocks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / block))
    copies = F.sequence(
        F.col("block") * block, F.least((F.col("block") + 1) * block, F.col("copies")) - 1
    )
    is_last = F.col("copy") == F.col("copies") - 1
    zero = F.unix_seconds("timestamp") - F.unix_seconds("timestamp")
    return (
        distinct.withColumn("block", F.explode(blocks))
        .withColumn("copy", F.explode(copies))
        .withColumn("time_diff_next", F.when(is_last, F.col("time_diff_next")).otherwise(zero))
        .drop("copies", "block", "copy")
    )


def report_gaps(reports: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every report with the seconds to the vessel's next report."""
    return _repeat_copies(_distinct_gaps(reports, slice_seconds))


def vessel_trip(
    positions: DataFrame, mmsis: list[int], port: Box, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Out-of-port reports of the vessel with gap and epoch time, in order of time."""
    trip = positions.where(F.col("mmsi").isin(mmsis) & port.excludes())
    gaps = _distinct_gaps(trip, slice_seconds).withColumn(
        "time", epoch_seconds(F.col("timestamp"))
    )
    # Sorted before the copies come back: they would all sort into one partition.
    return _repeat_copies(gaps.orderBy("time", "mmsi", "lon", "lat", "speed"))
