"""Draught, speed, extent and distance per vessel."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import haversine_km, plausible_step, step_km
from wakeline.functions.tracks import (
    SLICE_SECONDS,
    across_slices,
    inside_slice,
    spread_slices,
    with_previous,
    with_slice,
)
from wakeline.functions.values import clipped_speed, draught_or_zero, epoch_seconds, exact

# A vessel whose clipped speed never exceeds this has not travelled.
ACTIVE_SPEED = 1.0

_TRACK_ORDER = ["time", "lon", "lat"]


def draught_stats(messages: DataFrame) -> DataFrame:
    """Draught in metres; messages carry tenths of a metre."""
    draught = draught_or_zero(F.col("draught"))
    return messages.groupBy("mmsi").agg(
        (F.avg(draught) / 10).alias("draught_avg_meters"),
        (F.max(draught) / 10).alias("draught_max_meters"),
        (F.min(draught) / 10).alias("draught_min_meters"),
    )


def _with_time(reports: DataFrame) -> DataFrame:
    return reports.withColumn("time", epoch_seconds(F.col("timestamp")))


def dedup_reports(reports: DataFrame) -> DataFrame:
    """One whole report per vessel, time and place: the one with the lowest speed.

    Missing speeds sort first, and the other columns decide between equal speeds.
    """
    keys = ["time", "mmsi", "lon", "lat"]
    timed = _with_time(reports)
    rest = ["speed", *(c for c in timed.columns if c not in (*keys, "speed"))]
    kept = timed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*keys, "kept.*").select(timed.columns)


def track_reports(reports: DataFrame) -> DataFrame:
    """``dedup_reports`` reduced to what movement needs, so copies fold before the shuffle.

    ``on_track`` marks reports that have a time and a place.
    """
    lowest_speed = F.when(~F.max(F.col("speed").isNull()), F.min("speed"))
    return (
        _with_time(reports)
        .groupBy("mmsi", *_TRACK_ORDER)
        .agg(lowest_speed.alias("speed"))
        .withColumn("speed", clipped_speed(F.col("speed")))
        .withColumn(
            "on_track",
            F.col("time").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull(),
        )
    )


def mean(total: Column, count: Column) -> Column:
    """A mean out of a decimal sum; without values it is missing."""
    return F.try_divide(total.cast("double"), count)


def speed_stats(track: DataFrame) -> DataFrame:
    return track.groupBy("mmsi").agg(
        F.max("speed").alias("speed_max"),
        F.min("speed").alias("speed_min"),
        mean(F.sum(exact(F.col("speed"))), F.count(exact(F.col("speed")))).alias("speed_avg"),
    )


def movement_extent(track: DataFrame) -> DataFrame:
    return track.groupBy("mmsi").agg(
        F.max("lat").alias("lat_max"),
        F.min("lat").alias("lat_min"),
        F.max("lon").alias("lon_max"),
        F.min("lon").alias("lon_min"),
    )


def track_endpoints(track: DataFrame) -> DataFrame:
    """First and last place of each vessel."""
    point = F.struct(*_TRACK_ORDER)
    return (
        track.where("on_track")
        .groupBy("mmsi")
        .agg(F.min(point).alias("first"), F.max(point).alias("last"))
        .select(
            "mmsi",
            F.col("first.lat").alias("first_lat"),
            F.col("first.lon").alias("first_lon"),
            F.col("last.lat").alias("last_lat"),
            F.col("last.lon").alias("last_lon"),
        )
    )


def track_steps(track: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Each place on the track with the one before it."""
    # Columns that no step needs would be read again for the edges of the slices.
    places = track.where("on_track").select("mmsi", *_TRACK_ORDER)
    places = with_slice(places, F.col("time"), ["lon", "lat"], slice_seconds)
    linked = with_previous(
        places,
        _TRACK_ORDER,
        F.struct("time", "lon", "lat"),
        F.max(F.struct("time", "lon", "lat")),
        "previous",
    )
    return linked.select(
        "mmsi",
        *_TRACK_ORDER,
        F.col("previous.lon").alias("prev_lon"),
        F.col("previous.lat").alias("prev_lat"),
    )


def _step_ends() -> tuple[Column, Column, Column, Column]:
    return F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon")


def with_step_km(steps: DataFrame) -> DataFrame:
    return steps.withColumn("step_km", step_km(*_step_ends()))


def valid_steps(steps: DataFrame) -> DataFrame:
    """Steps that pass validation, with their length."""
    return steps.where(plausible_step(*_step_ends())).withColumn(
        "step_km", haversine_km(*_step_ends())
    )


def _movement(track: DataFrame, slice_seconds: int) -> DataFrame:
    """All movement figures from one pass: per slice, then per vessel."""
    # Reports off the track sort first. A slice with a time holds them only for want
    # of a coordinate, and a step from there is no step.
    previous = inside_slice(["on_track", *_TRACK_ORDER])
    inside_km = F.when(
        F.col("on_track"),
        step_km(
            F.lag("lat").over(previous),
            F.lag("lon").over(previous),
            F.col("lat"),
            F.col("lon"),
        ),
    ).otherwise(F.lit(0.0))
    point = F.when(F.col("on_track"), F.struct(*_TRACK_ORDER))
    per_slice = (
        spread_slices(with_slice(track, F.col("time"), ["lon", "lat"], slice_seconds))
        .withColumn("km", inside_km)
        .groupBy("mmsi", "slice")
        .agg(
            F.count("*").alias("n"),
            F.max("speed").alias("speed_max"),
            F.min("speed").alias("speed_min"),
            F.sum(exact(F.col("speed"))).alias("speed_sum"),
            F.count(exact(F.col("speed"))).alias("speed_n"),
            F.max("lat").alias("lat_max"),
            F.min("lat").alias("lat_min"),
            F.max("lon").alias("lon_max"),
            F.min("lon").alias("lon_min"),
            F.sum(exact(F.col("km"))).alias("km"),
            F.min(point).alias("first"),
            F.max(point).alias("last"),
        )
    )
    before = F.last("last", ignorenulls=True).over(
        across_slices().rowsBetween(Window.unboundedPreceding, -1)
    )
    linked = per_slice.withColumn("before", before).withColumn(
        "bridge_km",
        step_km(
            F.col("before.lat"), F.col("before.lon"), F.col("first.lat"), F.col("first.lon")
        ),
    )
    return linked.groupBy("mmsi").agg(
        F.sum("n").alias("n_records"),
        F.max("speed_max").alias("speed_max"),
        F.min("speed_min").alias("speed_min"),
        mean(F.sum("speed_sum"), F.sum("speed_n")).alias("speed_avg"),
        F.max("lat_max").alias("lat_max"),
        F.min("lat_min").alias("lat_min"),
        F.max("lon_max").alias("lon_max"),
        F.min("lon_min").alias("lon_min"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        # In a narrower type, as the sum of two wide ones would drop a digit.
        (F.sum("km").cast("decimal(28,12)") + F.sum(exact(F.col("bridge_km"))))
        .cast("double")
        .alias("km"),
    )


def distance_travelled(track: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Kilometres over all valid steps; one place, or none, is 0 km."""
    return _movement(track, slice_seconds).select("mmsi", F.col("km").alias("distance_km"))


def movement_report(
    at_sea: DataFrame, messages: DataFrame, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Every movement figure of each vessel with reports at sea."""
    figures = _movement(track_reports(at_sea), slice_seconds)
    travelled = F.coalesce(F.col("speed_max"), F.lit(0.0)) > ACTIVE_SPEED
    return figures.join(draught_stats(messages), "mmsi", "left").select(
        "mmsi",
        "draught_avg_meters",
        "speed_max",
        "speed_min",
        "speed_avg",
        "lat_max",
        "lat_min",
        "lon_max",
        "lon_min",
        "n_records",
        F.col("first.lat").alias("first_lat"),
        F.col("first.lon").alias("first_lon"),
        F.col("last.lat").alias("last_lat"),
        F.col("last.lon").alias("last_lon"),
        F.when(travelled, F.col("km")).otherwise(F.lit(0.0)).alias("distance_km"),
    )
