"""Time in port, fishing activity and movement of a fleet from one pass over its reports.

Each report lies in port, or at sea, or counts for neither. Both parts of a vessel are cut
into time slices, and one aggregate over the slices holds what all three results need: a
piece of the track. Pieces that follow each other combine into one, so slices give days, days
any window, and the days can be kept (``wakeline.sources.days``).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import Box, step_km
from wakeline.functions.tracks import DAY_SECONDS, SLICE_SECONDS, day_of_slice, with_slice
from wakeline.functions.values import clipped_speed, epoch_seconds, exact, hours
from wakeline.operators.dwell import MAX_SEA_SPEED, MIN_SEA_SPEED, MOORED_SPEED, TIE_BREAK
from wakeline.operators.movement import ACTIVE_SPEED, draught_stats, mean

_PLACE = ["time", "lon", "lat"]
_PART = ["mmsi", "at_sea"]

# Sums of sums keep this type, so that adding two of them drops no digit.
_SUM = "decimal(28,12)"


def fleet_with_home(register: DataFrame, port_code: str) -> DataFrame:
    """Every identity of the fleet, and whether a ship of the home port has it."""
    return (
        register.where(F.col("mmsi") > 1)
        .groupBy("mmsi")
        .agg(F.coalesce(F.max(F.col("port_code") == port_code), F.lit(False)).alias("home"))
    )


def _parts(positions: DataFrame, port: Box, at_sea: Column) -> DataFrame:
    """Distinct reports in port, and at sea where they count there, with their copies."""
    return (
        positions.withColumn(
            "at_sea", F.when(port.contains(), False).when(port.excludes() & at_sea, True)
        )
        .where("at_sea IS NOT NULL")
        .groupBy(*_PART, *TIE_BREAK)
        .agg(F.count("*").alias("copies"))
        .withColumn("time", epoch_seconds(F.col("timestamp")))
    )


def _sums(rows: DataFrame) -> DataFrame:
    """A row per vessel, part and slice."""
    slice_of = Window.partitionBy(*_PART, "slice")
    seconds = F.unix_seconds("timestamp")
    gap = F.lead(seconds).over(slice_of.orderBy(*TIE_BREAK)) - seconds
    moving = (F.col("speed") > MIN_SEA_SPEED) & (F.col("speed") < MAX_SEA_SPEED)
    counted = F.when(F.col("at_sea"), moving).otherwise(F.col("speed") < MOORED_SPEED)
    on_track = F.col("time").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    # Reports of one time and place follow each other, that of the lowest speed first, and
    # only that one counts for the movement. Steps between them are of no length.
    track = slice_of.orderBy("on_track", *_PLACE, "speed")
    previous = F.lag(F.struct(*_PLACE)).over(track)
    step = step_km(F.lag("lat").over(track), F.lag("lon").over(track), F.col("lat"), F.col("lon"))
    first = previous.isNull() | ~previous.eqNullSafe(F.struct(*_PLACE))
    zero_of_copies = F.when((F.col("copies") > 1) & F.col("timestamp").isNotNull(), F.lit(0))
    own_speed = F.when(F.col("is_first"), clipped_speed(F.col("speed")))
    point = F.when(F.col("on_track"), F.struct(*_PLACE))
    return (
        rows.withColumn("on_track", on_track)
        .withColumns(
            {
                "gap": gap,
                "counted": counted,
                "is_first": first,
                "km": F.when(F.col("on_track"), step).otherwise(F.lit(0.0)),
            }
        )
        .groupBy(*_PART, "slice")
        .agg(
            F.sum(F.when(F.col("counted"), F.coalesce("gap", zero_of_copies))).alias("inside"),
            F.max("counted").alias("any_counted"),
            F.max(F.col("counted") & F.col("gap").isNull()).alias("last_counted"),
            F.min(seconds).alias("first_s"),
            F.max(seconds).alias("last_s"),
            F.count_if("is_first").alias("n"),
            F.max(own_speed).alias("speed_max"),
            F.min(own_speed).alias("speed_min"),
            F.sum(exact(own_speed)).cast(_SUM).alias("speed_sum"),
            F.count(exact(own_speed)).alias("speed_n"),
            F.max("lat").alias("lat_max"),
            F.min("lat").alias("lat_min"),
            F.max("lon").alias("lon_max"),
            F.min("lon").alias("lon_min"),
            F.sum(exact(F.col("km"))).cast(_SUM).alias("km"),
            F.min(point).alias("first"),
            F.max(point).alias("last"),
        )
    )


def _slices(parts: DataFrame, slice_seconds: int) -> DataFrame:
    """The pieces of all slices. Rows move once, by slice."""
    # Copies that differ in speed must share a slice, also without a time.
    sliced = with_slice(parts, F.unix_seconds("timestamp"), ["lon", "lat"], slice_seconds)
    return _sums(sliced.repartition(*_PART, "slice"))


def combined(pieces: DataFrame, by: list[str], order: str) -> DataFrame:
    """Pieces that follow each other as one piece for each key, with the gaps between them.

    Pieces without a time come first in the order. The result has the columns of the
    pieces, and combining it further gives what combining all pieces at once gives.
    """
    across = Window.partitionBy(*by).orderBy(order)
    to_next = F.lead("first_s").over(across) - F.col("last_s")
    before = F.last("last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    bridge = step_km(F.col("before.lat"), F.col("before.lon"), F.col("first.lat"), F.col("first.lon"))
    inside, between = F.sum("inside"), F.sum("between")
    extremes = {c: (F.max if c.endswith("max") else F.min) for c in
                ("speed_max", "speed_min", "lat_max", "lat_min", "lon_max", "lon_min")}
    return (
        pieces.withColumns({"between": F.when(F.col("last_counted"), to_next), "before": before})
        .withColumn("bridge_km", bridge)
        .groupBy(*by)
        .agg(
            F.coalesce(inside + between, inside, between).alias("inside"),
            F.max("any_counted").alias("any_counted"),
            F.max_by("last_counted", order).alias("last_counted"),
            F.min("first_s").alias("first_s"),
            F.max("last_s").alias("last_s"),
            F.sum("n").alias("n"),
            *(of(c).alias(c) for c, of in extremes.items()),
            F.sum("speed_sum").cast(_SUM).alias("speed_sum"),
            F.sum("speed_n").alias("speed_n"),
            (F.sum("km").cast(_SUM) + F.sum(exact(F.col("bridge_km")))).cast(_SUM).alias("km"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )


def _figures(whole: DataFrame) -> DataFrame:
    return whole.select(
        *_PART, F.col("inside").alias("counted_s"), "any_counted", F.col("n").alias("n_records"),
        "speed_max", "speed_min", "lat_max", "lat_min", "lon_max", "lon_min",
        mean(F.col("speed_sum"), F.col("speed_n")).alias("speed_avg"),
        "first", "last", F.col("km").cast("double").alias("km"),
    )


def fleet_figures(
    positions: DataFrame, fleet: DataFrame, port: Box, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """One row per vessel and part: the counted seconds and every movement figure.

    The positions are read and joined with the fleet once, and move once by slice.
    """
    parts = _parts(positions.join(fleet, "mmsi"), port, F.col("home"))
    return _figures(combined(_slices(parts, slice_seconds), _PART, "slice"))


def day_summaries(
    positions: DataFrame, port: Box, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """One piece per vessel, part and day (UTC), of every vessel.

    They serve any fleet, home port and window of whole days. Reports without a time are
    pieces without a date.
    """
    if DAY_SECONDS % slice_seconds:
        raise ValueError("a day must be a whole number of slices")
    slices = _slices(_parts(positions.where("mmsi IS NOT NULL"), port, F.lit(True)), slice_seconds)
    dated = slices.withColumn("date", day_of_slice(F.col("slice")))
    return combined(dated, [*_PART, "date"], "slice")


def fleet_figures_of_days(days: DataFrame, fleet: DataFrame) -> DataFrame:
    """What ``fleet_figures`` gives of the reports of these days, out of their summaries."""
    mine = days.join(fleet, "mmsi").where(~F.col("at_sea") | F.col("home"))
    return _figures(combined(mine, _PART, "date"))


def _counted(figures: DataFrame, part: Column, alias: str) -> DataFrame:
    seconds = F.col("counted_s")
    return figures.where(part & F.col("any_counted")).select(
        "mmsi", seconds.alias(f"{alias}_s"), hours(seconds).alias(f"{alias}_h")
    )


def time_in_port_of(figures: DataFrame, window_hours: float = 24) -> DataFrame:
    """What ``dwell.time_in_port`` gives."""
    away = F.round(F.abs(F.col("time_in_port_h") - float(window_hours)), 2)
    found = _counted(figures, ~F.col("at_sea"), "time_in_port")
    return found.withColumn("time_out_port_or_no_signal_h", away)


def fishing_activity_of(figures: DataFrame) -> DataFrame:
    """What ``dwell.time_fishing_activity`` gives."""
    return _counted(figures, F.col("at_sea"), "time_fishing_activity")


def movement_report_of(figures: DataFrame, messages: DataFrame) -> DataFrame:
    """What ``movement.movement_report`` gives."""
    travelled = F.coalesce(F.col("speed_max"), F.lit(0.0)) > ACTIVE_SPEED
    return (
        figures.where("at_sea")
        .join(draught_stats(messages), "mmsi", "left")
        .select(
            "mmsi", "draught_avg_meters", "speed_max", "speed_min", "speed_avg",
            "lat_max", "lat_min", "lon_max", "lon_min", "n_records",
            F.col("first.lat").alias("first_lat"),
            F.col("first.lon").alias("first_lon"),
            F.col("last.lat").alias("last_lat"),
            F.col("last.lon").alias("last_lon"),
            F.when(travelled, F.col("km")).otherwise(F.lit(0.0)).alias("distance_km"),
        )
    )
