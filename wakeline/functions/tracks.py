"""Neighbours along a vessel's track without one task per vessel.

One identity can hold a large part of all reports, so a window over a whole
vessel would put that part into a single task. Tracks are therefore cut into
time slices: a window runs inside (mmsi, slice), and a second one runs over one
row per slice to carry values across the cuts. The second is bounded by the
time span of the data, not by the number of reports.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 600
DAY_SECONDS = 86400

# Reports without a time sort first and have no neighbours; they are spread over
# this many slices of their own, before any real one.
_TIMELESS_SLICES = 4096
_TIMELESS_START = -(10**15)


def slice_start(epoch: Column, spread: list[str], seconds: int = SLICE_SECONDS) -> Column:
    """Start of the time slice in epoch seconds."""
    timeless = F.lit(_TIMELESS_START) - F.pmod(F.xxhash64(*spread), F.lit(_TIMELESS_SLICES))
    epoch = epoch.cast("bigint")
    return F.coalesce(epoch - F.pmod(epoch, F.lit(seconds)), timeless)


def day_of_slice(slice_: Column) -> Column:
    """The day (UTC) a slice starts on; slices of reports without a time have none."""
    day = F.floor(slice_ / DAY_SECONDS).cast("int")
    return F.when(slice_ > _TIMELESS_START, F.date_from_unix_date(day))


def with_slice(
    rows: DataFrame, epoch: Column, spread: list[str], seconds: int = SLICE_SECONDS
) -> DataFrame:
    return rows.withColumn("slice", slice_start(epoch, spread, seconds))


def spread_slices(sliced: DataFrame) -> DataFrame:
    """Send each slice to its own place.

    A window by (mmsi, slice) is content with rows that an earlier join already put
    together by mmsi, and would leave a large vessel in one task. Where no such join
    was, this is the shuffle the window needs anyway.
    """
    return sliced.repartition("mmsi", "slice")


def inside_slice(order: list[str]) -> Window:
    return Window.partitionBy("mmsi", "slice").orderBy(*order)


def across_slices() -> Window:
    return Window.partitionBy("mmsi").orderBy("slice")


def slice_edges(spread: DataFrame, **edges: Column) -> DataFrame:
    """Aggregates of each slice, taken from the rows that ``spread_slices`` moved.

    The hash needs every column, so the rows below the shuffle are the same as those
    of a window over them, and Spark reads and moves them once for both.
    """
    every = F.max(F.xxhash64(*spread.columns)).alias("_every")
    return (
        spread.groupBy("mmsi", "slice")
        .agg(*(edge.alias(name) for name, edge in edges.items()), every)
        .where("_every IS NOT NULL")
        .drop("_every")
    )


def with_next(
    rows: DataFrame, order: list[str], value: Column, first: Column, alias: str
) -> DataFrame:
    """Add ``value`` of the vessel's next row; ``first`` aggregates it for a slice.

    ``value`` must not be NULL on rows that have a place on the track.
    """
    return _with_neighbour(rows, order, first, alias, F.lead, value)


def with_previous(
    rows: DataFrame, order: list[str], value: Column, last: Column, alias: str
) -> DataFrame:
    """Add ``value`` of the vessel's previous row; ``last`` aggregates it for a slice."""
    return _with_neighbour(rows, order, last, alias, F.lag, value)


def _with_neighbour(rows, order, edge, alias, neighbour, value) -> DataFrame:
    spread = spread_slices(rows)
    edges = slice_edges(spread, _edge=edge).select(
        "mmsi", "slice", neighbour("_edge").over(across_slices()).alias("_far")
    )
    return (
        spread.withColumn("_near", neighbour(value).over(inside_slice(order)))
        .join(edges, ["mmsi", "slice"], "left")
        .withColumn(alias, F.coalesce("_near", "_far"))
        .drop("_near", "_far")
    )
