"""Positions against many port boxes at once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_DEGREES = 0.1

# Some 60 bytes each, so at most about 12 MB on every executor.
MAX_BROADCAST_CELLS = 200_000


# A box is covered by cells of one size, the smallest that gives it at most so many, and one
# more, along its longer side. Sizes double from level to level.
CELLS_ALONG = 8


def _size(cell_degrees: float) -> Column:
    return F.lit(cell_degrees) * F.pow(F.lit(2.0), F.col("level"))


def _cell(coordinate: str, cell_degrees: float) -> Column:
    return F.floor(F.col(coordinate) / _size(cell_degrees))


def port_cells(ports: DataFrame, cell_degrees: float = CELL_DEGREES) -> DataFrame:
    """Each port once for every cell its box touches, under 100 for a box of any size.

    A box whose west lies east of its east reaches over 180 degrees: it has two parts.
    """
    west, east = F.col("west"), F.col("east")
    part = lambda low, high: F.struct(low.alias("west"), high.alias("east"))
    over = F.array(part(west, F.lit(180.0)), part(F.lit(-180.0), east))
    parts = F.when(west <= east, F.array(part(west, east))).otherwise(over)
    extent = F.greatest(east - west, F.col("north") - F.col("south"))
    doublings = F.ceil(F.log2(extent / (cell_degrees * CELLS_ALONG)))
    columns = F.sequence(_cell("west", cell_degrees), _cell("east", cell_degrees))
    rows = F.sequence(_cell("south", cell_degrees), _cell("north", cell_degrees))
    return (
        ports.where("west IS NOT NULL AND east IS NOT NULL AND south <= north")
        .withColumn("part", F.explode(parts))
        .withColumns({"west": F.col("part.west"), "east": F.col("part.east")})
        .where("west <= east")
        .drop("part")
        # A point has no logarithm.
        .withColumn("level", F.greatest(F.coalesce(doublings, F.lit(0)), F.lit(0)).cast("int"))
        .withColumn("cell_x", F.explode(columns))
        .withColumn("cell_y", F.explode(rows))
    )


def positions_by_port(
    positions: DataFrame, ports: DataFrame, cell_degrees: float = CELL_DEGREES
) -> DataFrame:
    """Each position once per port whose closed box contains it.

    Candidates meet by an equi-join on the cell, at each size of cells that some box
    has, and the box test decides. The cells are counted, up to the limit, before they
    are broadcast. Beyond it the join merges, and adaptive execution splits the cells
    with very many positions.
    """
    cells = port_cells(ports, cell_degrees)
    few = cells.limit(MAX_BROADCAST_CELLS + 1).count() <= MAX_BROADCAST_CELLS
    # Sizes double, so there are some ten levels.
    levels = sorted(row["level"] for row in cells.select("level").distinct().collect())
    located = (
        positions.withColumn("level", F.explode(F.array(*map(F.lit, levels or [0]))))
        .withColumn("cell_x", _cell("lon", cell_degrees))
        .withColumn("cell_y", _cell("lat", cell_degrees))
    )
    inside = F.col("lon").between(F.col("west"), F.col("east")) & F.col("lat").between(
        F.col("south"), F.col("north")
    )
    keys = ["level", "cell_x", "cell_y"]
    return (
        located.join(F.broadcast(cells) if few else cells.hint("merge"), keys)
        .where(inside)
        .select("port_code", *positions.columns)
    )
