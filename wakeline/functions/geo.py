"""Boxes, distances and the coordinate grid, as native column expressions."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius and the largest believable step between two reports.
EARTH_RADIUS_KM = 6371.009
MAX_STEP_DEGREES = 0.5


@dataclass(frozen=True)
class Box:
    """A closed lon/lat rectangle given by its south-west and north-east corners."""

    west: float
    south: float
    east: float
    north: float

    def contains(self, lon: str = "lon", lat: str = "lat") -> Column:
        return F.col(lon).between(self.west, self.east) & F.col(lat).between(
            self.south, self.north
        )

    def excludes(self, lon: str = "lon", lat: str = "lat") -> Column:
        """One coordinate outside is enough, even where the other is NULL."""
        x, y = F.col(lon), F.col(lat)
        return (x < self.west) | (x > self.east) | (y < self.south) | (y > self.north)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), 2)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def _same_strict_sign(a: Column, b: Column) -> Column:
    return ((a > 0) & (b > 0)) | ((a < 0) & (b < 0))


def plausible_step(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Under half a degree in both coordinates and no change of hemisphere."""
    return (
        (F.abs(lat2 - lat1) < MAX_STEP_DEGREES)
        & (F.abs(lon2 - lon1) < MAX_STEP_DEGREES)
        & _same_strict_sign(lat1, lat2)
        & _same_strict_sign(lon1, lon2)
    )


def step_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance of a plausible step; any other step, or none, counts 0 km."""
    return F.when(
        plausible_step(lat1, lon1, lat2, lon2), haversine_km(lat1, lon1, lat2, lon2)
    ).otherwise(F.lit(0.0))


def grid(coordinate: Column) -> Column:
    """Coordinate rounded half up to two digits."""
    return F.floor(coordinate * 100 + 0.5) / 100
