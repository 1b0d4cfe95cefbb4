import math
import random

import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators import movement
from wakeline.schemas import MESSAGES


def plausible(p, q):
    same = lambda a, b: (a > 0 and b > 0) or (a < 0 and b < 0)
    return (
        abs(p[0] - q[0]) < 0.5
        and abs(p[1] - q[1]) < 0.5
        and same(p[0], q[0])
        and same(p[1], q[1])
    )


def km(p, q):
    (lon1, lat1), (lon2, lat2) = p, q
    a = (
        math.sin(math.radians(lat2 - lat1) / 2) ** 2
        + math.cos(math.radians(lat1))
        * math.cos(math.radians(lat2))
        * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371.009 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def brute_report(rows):
    """One vessel after another, as (records, max, min, mean speed, km)."""
    lowest = {}
    for mmsi, s, lon, lat, speed in rows:
        kept = lowest.setdefault((mmsi, s, lon, lat), speed)
        lowest[(mmsi, s, lon, lat)] = (
            None if kept is None or speed is None else min(kept, speed)
        )
    result = {}
    for mmsi in sorted({r[0] for r in rows}):
        mine = {k: v for k, v in lowest.items() if k[0] == mmsi}
        speeds = [0.0 if v > 20 else v for v in mine.values() if v is not None]
        track = sorted(k[1:] for k in mine if None not in k)
        points = [t[1:] for t in track]
        length = sum(km(p, q) for p, q in zip(points, points[1:]) if plausible(p, q))
        top = max(speeds, default=None)
        result[mmsi] = (
            len(mine),
            top,
            min(speeds, default=None),
            round(sum(speeds) / len(speeds), 9) if speeds else None,
            round(length, 6) if (top or 0) > 1 else 0.0,
            points[0] if points else (None, None),
            points[-1] if points else (None, None),
        )
    return result


@pytest.mark.parametrize("slice_seconds", [1, 60, 10**6])
def test_report_equals_a_loop_over_vessels(spark, reports, slice_seconds):
    rng = random.Random(slice_seconds)
    rows = []
    for _ in range(400):
        row = (
            rng.choice([1, 1, 1, 2, 3, 4]),
            rng.choice([None, *range(0, 600, 11)]),
            rng.choice([None, 4.1, 4.2, 4.3, 9.0, -0.1, 0.1]),
            rng.choice([None, 51.1, 51.2, 51.25]),
            rng.choice([None, 0.5, 3.0, 19.0, 21.0]),
        )
        rows += [row] * rng.choice([1, 1, 3])
    rows += [(5, 0, 4.0, 51.0, 25.0), (5, 60, 4.1, 51.1, 30.0), (6, None, None, None, None)]
    empty = spark.createDataFrame([], MESSAGES)
    got = movement.movement_report(reports(rows), empty, slice_seconds).collect()
    expected = brute_report(rows)
    assert {r.mmsi for r in got} == set(expected)
    for r in got:
        mean = None if r.speed_avg is None else round(r.speed_avg, 9)
        assert (
            r.n_records,
            r.speed_max,
            r.speed_min,
            mean,
            round(r.distance_km, 6),
            (r.first_lon, r.first_lat),
            (r.last_lon, r.last_lat),
        ) == expected[r.mmsi]
        assert r.draught_avg_meters is None
    steps = movement.track_steps(movement.track_reports(reports(rows)), slice_seconds)
    per_vessel = movement.with_step_km(steps).groupBy("mmsi").agg(F.sum("step_km").alias("km"))
    direct = movement.distance_travelled(movement.track_reports(reports(rows)), slice_seconds)
    totals = {r.mmsi: round(r.distance_km, 6) for r in direct.collect()}
    for r in per_vessel.collect():
        assert totals[r.mmsi] == pytest.approx(round(r.km, 6), abs=2e-6)


def test_step_rules(spark):
    cases = [
        ((4.0, 51.0), (4.499, 51.0), True),
        ((4.0, 51.0), (4.5, 51.0), False),
        ((0.1, 51.0), (-0.1, 51.0), False),
        ((0.0, 51.0), (0.1, 51.0), False),
        ((-4.0, -51.0), (-4.1, -51.1), True),
    ]
    df = spark.createDataFrame(
        [(i, *p, *q) for i, (p, q, _) in enumerate(cases)],
        "i int, lon1 double, lat1 double, lon2 double, lat2 double",
    )
    ends = [F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")]
    got = df.select("i", geo.plausible_step(*ends), geo.step_km(*ends)).orderBy("i").collect()
    for (i, ok, length), (p, q, expected) in zip(got, cases):
        assert ok == expected
        assert length == pytest.approx(km(p, q) if expected else 0.0)


coordinates = st.tuples(st.floats(-180, 180), st.floats(-89, 89))


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(coordinates, coordinates), min_size=20, max_size=60))
def test_haversine_is_symmetric_and_zero_in_place(spark, pairs):
    df = spark.createDataFrame(
        [(*p, *q) for p, q in pairs], "lon1 double, lat1 double, lon2 double, lat2 double"
    )
    a = (F.col("lat1"), F.col("lon1"))
    b = (F.col("lat2"), F.col("lon2"))
    rows = df.select(
        geo.haversine_km(*a, *b), geo.haversine_km(*b, *a), geo.haversine_km(*a, *a)
    ).collect()
    for (there, back, stay), (p, q) in zip(rows, pairs):
        assert there == pytest.approx(back, abs=1e-6)
        assert there == pytest.approx(km(p, q), abs=1e-6)
        assert stay == 0


def test_draught_counts_missing_as_zero(spark):
    rows = [(1, 30.0), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "mmsi int, draught double")
    assert rows_of(movement.draught_stats(df)) == [(1, 1.5, 3.0, 0.0), (2, 0.0, 0.0, 0.0)]


def test_dedup_keeps_one_whole_report(reports):
    rows = [(1, 0, 4.0, 51.0, 5.0), (1, 0, 4.0, 51.0, 3.0), (1, 0, 4.1, 51.0, 9.0), (1, 0, None, 51.0, 1.0), (1, 0, None, 51.0, None)]
    got = movement.dedup_reports(reports(rows)).select("lon", "speed")
    assert rows_of(got) == [(None, None), (4.0, 3.0), (4.1, 9.0)]
