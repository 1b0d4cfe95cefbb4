import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from wakeline.functions.geo import Box
from wakeline.operators import dwell

BOX = Box(4.0, 51.0, 5.0, 52.0)


def low(value):
    """NULL sorts first."""
    return (value is not None, value if value is not None else 0)


def brute_gaps(rows):
    """Reports of each vessel in order with the seconds to the next one."""
    by_vessel = {}
    for row in rows:
        by_vessel.setdefault(row[0], []).append(row)
    for track in by_vessel.values():
        track.sort(key=lambda r: tuple(low(x) for x in (r[1], r[2], r[3], r[4])))
        for row, after in zip(track, [*track[1:], None]):
            known = after is not None and row[1] is not None and after[1] is not None
            yield row, after[1] - row[1] if known else None


def brute_total(rows, counted):
    total = {}
    for row, gap in brute_gaps(rows):
        if row[4] is not None and counted(row[4]):
            old = total.setdefault(row[0], None)
            if gap is not None:
                total[row[0]] = (old or 0) + gap
    return sorted(total.items(), key=lambda t: t[0])


def random_reports(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        row = (
            rng.choice([1, 1, 1, 2, 3, 4, 5]),
            rng.choice([None, *range(0, 400, 7)]),
            rng.choice([None, 4.1, 4.2]),
            rng.choice([51.1, 51.2]),
            rng.choice([None, 0.0, 3.9, 4.0, 10.0]),
        )
        rows += [row] * rng.choice([1, 1, 1, 2, 5])
    return rows


@pytest.mark.parametrize("slice_seconds", [1, 60, 10**6])
def test_gap_time_equals_a_loop_over_vessels(reports, slice_seconds):
    rows = random_reports(slice_seconds)
    got = dwell.gap_time(reports(rows), F.col("speed") < 4.0, "s", slice_seconds)
    assert rows_of(got) == brute_total(rows, lambda v: v < 4.0)


@pytest.mark.parametrize("slice_seconds", [1, 60, 10**6])
def test_report_gaps_keep_every_report(reports, slice_seconds):
    rows = random_reports(slice_seconds + 1)
    got = dwell.report_gaps(reports(rows), slice_seconds).select(
        "mmsi", F.unix_seconds("timestamp"), "lon", "lat", "speed", "time_diff_next"
    )
    noon = 1704110400
    expected = [
        (m, None if s is None else s + noon, lon, lat, v, gap)
        for (m, s, lon, lat, v), gap in brute_gaps(rows)
    ]
    key = lambda r: tuple(low(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)


def test_many_copies_come_back_in_blocks(reports, monkeypatch):
    monkeypatch.setattr(dwell, "_COPIES_PER_ARRAY", 3)
    rows = [(7, 0, 4.1, 51.1, 1.0)] * 10 + [(7, 30, 4.1, 51.1, 1.0)]
    gaps = sorted(
        r.time_diff_next if r.time_diff_next is not None else -1
        for r in dwell.report_gaps(reports(rows)).collect()
    )
    assert gaps == [-1, *[0] * 9, 30]


def test_time_in_port(reports):
    rows = [
        # slow, away, slow again: the absence counts, as the report before it is slow
        (10, 0, 4.5, 51.5, 1.0),
        (10, 100, 9.0, 51.5, 15.0),
        (10, 3600, 4.5, 51.5, 3.99),
        (10, 7200, 4.5, 51.5, 1.0),
        # exactly four knots is not slow
        (11, 0, 4.5, 51.5, 4.0),
        (11, 60, 4.5, 51.5, 4.0),
        # a single report has no gap
        (12, 0, 4.0, 51.0, 0.0),
        # corners belong to the box, a missing coordinate does not
        (13, 0, 4.0, 51.0, 0.0),
        (13, 10, 5.0, 52.0, 0.0),
        (13, 20, None, 51.5, 0.0),
    ]
    got = rows_of(dwell.time_in_port(reports(rows), BOX))
    assert got == [
        (10, 7200, 2.0, 22.0),
        (12, None, None, None),
        (13, 10, 0.0, 24.0),
    ]


def test_absence_longer_than_the_window(reports):
    rows = [(10, 0, 4.5, 51.5, 1.0), (10, 3600 * 30, 4.5, 51.5, 1.0)]
    assert rows_of(dwell.time_in_port(reports(rows), BOX, window_hours=48)) == [
        (10, 108000, 30.0, 18.0)
    ]


def test_out_of_port_is_strict_and_null_aware(reports):
    rows = [
        (1, 0, 4.0, 51.0, 1.0),
        (1, 1, 3.9, 51.5, 1.0),
        (1, 2, None, 53.0, 1.0),
        (1, 3, None, 51.5, 1.0),
    ]
    frame = reports(rows)
    assert frame.where(BOX.contains()).count() == 1
    assert [r.lat for r in frame.where(BOX.excludes()).orderBy("lat").collect()] == [51.5, 53.0]


def test_fishing_speed_limits_are_strict(reports):
    rows = [(1, 0, 9.0, 51.0, 0.5), (1, 10, 9.0, 51.0, 0.6), (1, 30, 9.0, 51.0, 20.0), (1, 70, 9.0, 51.0, 19.9)]
    assert rows_of(dwell.time_fishing_activity(reports(rows))) == [(1, 20, 0.01)]


def test_trip_is_sorted_and_leaves_the_port_out(reports):
    rows = [(1, 50, 9.0, 51.0, 1.0), (1, 0, 9.0, 51.0, 1.0), (1, 20, 4.5, 51.5, 1.0), (2, 0, 9.0, 51.0, 1.0)]
    trip = dwell.vessel_trip(reports(rows), [1], BOX).collect()
    assert [r.time_diff_next for r in trip] == [50, None]
    assert [r.time - trip[0].time for r in trip] == [0, 50]
