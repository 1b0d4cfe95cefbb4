import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from wakeline.functions.geo import Box
from wakeline.operators import cells, movement, ports


def test_traffic_cells_keep_the_earliest_report(reports):
    rows = [
        (1, 30, 4.0051, 51.0, 1.0),
        (2, 10, 4.0062, 51.0, 2.0),
        (3, 10, 4.0062, 51.0, 3.0),
        (4, 0, 4.0151, 51.0, 4.0),
        (5, 0, 1.99, 51.0, 5.0),
        (6, 0, None, 51.0, 6.0),
    ]
    got = cells.traffic_cells(reports(rows)).select("mmsi", "lon", "lat")
    assert rows_of(got) == [(2, 4.01, 51.0), (4, 4.02, 51.0)]
    intensity = cells.traffic_intensity(reports(rows + rows[:1]))
    assert rows_of(intensity) == [(4.01, 51.0, 4, 3), (4.02, 51.0, 1, 1)]
    route = cells.route_cells(reports(rows), 1).select("mmsi", "lon", "label")
    assert rows_of(route) == [(1, 4.01, "1")]


def test_grid_rounds_half_up(spark):
    df = spark.createDataFrame([(1.124,), (1.125,), (-1.126,)], "x double")
    got = [r[0] for r in df.select(cells.grid(F.col("x"))).collect()]
    assert got == [1.12, 1.13, -1.13]


def test_trajectory_parts_draw_every_step(reports):
    """Parts are bounded, and their stretches are the steps of the track, over midnight too."""
    rng = random.Random(3)
    rows = [(1, rng.randrange(200000), rng.randrange(10) / 10, 51.0, 1.0) for _ in range(500)]
    rows += [(2, 5, 4.0, 51.0, 1.0), (3, 43190, 4.0, 51.0, 1.0), (3, 43210, 4.1, 51.0, 1.0)]
    track = movement.track_reports(reports(rows))
    parts = cells.vessel_trajectory(track, points_per_part=7).collect()
    assert all(p.n_points <= 8 for p in parts)
    drawn = {}
    for p in sorted(parts, key=lambda p: (p.mmsi, p.part_start, p.part)):
        body = p.wkt[p.wkt.index("(") + 1 : -1].split(", ")
        assert len(body) == p.n_points
        assert p.wkt.startswith("POINT" if p.n_points == 1 else "LINESTRING")
        drawn.setdefault(p.mmsi, []).extend(zip(body, body[1:], strict=False))
    steps = {}
    for s in movement.track_steps(track).orderBy("mmsi", "time", "lon", "lat").collect():
        if s.prev_lon is not None:
            ends = tuple(f"{lon:.4f} {lat:.4f}" for lon, lat in ((s.prev_lon, s.prev_lat), (s.lon, s.lat)))
            steps.setdefault(s.mmsi, []).append(ends)
    assert drawn.pop(2) == []
    assert drawn == steps
    assert [p.wkt for p in parts if p.mmsi == 3 and p.n_points == 2] == [
        "LINESTRING (4.0000 51.0000, 4.1000 51.0000)"
    ]


@pytest.mark.parametrize("limit, join", [(200_000, "BroadcastHashJoin"), (10, "SortMergeJoin")])
def test_positions_by_port_equal_all_comparisons(spark, reports, monkeypatch, limit, join):
    monkeypatch.setattr(ports, "MAX_BROADCAST_CELLS", limit)
    rng = random.Random(5)
    rows = [
        (i, 0, rng.choice([None, round(rng.uniform(-2, 2), 2)]), round(rng.uniform(50, 52), 2), 1.0)
        for i in range(400)
    ]
    boxes = [("edge", -0.1, 50.5, 0.1, 50.6), ("point", 0.5, 51.0, 0.5, 51.0)]
    for i in range(30):
        west, south = round(rng.uniform(-2, 2), 2), round(rng.uniform(50, 52), 2)
        boxes.append((f"p{i}", west, south, west + rng.choice([0.005, 0.3, 1.0]), south + 0.25))
    df = spark.createDataFrame(
        boxes, "port_code string, west double, south double, east double, north double"
    )
    got = ports.positions_by_port(reports(rows), df).select("port_code", "mmsi")
    assert join in got._jdf.queryExecution().executedPlan().toString()
    expected = sorted(
        (code, m)
        for code, w, s, e, n in boxes
        for m, _, lon, lat, _ in rows
        if lon is not None and w <= lon <= e and s <= lat <= n
    )
    assert rows_of(got) == expected


def test_a_box_over_180_degrees_is_two_parts(spark, reports):
    boxes = spark.createDataFrame(
        [("fiji", 179.75, -18.0, -179.5, -17.0), ("none", 1.0, 5.0, 2.0, 4.0), ("gap", None, 1.0, 2.0, 3.0)],
        "port_code string, west double, south double, east double, north double",
    )
    places = [179.7, 179.75, 180.0, -180.0, -179.5, -179.4, 0.0, None]
    found = ports.positions_by_port(reports([(i, i, x, -17.5, 1.0) for i, x in enumerate(places)]), boxes)
    assert rows_of(found.select("port_code", "mmsi")) == [("fiji", i) for i in (1, 2, 3, 4)]


def test_box_parts_meet_nowhere(reports):
    box = Box(4.0, 51.0, 4.1, 51.1)
    rng = random.Random(2)
    rows = [(1, i, rng.choice([None, 3.9, 4.0, 4.05, 4.1, 4.2]), rng.choice([None, 50.9, 51.0, 51.1, 51.2]), 1.0) for i in range(100)]
    frame = reports(rows)
    assert frame.where(box.contains() & box.excludes()).count() == 0


def test_wide_boxes_cost_few_cells(spark, reports):
    boxes = [("wide", -20.0, 10.0, 20.0, 50.0), ("world", -180.0, -90.0, 180.0, 90.0), ("point", 4.0, 51.0, 4.0, 51.0)]
    boxes += [("long", -179.9, 1.0, 179.9, 1.01), ("pacific", 100.0, -60.0, -70.0, 60.0), ("small", 3.95, 50.95, 4.05, 51.05)]
    boxes = spark.createDataFrame(
        boxes, "port_code string, west double, south double, east double, north double"
    )
    counts = dict(rows_of(ports.port_cells(boxes).groupBy("port_code").count()))
    assert counts["wide"] < 100 and counts["world"] < 100 and counts["pacific"] < 200
    assert counts["small"] <= 9 and counts["point"] == 1
    places = [(4.0, 51.0), (-20.0, 50.0), (20.0, 10.0), (179.95, 0.0), (-100.0, 1.005), (-70.0, 60.0), (None, 1.0)]
    rows = [(n, 0, lon, lat, 1.0) for n, (lon, lat) in enumerate(places)]
    got = rows_of(ports.positions_by_port(reports(rows), boxes).select("port_code", "mmsi"))
    expected = [("long", 4), *(("pacific", n) for n in (3, 4, 5)), ("point", 0), ("small", 0)]
    expected += [*(("wide", n) for n in (1, 2)), *(("world", n) for n in range(6))]
    assert got == sorted(expected)
    none = ports.positions_by_port(reports(rows), boxes.limit(0))
    assert none.count() == 0
