"""One pass over the reports gives what the three operators give apart."""

import random
import re

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks.parameters import HOME_PORT, PORT
from wakeline.functions.geo import Box
from wakeline.operators import dwell, figures, fleet, movement

SF = "/root/testdata/sf0.001"


def same(got, expected):
    assert got.columns == expected.columns
    key = lambda r: (r["mmsi"] is not None, r["mmsi"])
    got, expected = (sorted((r.asDict() for r in df.collect()), key=key) for df in (got, expected))
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected, strict=True):
        for column, value in b.items():
            if isinstance(value, float):
                assert a[column] == pytest.approx(value, abs=1e-9), (column, a, b)
            else:
                assert a[column] == value, (column, a, b)


def compare(spark, positions, messages, register, port, home, slice_seconds=600):
    mine = fleet.of_vessels(positions, fleet.fleet_ids(register))
    at_sea = dwell.reports_at_sea(mine, fleet.home_port_ids(register, home), port)
    found = figures.fleet_figures(
        positions, figures.fleet_with_home(register, home), port, slice_seconds
    )
    same(figures.time_in_port_of(found, 30), dwell.time_in_port(mine, port, 30))
    same(figures.fishing_activity_of(found), dwell.time_fishing_activity(at_sea))
    same(figures.movement_report_of(found, messages), movement.movement_report(at_sea, messages))
    return found


def test_figures_of_the_given_tables(spark):
    i = catalog.Inputs(spark, SF)
    found = compare(spark, i.positions, i.fleet_messages, i.register, PORT, HOME_PORT)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet [^\n]*event_type", plan)) == 1
    assert len(re.findall("Join", plan.replace("BroadcastNestedLoopJoin", ""))) <= 2


@pytest.mark.parametrize("slice_seconds", [7, 600])
def test_figures_of_reports_with_gaps_copies_and_ties(spark, reports, slice_seconds):
    rng = random.Random(slice_seconds)
    rows = [
        (
            rng.randint(0, 5),
            rng.choice([None, *range(0, 3000, 13)]),
            rng.choice([None, 4.0, 4.2, 4.4, 4.6, 5.2, 0.0, -0.1]),
            rng.choice([None, 51.0, 51.3, 51.5, 52.0]),
            rng.choice([None, 0.2, 1.0, 3.9, 4.0, 12.0, 25.0]),
        )
        for _ in range(900)
    ]
    register = spark.createDataFrame(
        [(2, "YE"), (2, "SCH"), (3, "YE"), (4, None), (5, "SCH"), (1, "YE"), (None, "YE"), (0, "YE")],
        "mmsi int, port_code string",
    )
    messages = spark.createDataFrame(
        [(2, 30.0), (2, None), (3, 10.0), (9, 1.0)], "mmsi int, draught double"
    )
    frame = reports(rows + rows[::5])
    compare(spark, frame, messages, register, Box(4.1, 51.2, 4.6, 51.6), "YE", slice_seconds)


def test_positions_are_read_and_joined_once(spark, reports, tmp_path):
    reports([(2, 0, 4.0, 51.0, 1.0)]).write.parquet(f"{tmp_path}/p")
    register = spark.createDataFrame([(2, "YE")], "mmsi int, port_code string")
    found = figures.fleet_figures(
        spark.read.parquet(f"{tmp_path}/p"), figures.fleet_with_home(register, "YE"), Box(4, 51, 5, 52)
    )
    plan = re.sub(r"#\d+L?", "", found._jdf.queryExecution().executedPlan().toString())
    assert plan.count("FileScan parquet") == 1
    assert len(re.findall(r"\w+Join ", plan)) == 1
    assert plan.count("hashpartitioning(mmsi, at_sea, slice,") == 1
    assert "ReadSchema: struct<mmsi:int,lon:double,lat:double,speed:double,timestamp:timestamp>" in plan
    assert found.where(F.col("at_sea").isNull()).count() == 0
