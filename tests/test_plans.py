import re

import pytest
from pyspark.sql import functions as F

from checks import catalog
from wakeline.functions.geo import Box
from wakeline.functions.tracks import with_slice
from wakeline.operators import cells, dwell, fleet, movement

SF = "/root/testdata/sf0.001"
WRITING = {
    "scan_positions_csv",
    "scan_messages_csv",
    "scan_register_csv",
    "scan_register_latin1",
    "observation_window",
    "sink_csv_roundtrip",
    "fuzzy_register_match",
    "register_update",
    "match_lists",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.registered()) - WRITING))
def test_queries_stay_inside_the_engine(spark, name):
    plan = plan_of(catalog.registered()[name](spark, SF))
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        # The table of three-digit codes is a parameter, handed over as rows.
        if node == "ExistingRDD" and name in ("vessel_flag_state", "reference_frame"):
            continue
        assert node not in plan, plan


@pytest.fixture
def stored(spark, reports, tmp_path):
    path = f"{tmp_path}/positions"
    reports([(1, 0, 4.0, 51.0, 1.0)]).write.parquet(path)
    return spark.read.parquet(path)


def test_time_in_port_reads_and_shuffles_little(spark, stored, tmp_path):
    spark.createDataFrame([(1,)], "mmsi int").write.parquet(f"{tmp_path}/register")
    ids = fleet.fleet_ids(spark.read.parquet(f"{tmp_path}/register"))
    plan = plan_of(dwell.time_in_port(fleet.of_vessels(stored, ids), Box(4, 51, 5, 52)))
    (scan,) = re.findall(r"FileScan parquet .*lon.*", plan)
    assert "BroadcastHashJoin [mmsi" in plan
    assert "ReadSchema: struct<mmsi:int,lon:double,lat:double,speed:double,timestamp:timestamp>" in scan
    assert "GreaterThanOrEqual(lon,4.0)" in scan and "LessThanOrEqual(lat,52.0)" in scan
    # Reports move once to fold their copies and once to their slices; by vessel alone
    # move only the slices, one row each, for the window and the sum over it.
    exchanges = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    keys = [re.sub(r"#\d+L?", "", e) for e in exchanges]
    assert keys.count("mmsi, slice") == 1
    by_vessel = [k for k in keys if k == "mmsi"]
    assert len(by_vessel) <= 2  # one of them distributes the fleet's identities
    assert any(k.startswith("mmsi, timestamp, lon, lat, speed") for k in keys)


def test_movement_is_one_pass_over_the_positions(spark, stored):
    track = movement.track_reports(stored)
    plan = plan_of(movement.distance_travelled(track))
    assert len(re.findall("FileScan parquet", plan)) == 1
    assert "HashAggregate(keys=[mmsi" in plan


def test_name_join_is_merged_on_segments(spark):
    from wakeline.operators.enrich import name_matches

    names = spark.createDataFrame([("one",)], "name string")
    plan = plan_of(name_matches(names, names))
    assert "SortMergeJoin [key" in plan
    assert "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("operator", ["time_in_port", "report_gaps", "movement", "steps", "lines"])
def test_slices_spread_after_a_join_by_vessel(spark, stored, operator):
    """Without a broadcast the fleet's reports come out of a join sorted by mmsi."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine = fleet.of_vessels(stored, spark.createDataFrame([(1,)], "mmsi int"))
        track = movement.track_reports(mine)
        result = {
            "time_in_port": lambda: dwell.time_in_port(mine, Box(4, 51, 5, 52)),
            "report_gaps": lambda: dwell.report_gaps(mine),
            "movement": lambda: movement.distance_travelled(track),
            "steps": lambda: movement.track_steps(track),
            "lines": lambda: cells.vessel_trajectory(track),
        }[operator]()
        plan = re.sub(r"#\d+L?", "", plan_of(result))
        by_slice = r"hashpartitioning\(mmsi, (part_start, )?slice, \d+\), REPARTITION_BY_COL"
        # The only shuffle between the window and the rows is the one by slice.
        for window in re.findall(r"Window \[(?:lead|lag|row_number)[^\n]*\[mmsi, (?:part_start, )?slice\][^\n]*\n.*?Exchange ([^\n]*)", plan, re.S):
            assert re.match(by_slice, window), plan
        assert re.search(by_slice, plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


ONE_READ = ["report_gaps", "track_steps", "valid_steps", "haversine_steps", "vessel_trajectory"]


@pytest.mark.parametrize("name", ONE_READ)
def test_window_operators_read_the_reports_once(spark, name):
    """The final plan has one scan of the events; what else needs them reuses a shuffle."""
    result = catalog.registered()[name](spark, SF)
    result.collect()
    plan = plan_of(result).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet [^\n]*events", plan)) == 1, plan
    assert "Reused" in plan


def test_exact_name_test_runs_in_several_tasks(spark):
    """No grouping stands above the join, whose partitions follow the segments' bytes."""
    from wakeline.operators.enrich import name_matches

    names = spark.createDataFrame([(f"vessel {n * 7919 % 100000:05d}",) for n in range(3000)], "name string")
    result = name_matches(names, names)
    result.collect()
    plan = plan_of(result).split("== Initial Plan ==")[0]
    assert not re.search(r"Aggregate[^\n]*keys=\[a#\d+, b#", plan)
    assert result.rdd.getNumPartitions() > 1


def test_hot_vessel_is_spread_over_slices(reports):
    rows = [(1, 30 * k, 4.0, 51.0, 1.0) for k in range(5000)]
    track = movement.track_reports(reports(rows))
    sliced = with_slice(track, F.col("time"), ["lon", "lat"], 600)
    largest = sliced.groupBy("mmsi", "slice").count().agg(F.max("count")).first()[0]
    assert largest == 20
