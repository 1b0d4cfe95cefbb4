import glob
import gzip

import pyarrow.parquet as pq
from conftest import rows_of
from pyspark.sql import functions as F

from wakeline.functions.geo import Box
from wakeline.functions.values import parse_amount, parse_double, parse_int
from wakeline.operators import flags, registry
from wakeline.plans import jobs
from wakeline.plans.__main__ import run
from wakeline.schemas import POSITIONS
from wakeline.sources import ais, register, store
from wakeline.sources.mid import bounded, scan_mid_table
from wakeline.sources.sinks import write_result
from wakeline.sources.store import read_stored



def ingest(spark, tmp_path, frame, path):
    files = f"{tmp_path}/csv-of-{path.rpartition('/')[2]}"
    frame.write.mode("append").csv(files, header=True)
    return store.ingest(spark, ais.scan_positions, files, path)


HEADER = "mmsi,lon,lat,accuracy,speed,course,rotation,status,timestamp\n"


def test_positions_survive_bad_lines_and_other_headers(spark, tmp_path):
    with gzip.open(tmp_path / "20160101a.csv.gz", "wt") as f:
        f.write(HEADER + "1,4.5,51.5,1,2.5,0.0,0.0,0,2016-01-01 00:00:00\n" + HEADER)
    with gzip.open(tmp_path / "20160101b.csv.gz", "wt") as f:
        f.write("a,b,c,d,e,f,g,h,i\n2,abc,51.5,1,,0,0,0,2016-01-01 00:01:00\n")
    got = ais.scan_positions(spark, f"{tmp_path}/20160101*.csv.gz")
    rows = rows_of(got.select("mmsi", "lon", "speed", F.unix_seconds("timestamp")))
    assert rows == [(None, None, None, None), (1, 4.5, 2.5, 1451606400), (2, None, None, 1451606460)]


def test_messages_with_a_repeated_column_name(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "mmsi,imo,name,callsign,destination,draught,dim_a,dim_b,dim_c,dim_c,ship_type,timestamp\n"
        "1,2,N,C,D,35,1,2,3,4,30,2016-01-01 00:00:00\n"
    )
    row = ais.scan_messages(spark, f"{tmp_path}/m.csv").first()
    assert (row.draught, row.dim_c, row.dim_d, row.type_and_cargo) == (35.0, 3, 4, 30)


def test_register_types_and_encoding(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_bytes("mmsi;port_code;name;ton_gt;power_main\n1;YE;Señora é;1234,5;x\nbad;;B;2.5;3\n".encode("latin-1"))
    text = register.scan_register_text(spark, str(path))
    assert text.first().name == "Señora é"
    typed = rows_of(register.typed_register(text).select("mmsi", "port_code", "ton_gt", "power_main"))
    assert typed == [(None, None, 2.5, 3.0), (1, "YE", 1234.5, None)]


def test_register_by_port(spark):
    df = spark.createDataFrame(
        [("YE", 0.1, 1.0), ("YE", 0.2, None), (None, 1.005, 1.0)],
        "port_code string, ton_gt double, power_main double",
    )
    got = registry.register_by_port(df).collect()
    assert [(r.port_code, r.number_of_ships, str(r.gross_tonnage_gt), str(r.power_kw)) for r in got] == [
        (None, 1, "1.01", "1.00"),
        ("YE", 2, "0.30", "1.00"),
    ]


def test_safe_numbers(spark):
    df = spark.createDataFrame([("7",), ("1.5",), ("-3",), ("x",), ("",), (None,)], "t string")
    got = df.select(parse_int(F.col("t")), parse_double(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        (7, 7.0), (None, 1.5), (-3, -3.0), (None, None), (None, None), (None, None),
    ]


def test_days_outside_the_window_are_not_read(spark, reports, tmp_path):
    rows = [(1, day * 86400 + k, 4.0, 51.0, 1.0) for day in range(5) for k in (0, 10)]
    path = f"{tmp_path}/stored"
    ingest(spark, tmp_path, reports(rows), path)
    window = read_stored(spark, path, POSITIONS, "2024-01-02 12:00:00", "2024-01-03 12:00:05")
    assert window.count() == 3
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan


def test_result_files(spark, tmp_path):
    df = spark.range(100).withColumn("half", F.col("id") / 2)
    write_result(df, f"{tmp_path}/spread", files=5)
    assert len(glob.glob(f"{tmp_path}/spread/part-*.csv")) == 5
    write_result(df.orderBy(F.desc("id")), f"{tmp_path}/sorted", files=None, sep=";")
    lines = []
    for name in sorted(glob.glob(f"{tmp_path}/sorted/part-*.csv")):
        lines += open(name).read().splitlines()[1:]
    assert [int(line.split(";")[0]) for line in lines] == list(range(99, -1, -1))


def test_own_mid_table_is_in_order_and_whole(spark):
    rows = [tuple(r) for r in scan_mid_table(spark).collect()]
    assert len(rows) == len({mid for mid, _ in rows}) == 289
    assert rows == sorted(rows) and ("244", "Netherlands") in rows


def test_mid_table(spark, tmp_path):
    (tmp_path / "mid.csv").write_text("# digits\nmid,country\n219,Denmark\n220,Denmark\n261,Poland\n9,None\n")
    mids = scan_mid_table(spark, f"{tmp_path}/mid.csv")
    assert bounded(mids.union(mids)).count() == 3
    messages = spark.createDataFrame(
        [(219000001, 1, "A", "C", 30), (219000001, 1, "A", "C", 30), (261000001, 2, "B", "C", 70), (999, 3, "D", "C", 30)],
        "mmsi int, imo int, name string, callsign string, type_and_cargo int",
    )
    states = flags.vessel_flag_state(messages, mids).select("mmsi", "vessel_country_origin_mid")
    assert rows_of(states) == [
        (999, None), (219000001, "Denmark"), (219000001, "Denmark"), (261000001, "Poland"),
    ]
    assert flags.reference_frame(messages, mids, "Denmark").count() == 1
    assert flags.reference_frame(messages, mids, "Poland").count() == 0


def test_fleet_statistics_job(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        HEADER
        + "10,4.5,51.5,1,1.0,0,0,0,2016-01-01 00:00:00\n"
        + "10,4.5,51.5,1,1.0,0,0,0,2016-01-01 01:00:00\n"
        + "10,6.0,51.5,1,9.0,0,0,0,2016-01-01 02:00:00\n"
        + "10,6.1,51.5,1,9.0,0,0,0,2016-01-01 02:30:00\n"
        + "99,6.1,51.5,1,9.0,0,0,0,2016-01-01 02:30:00\n"
    )
    (tmp_path / "m.csv").write_text(
        "mmsi,imo,name,callsign,destination,draught,dim_a,dim_b,dim_c,dim_c,ship_type,timestamp\n"
        "10,2,N,C,D,35,1,2,3,4,30,2016-01-01 00:00:00\n"
    )
    (tmp_path / "r.csv").write_text("mmsi;port_code;ton_gt;power_main\n10;YE;1;2\n")
    out = f"{tmp_path}/out"
    args = [f"{tmp_path}/{n}.csv" for n in "pmr"]
    jobs.fleet_statistics(
        spark, *args, out, Box(4.0, 51.0, 5.0, 52.0), "YE",
        jobs.Window("2016-01-01 00:00:00", "2016-01-02 00:00:00"),
    )
    read = lambda name: spark.read.csv(f"{out}/{name}", header=True).collect()
    assert [tuple(r) for r in read("time_in_port")] == [("10", "3600", "1.0", "23.0")]
    assert [tuple(r) for r in read("time_fishing_activity")] == [("10", "1800", "0.5")]
    (report,) = read("movement_report")
    assert report.draught_avg_meters == "3.5"
    assert 6.8 < float(report.distance_km) < 7.0
    jobs.trip(spark, args[0], 10, Box(4.0, 51.0, 5.0, 52.0), f"{tmp_path}/trip")
    assert spark.read.csv(f"{tmp_path}/trip", header=True).count() == 2
    jobs.store_positions(spark, args[0], f"{tmp_path}/stored")
    jobs.maps(spark, f"{tmp_path}/stored", f"{tmp_path}/maps", 10, fmt="parquet")
    assert spark.read.csv(f"{tmp_path}/maps/traffic_cells", header=True).count() == 3


def test_observation_window_of_every_job(spark, tmp_path):
    day = "10,{},51.5,1,1.0,0,0,0,2016-01-{} {}\n"
    (tmp_path / "2016a").write_text(
        HEADER + day.format(4.5, "01", "00:00:00") + day.format(4.5, "01", "12:00:00")
        + day.format(6.0, "01", "13:00:00") + day.format(6.1, "01", "13:30:00")
        + day.format(4.5, "02", "00:00:00") + day.format(6.3, "02", "01:00:00")
    )
    (tmp_path / "m2016").write_text(
        "mmsi,imo,name,callsign,destination,draught,dim_a,dim_b,dim_c,dim_c,ship_type,timestamp\n"
        "10,2,N,C,D,10,1,2,3,4,30,2016-01-01 00:00:00\n10,2,N,C,D,90,1,2,3,4,30,2016-09-01 00:00:00\n"
    )
    (tmp_path / "r.csv").write_text("mmsi;port_code;ton_gt;power_main\n10;YE;1;2\n")
    (tmp_path / "ports.csv").write_text("port_code,west,south,east,north\nYE,4,51,5,52\n")
    positions, messages, register, ports_file = (
        f"{tmp_path}/{n}" for n in ("2016*", "m2016", "r.csv", "ports.csv")
    )
    box, window = Box(4.0, 51.0, 5.0, 52.0), jobs.Window("2016-01-01 00:00:00", "2016-01-02 00:00:00")
    assert (window.hours, jobs.Window("2016-01-01", "2016-01-08 12:00:00").hours) == (24, 180)
    jobs.store_positions(spark, positions, f"{tmp_path}/p")
    jobs.store_messages(spark, messages, f"{tmp_path}/m")
    read = lambda path: spark.read.csv(f"{tmp_path}/{path}", header=True)
    for fmt, p, m in (("csv", positions, messages), ("parquet", f"{tmp_path}/p", f"{tmp_path}/m")):
        out = f"{tmp_path}/{fmt}"
        jobs.fleet_statistics(spark, p, m, register, out, box, "YE", window, fmt)
        assert [tuple(r) for r in read(f"{fmt}/time_in_port").collect()] == [("10", "43200", "12.0", "12.0")]
        assert read(f"{fmt}/movement_report").first().draught_avg_meters == "1.0"
        jobs.trip(spark, p, 10, box, f"{out}/trip", window, fmt)
        assert read(f"{fmt}/trip").count() == 2
        jobs.maps(spark, p, f"{out}/maps", 10, window, fmt)
        assert sum(int(r.n_reports) for r in read(f"{fmt}/maps/traffic_intensity").collect()) == 4
        jobs.port_positions(spark, p, ports_file, f"{out}/ports", window, fmt)
        assert spark.read.parquet(f"{out}/ports").count() == 2
    week = jobs.Window("2016-01-01 00:00:00", "2016-01-08 00:00:00")
    jobs.fleet_statistics(spark, positions, messages, register, f"{tmp_path}/week", box, "YE", week)
    assert read("week/time_in_port").first().time_out_port_or_no_signal_h == "144.0"


def test_amounts_with_points_between_thousands(spark):
    df = spark.createDataFrame([("1.234,5",), ("12.345.678,25",), ("1234,5",), ("1.234",), ("a,b",)], "t string")
    got = [r[0] for r in df.select(parse_amount(F.col("t"))).collect()]
    assert got == [1234.5, 12345678.25, 1234.5, 1.234, None]


def test_jobs_from_the_command_line(spark, tmp_path):
    (tmp_path / "r.csv").write_text("mmsi;port_code;ton_gt;power_main\n10;YE;1;2\n11;YE;3;4\n")
    run(spark, "register_statistics", [f"{tmp_path}/r.csv", f"{tmp_path}/out"])
    (row,) = spark.read.csv(f"{tmp_path}/out", header=True).collect()
    assert tuple(row) == ("YE", "2", "4.00", "6.00")
    (tmp_path / "p.csv").write_text(HEADER + "10,4.5,51.5,1,1.0,0,0,0,2016-01-01 00:00:00\n")
    run(spark, "trip", [f"{tmp_path}/p.csv", "10", "5,51,6,52", f"{tmp_path}/trip"])
    assert spark.read.csv(f"{tmp_path}/trip", header=True).count() == 1


def test_complete_register_job(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes("Vessel;cfr\nZeehond é;1\nHaring;2\n".encode("latin-1"))
    html = '<tbody><a class="ship-link" href="/vessels/ZEEHOND é-IMO-9-MMSI-244000001">x</a></tbody>'
    spark.createDataFrame([(1, html)], "page_id long, html string").write.parquet(f"{tmp_path}/pages")
    jobs.complete_register(
        spark, f"{tmp_path}/r.csv", f"{tmp_path}/pages", "Vessel", f"{tmp_path}/out"
    )
    written = spark.read.csv(f"{tmp_path}/out", sep=";", header=True, encoding="ISO-8859-1")
    got = {r.cfr: r for r in written.collect()}
    assert (got["1"].mmsi, got["1"].name_scrape) == ("244000001", "ZEEHOND é")
    assert got["2"].mmsi_scrape == "---"
