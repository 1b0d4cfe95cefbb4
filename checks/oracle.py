"""The same results in plain SQL, written without regard to scale."""

from checks.fixtures import with_views
from checks.parameters import COUNTRY, END, HOME_PORT, MAP, PORT, START, VESSEL, mid_values

_POSITION_COLUMNS = (
    "mmsi, lon, lat, accuracy, speed, course, rotation, status, "
    "CAST(epoch(timestamp) AS BIGINT) AS ts"
)
_IN = (
    f"lon >= {PORT.west} AND lon <= {PORT.east} AND lat >= {PORT.south} AND lat <= {PORT.north}"
)
_OUT = f"(lon < {PORT.west} OR lon > {PORT.east} OR lat < {PORT.south} OR lat > {PORT.north})"
_MAP = f"lon >= {MAP.west} AND lon <= {MAP.east} AND lat >= {MAP.south} AND lat <= {MAP.north}"
_TRAFFIC = "lon >= 2 AND lon <= 8 AND lat >= 50 AND lat <= 55"

_FLEET = "fleet AS (SELECT DISTINCT mmsi FROM register WHERE mmsi > 1)"
_HOME = (
    "home AS (SELECT DISTINCT mmsi FROM register "
    f"WHERE port_code = '{HOME_PORT}' AND mmsi IS NOT NULL)"
)
_FLEET_POS = "fp AS (SELECT * FROM positions WHERE mmsi IN (SELECT mmsi FROM fleet))"
_SEA = f"sea AS (SELECT * FROM fp WHERE {_OUT} AND mmsi IN (SELECT mmsi FROM home))"
_ORDER = "timestamp NULLS FIRST, lon NULLS FIRST, lat NULLS FIRST, speed NULLS FIRST"


def _gaps(source: str, name: str = "gaps") -> str:
    return (
        f"{name} AS (SELECT *, CAST(epoch(lead(timestamp) OVER (PARTITION BY mmsi "
        f"ORDER BY {_ORDER})) - epoch(timestamp) AS BIGINT) AS gap FROM {source})"
    )


_KEPT = (
    "kept AS (SELECT * FROM (SELECT *, CAST(epoch(timestamp) AS INT) AS time, row_number() OVER ("
    "PARTITION BY timestamp, mmsi, lon, lat ORDER BY speed NULLS FIRST) AS rn FROM sea) WHERE rn = 1), "
    "track AS (SELECT mmsi, time, lon, lat, CASE WHEN speed > 20 THEN 0.0 ELSE speed END AS speed FROM kept)"
)
_STEPS = (
    "steps AS (SELECT mmsi, time, lon, lat, "
    "lag(lon) OVER (PARTITION BY mmsi ORDER BY time, lon, lat) AS prev_lon, "
    "lag(lat) OVER (PARTITION BY mmsi ORDER BY time, lon, lat) AS prev_lat "
    "FROM track WHERE lon IS NOT NULL AND lat IS NOT NULL)"
)
_VALID = (
    "abs(lat - prev_lat) < 0.5 AND abs(lon - prev_lon) < 0.5 "
    "AND ((lat > 0 AND prev_lat > 0) OR (lat < 0 AND prev_lat < 0)) "
    "AND ((lon > 0 AND prev_lon > 0) OR (lon < 0 AND prev_lon < 0))"
)
_A = (
    "(pow(sin(radians(lat - prev_lat) / 2), 2) + cos(radians(prev_lat)) * cos(radians(lat)) "
    "* pow(sin(radians(lon - prev_lon) / 2), 2))"
)
_KM = f"2 * 6371.009 * atan2(sqrt({_A}), sqrt(1 - {_A}))"
_STEP_KM = f"CASE WHEN {_VALID} THEN {_KM} ELSE 0.0 END"
_AT_SEA = ["positions", "register"]
_AT_SEA_CTE = f"{_FLEET}, {_HOME}, {_FLEET_POS}, {_SEA}"
_TRACK_CTE = f"{_AT_SEA_CTE}, {_KEPT}"
_STEPS_CTE = f"{_TRACK_CTE}, {_STEPS}"

_HOURS = "CAST(0.000277777778 AS DOUBLE)"
_PORT_TIME = (
    f"{_FLEET}, {_FLEET_POS}, inport AS (SELECT * FROM fp WHERE {_IN}), {_gaps('inport')}, "
    "total AS (SELECT mmsi, CAST(sum(gap) AS BIGINT) AS time_in_port_s FROM gaps "
    "WHERE speed < 4.0 GROUP BY mmsi) "
    f"SELECT mmsi, time_in_port_s, round(time_in_port_s * {_HOURS}, 2) AS time_in_port_h, "
    f"round(abs(round(time_in_port_s * {_HOURS}, 2) - 24), 2) AS time_out_port_or_no_signal_h "
    "FROM total"
)

_CELL_LON, _CELL_LAT = "floor(lon * 100 + 0.5) / 100", "floor(lat * 100 + 0.5) / 100"


def _cells(where: str, label: str = "") -> str:
    return (
        f"SELECT mmsi{label}, cell_lon AS lon, cell_lat AS lat, accuracy, speed, course, rotation, "
        "status, CAST(epoch(timestamp) AS BIGINT) AS ts FROM ("
        f"SELECT *, {_CELL_LON} AS cell_lon, {_CELL_LAT} AS cell_lat, row_number() OVER ("
        f"PARTITION BY {_CELL_LON}, {_CELL_LAT} ORDER BY timestamp, mmsi, lon, lat, "
        f"speed NULLS FIRST) AS rn FROM positions WHERE {where}) WHERE rn = 1"
    )


_LINKS = (
    "boxes AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', "
    "'', 'g'), '(?s)<tbody.*?</tbody>')) AS box FROM vessel_pages), "
    "tags AS (SELECT page_id, unnest(regexp_extract_all(box, "
    "'<a (?:[^>\"]|\"[^\"]*\")*>')) AS tag FROM boxes), "
    "raw_links AS (SELECT page_id, regexp_extract(tag, 'href=\"([^\"]*)\"', 1) AS href FROM tags "
    "WHERE contains(tag, 'class=\"ship-link\"')), "
    "links AS (SELECT page_id, replace(replace(replace(replace(replace(href, '&#38;', '&'), "
    "'&#x33;', '3'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href FROM raw_links)"
)
_VESSEL_LINKS = (
    f"{_LINKS}, vessel_links AS (SELECT page_id, "
    "regexp_extract(href, '/vessels/(.*)-IMO', 1) AS name, "
    "regexp_extract(href, '-IMO-(.*)-MMSI', 1) AS imo, "
    "regexp_extract(href, '-MMSI-(.*)', 1) AS mmsi FROM links "
    "WHERE regexp_matches(href, '/vessels/.*-IMO-.*-MMSI-'))"
)


def _lcs(pairs: str) -> str:
    """One cell of the table per step, for every row (a, b) of ``pairs``."""
    return (
        "lcs_steps AS (SELECT a, b, 1 AS i, 1 AS j, "
        "list_transform(range(len(b) + 1), lambda x: 0) AS prev, [0] AS cur "
        f"FROM {pairs} WHERE len(a) > 0 AND len(b) > 0 UNION ALL "
        "SELECT a, b, CASE WHEN j > len(b) THEN i + 1 ELSE i END, "
        "CASE WHEN j > len(b) THEN 1 ELSE j + 1 END, "
        "CASE WHEN j > len(b) THEN cur ELSE prev END, "
        "CASE WHEN j > len(b) THEN [0] ELSE list_append(cur, "
        "CASE WHEN substr(a, i, 1) = substr(b, j, 1) THEN prev[j] + 1 "
        "ELSE greatest(prev[j + 1], cur[j]) END) END "
        "FROM lcs_steps WHERE i <= len(a)), "
        "lcs AS (SELECT a, b, prev[len(b) + 1] AS n FROM lcs_steps WHERE i > len(a))"
    )


_MATCHES = (
    f"{_VESSEL_LINKS}, pairs AS (SELECT a, b FROM "
    "(SELECT DISTINCT lower(name) AS a FROM name_register WHERE name <> '') JOIN "
    "(SELECT DISTINCT lower(name) AS b FROM vessel_links) "
    "ON 10 * least(len(a), len(b)) >= 4 * (len(a) + len(b)) "
    f"AND levenshtein(a, b) <= (len(a) + len(b)) // 5), {_lcs('pairs')}, "
    "matches AS (SELECT a, b FROM lcs WHERE 10 * n >= 4 * (len(a) + len(b)))"
)
_FOUND = (
    f"{_MATCHES}, found AS (SELECT a, page_id, l.name, l.imo, l.mmsi "
    "FROM matches JOIN vessel_links l ON lower(l.name) = b), "
    "firsts AS (SELECT a, count(*) AS n_matches, "
    + ", ".join(f"arg_min({c}, page_id) AS first_{c}" for c in ("name", "imo", "mmsi"))
    + " FROM found GROUP BY a)"
)
_NAMED = "trim(coalesce(r.name, '')) <> ''"


def _sea(sql: str) -> str:
    return with_views(_AT_SEA, sql)


def statements() -> dict[str, str]:
    mids = f"mids AS (SELECT * FROM (VALUES {mid_values()}) AS t(mid, country))"
    flagged = (
        f"{mids}, flagged AS (SELECT mmsi, imo, name, callsign, country AS "
        "vessel_country_origin_mid, type_and_cargo FROM messages "
        "LEFT JOIN mids ON substr(CAST(mmsi AS VARCHAR), 1, 3) = mid)"
    )
    pos, reg, msg = ["positions"], ["register"], ["messages"]
    statements = {
        # sources and sinks
        "scan_positions_csv": with_views(pos, f"SELECT {_POSITION_COLUMNS} FROM positions"),
        "scan_messages_csv": with_views(
            msg,
            "SELECT * EXCLUDE (timestamp), CAST(epoch(timestamp) AS BIGINT) AS ts FROM messages",
        ),
        "scan_register_csv": with_views(reg, "SELECT * FROM register"),
        "scan_register_latin1": with_views(
            ["latin1_register"], "SELECT * FROM latin1_register"
        ),
        "observation_window": with_views(
            pos,
            f"SELECT {_POSITION_COLUMNS} FROM positions WHERE timestamp >= TIMESTAMP '{START}' "
            f"AND timestamp < TIMESTAMP '{END}'",
        ),
        "sink_csv_roundtrip": _sea(_PORT_TIME),
        # values
        "draught_cleaned": with_views(
            msg,
            "SELECT mmsi, CAST(epoch(timestamp) AS BIGINT) AS ts, "
            "CASE WHEN draught IS NULL THEN 0.0 ELSE draught END AS draught FROM messages",
        ),
        "register_typed": with_views(reg, "SELECT * FROM register"),
        "vessel_flag_state": with_views(msg, f"{flagged} SELECT * EXCLUDE (type_and_cargo) FROM flagged"),
        "safe_numeric": with_views(
            ["raw_numbers"],
            "SELECT p_partkey, TRY_CAST(raw AS DOUBLE) AS as_double, CASE WHEN "
            "regexp_full_match(raw, '[+-]?[0-9]+') THEN TRY_CAST(raw AS INT) END AS as_int "
            "FROM raw_numbers",
        ),
        "speed_clipped": with_views(
            pos,
            "SELECT mmsi, CAST(epoch(timestamp) AS BIGINT) AS ts, "
            "CASE WHEN speed > 20 THEN 0.0 ELSE speed END AS speed FROM positions",
        ),
        "epoch_seconds": with_views(
            pos, "SELECT mmsi, CAST(epoch(timestamp) AS INT) AS time FROM positions"
        ),
        "grid_cells": with_views(
            pos,
            f"SELECT mmsi, lon, lat, {_CELL_LON} AS cell_lon, {_CELL_LAT} AS cell_lat "
            "FROM positions",
        ),
        # filters and fleets
        "fishing_type_messages": with_views(
            msg,
            "SELECT mmsi, name, CAST(epoch(timestamp) AS BIGINT) AS ts FROM messages "
            "WHERE type_and_cargo = 30",
        ),
        "reference_frame": with_views(
            msg,
            f"{flagged} SELECT DISTINCT * EXCLUDE (type_and_cargo) FROM flagged "
            f"WHERE type_and_cargo = 30 AND vessel_country_origin_mid = '{COUNTRY}'",
        ),
        "fleet_ids": with_views(reg, f"{_FLEET} SELECT * FROM fleet"),
        "home_port_ids": with_views(reg, f"{_HOME} SELECT * FROM home"),
        "fleet_positions": _sea(f"{_FLEET}, {_FLEET_POS} SELECT {_POSITION_COLUMNS} FROM fp"),
        "fleet_messages": with_views(
            ["messages", "register"],
            f"{_FLEET} SELECT mmsi, imo, name, callsign, draught, "
            "CAST(epoch(timestamp) AS BIGINT) AS ts FROM messages "
            "WHERE mmsi IN (SELECT mmsi FROM fleet)",
        ),
        "home_port_positions": _sea(
            f"{_HOME} SELECT {_POSITION_COLUMNS} FROM positions "
            "WHERE mmsi IN (SELECT mmsi FROM home)"
        ),
        "active_vessels": _sea(
            f"{_HOME} SELECT DISTINCT mmsi FROM positions WHERE mmsi IN (SELECT mmsi FROM home)"
        ),
        "positions_in_port": _sea(
            f"{_FLEET}, {_FLEET_POS} SELECT {_POSITION_COLUMNS} FROM fp WHERE {_IN}"
        ),
        "positions_out_of_port": _sea(
            f"{_FLEET}, {_FLEET_POS} SELECT {_POSITION_COLUMNS} FROM fp WHERE {_OUT}"
        ),
        "positions_by_port": with_views(
            ["positions", "ports"],
            f"SELECT port_code, {_POSITION_COLUMNS} FROM positions JOIN ports "
            "ON lon BETWEEN west AND east AND lat BETWEEN south AND north",
        ),
        # time in port and at sea
        "report_gaps": _sea(
            f"{_FLEET}, {_FLEET_POS}, {_gaps('fp')} "
            f"SELECT {_POSITION_COLUMNS}, gap AS time_diff_next FROM gaps"
        ),
        "time_in_port": _sea(_PORT_TIME),
        "time_fishing_activity": _sea(
            f"{_AT_SEA_CTE}, {_gaps('sea')}, total AS (SELECT mmsi, CAST(sum(gap) AS BIGINT) "
            "AS time_fishing_activity_s FROM gaps WHERE speed > 0.5 AND speed < 20 GROUP BY mmsi) "
            f"SELECT *, round(time_fishing_activity_s * {_HOURS}, 2) AS time_fishing_activity_h "
            "FROM total"
        ),
        "vessel_trip": with_views(
            pos,
            f"trip AS (SELECT * FROM positions WHERE mmsi = {VESSEL} AND {_OUT}), {_gaps('trip')} "
            f"SELECT {_POSITION_COLUMNS}, gap AS time_diff_next, "
            "CAST(epoch(timestamp) AS INT) AS time FROM gaps",
        ),
        # movement
        "draught_stats": with_views(
            ["messages", "register"],
            f"{_FLEET} SELECT mmsi, round(avg(coalesce(draught, 0.0)) / 10, 6) AS draught_avg_meters, "
            "max(coalesce(draught, 0.0)) / 10 AS draught_max_meters, "
            "min(coalesce(draught, 0.0)) / 10 AS draught_min_meters "
            "FROM messages WHERE mmsi IN (SELECT mmsi FROM fleet) GROUP BY mmsi",
        ),
        "draught_in_window": with_views(
            ["messages", "register"],
            f"{_FLEET} SELECT mmsi, round(avg(coalesce(draught, 0.0)) / 10, 6) AS draught_avg_meters, "
            "max(coalesce(draught, 0.0)) / 10 AS draught_max_meters, "
            "min(coalesce(draught, 0.0)) / 10 AS draught_min_meters "
            "FROM messages WHERE mmsi IN (SELECT mmsi FROM fleet) "
            f"AND timestamp >= TIMESTAMP '{START}' AND timestamp < TIMESTAMP '{END}' GROUP BY mmsi",
        ),
        "dedup_reports": _sea(
            f"{_TRACK_CTE} SELECT {_POSITION_COLUMNS}, time FROM kept"
        ),
        "speed_stats": _sea(
            f"{_TRACK_CTE} SELECT mmsi, max(speed) AS speed_max, min(speed) AS speed_min, "
            "round(avg(speed) + 1e-9, 6) AS speed_avg FROM track GROUP BY mmsi"
        ),
        "movement_extent": _sea(
            f"{_TRACK_CTE} SELECT mmsi, max(lat) AS lat_max, min(lat) AS lat_min, "
            "max(lon) AS lon_max, min(lon) AS lon_min FROM track GROUP BY mmsi"
        ),
        "track_endpoints": _sea(
            f"{_STEPS_CTE}, ends AS (SELECT *, "
            "row_number() OVER (PARTITION BY mmsi ORDER BY time, lon, lat) AS up, "
            "row_number() OVER (PARTITION BY mmsi ORDER BY time DESC, lon DESC, lat DESC) AS down "
            "FROM steps) SELECT f.mmsi, f.lat AS first_lat, f.lon AS first_lon, "
            "l.lat AS last_lat, l.lon AS last_lon FROM ends f JOIN ends l "
            "ON f.mmsi = l.mmsi AND f.up = 1 AND l.down = 1"
        ),
        "track_steps": _sea(f"{_STEPS_CTE} SELECT * FROM steps"),
        "haversine_steps": _sea(
            f"{_STEPS_CTE} SELECT mmsi, time, lon, lat, round({_STEP_KM}, 6) AS step_km FROM steps"
        ),
        "valid_steps": _sea(
            f"{_STEPS_CTE} SELECT mmsi, time, lon, lat, prev_lon, prev_lat, round({_KM}, 6) "
            f"AS step_km FROM steps WHERE {_VALID}"
        ),
        "distance_travelled": _sea(
            f"{_STEPS_CTE}, km AS (SELECT mmsi, sum({_STEP_KM}) AS km FROM steps GROUP BY mmsi) "
            "SELECT t.mmsi, round(coalesce(km, 0.0), 6) AS distance_km "
            "FROM (SELECT DISTINCT mmsi FROM track) t LEFT JOIN km ON t.mmsi = km.mmsi"
        ),
        "movement_report": with_views(
            ["positions", "register", "messages"],
            f"{_STEPS_CTE}, km AS (SELECT mmsi, sum({_STEP_KM}) AS km, "
            "arg_min(lat, (time, lon, lat)) AS first_lat, arg_min(lon, (time, lon, lat)) AS first_lon, "
            "arg_max(lat, (time, lon, lat)) AS last_lat, arg_max(lon, (time, lon, lat)) AS last_lon "
            "FROM steps GROUP BY mmsi), "
            "figures AS (SELECT mmsi, max(speed) AS speed_max, min(speed) AS speed_min, "
            "round(avg(speed) + 1e-9, 6) AS speed_avg, max(lat) AS lat_max, min(lat) AS lat_min, "
            "max(lon) AS lon_max, min(lon) AS lon_min, count(*) AS n_records "
            "FROM track GROUP BY mmsi), "
            "draughts AS (SELECT mmsi, round(avg(coalesce(draught, 0.0)) / 10, 6) "
            "AS draught_avg_meters FROM messages WHERE mmsi IN (SELECT mmsi FROM fleet) GROUP BY mmsi) "
            "SELECT figures.*, draught_avg_meters, first_lat, first_lon, last_lat, last_lon, "
            "round(CASE WHEN coalesce(speed_max, 0) > 1 THEN coalesce(km, 0.0) ELSE 0.0 END, 6) "
            "AS distance_km FROM figures LEFT JOIN draughts USING (mmsi) LEFT JOIN km USING (mmsi)",
        ),
        "fleet_figures": _sea(
            f"port_time AS (WITH {_PORT_TIME}), "
            f"sea_time AS (WITH {_AT_SEA_CTE}, {_gaps('sea')} SELECT mmsi, "
            "CAST(sum(gap) AS BIGINT) AS time_fishing_activity_s FROM gaps "
            "WHERE speed > 0.5 AND speed < 20 GROUP BY mmsi), "
            f"moved AS (WITH {_STEPS_CTE}, km AS (SELECT mmsi, sum({_STEP_KM}) AS km FROM steps "
            "GROUP BY mmsi) SELECT mmsi, count(*) AS n_records, max(speed) AS speed_max, "
            "round(CASE WHEN coalesce(max(speed), 0) > 1 THEN coalesce(max(km), 0.0) ELSE 0.0 END, 6) "
            "AS distance_km FROM track LEFT JOIN km USING (mmsi) GROUP BY mmsi) "
            "SELECT mmsi, time_in_port_s, time_fishing_activity_s, n_records, speed_max, distance_km "
            "FROM port_time FULL JOIN sea_time USING (mmsi) FULL JOIN moved USING (mmsi)"
        ),
        # register statistics
        "register_by_port": with_views(
            reg,
            "SELECT port_code, count(*) AS number_of_ships, "
            "CAST(CAST(sum(CAST(ton_gt AS DECIMAL(24,4))) AS DECIMAL(32,2)) AS DOUBLE) "
            "AS gross_tonnage_gt, "
            "CAST(CAST(sum(CAST(power_main AS DECIMAL(24,4))) AS DECIMAL(32,2)) AS DOUBLE) "
            "AS power_kw FROM register GROUP BY port_code",
        ),
        # cells and trajectories
        "traffic_cells": with_views(pos, _cells(_TRAFFIC)),
        "traffic_intensity": with_views(
            pos,
            f"SELECT {_CELL_LON} AS cell_lon, {_CELL_LAT} AS cell_lat, count(*) AS n_reports, "
            f"count(DISTINCT mmsi) AS n_vessels FROM positions WHERE {_TRAFFIC} "
            f"GROUP BY {_CELL_LON}, {_CELL_LAT}",
        ),
        "route_cells": with_views(
            pos, _cells(f"mmsi = {VESSEL} AND {_MAP}", ", CAST(mmsi AS VARCHAR) AS label")
        ),
        "vessel_trajectory": _sea(
            # Every step of the uncut track is drawn in the part its start lies in.
            f"{_STEPS_CTE}, places AS (SELECT mmsi, time - time % 86400 AS day, time, lon, lat, "
            "lead(time) OVER w AS t2, lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2 "
            "FROM steps WINDOW w AS (PARTITION BY mmsi ORDER BY time, lon, lat)), "
            "drawn AS (SELECT mmsi, day, time, lon, lat FROM places UNION ALL "
            "SELECT mmsi, day, t2, lon2, lat2 FROM places WHERE t2 - t2 % 86400 > day) "
            "SELECT mmsi, CAST(day AS BIGINT) AS part_start, "
            "0 AS part, count(*) AS n_points, min(time) AS start_time, max(time) AS end_time, "
            "CASE WHEN count(*) = 1 THEN 'POINT (' ELSE 'LINESTRING (' END || "
            "string_agg(printf('%.4f %.4f', lon, lat), ', ' ORDER BY time, lon, lat) || ')' AS wkt "
            "FROM drawn GROUP BY mmsi, day"
        ),
        # register completion
        "page_links": with_views(["vessel_pages"], f"{_LINKS} SELECT page_id, href FROM links"),
        "page_links_of_pages": (
            "WITH tags AS (SELECT page_id, unnest(regexp_extract_all("
            "regexp_extract(html, '(?is)<body[ >].*'), '(?i)<a\\s[^>]*>')) AS tag FROM pages) "
            "SELECT page_id, regexp_extract(tag, 'href=\"([^\"]*)\"', 1) AS href FROM tags "
            "WHERE contains(tag, 'href=\"')"
        ),
        "vessel_links": with_views(["vessel_pages"], f"{_VESSEL_LINKS} SELECT * FROM vessel_links"),
        "name_similarity": with_views(
            ["name_register", "vessel_pages"],
            f"{_VESSEL_LINKS}, both_names AS (SELECT reg_id, r.name, l.name AS link_name, "
            "lower(r.name) AS a, lower(l.name) AS b FROM name_register r JOIN vessel_links l "
            "ON r.reg_id = CAST(page_id AS VARCHAR) WHERE r.name <> ''), "
            f"pairs AS (SELECT DISTINCT a, b FROM both_names), {_lcs('pairs')} "
            "SELECT reg_id, name, link_name, round(2 * n / (len(a) + len(b)), 6) AS ratio, "
            "10 * n >= 4 * (len(a) + len(b)) AS is_match FROM both_names JOIN lcs USING (a, b)",
        ),
        "name_matches": with_views(
            ["name_register", "vessel_pages"], f"{_MATCHES} SELECT a, b FROM matches"
        ),
        "fuzzy_register_match": with_views(
            ["name_register", "vessel_pages"],
            f"{_FOUND} SELECT DISTINCT lower(r.name) AS register_name, page_id, "
            "coalesce(f.name, '---') AS name, coalesce(f.imo, '---') AS imo, "
            "coalesce(f.mmsi, '---') AS mmsi FROM name_register r "
            f"LEFT JOIN found f ON lower(r.name) = a WHERE {_NAMED}",
        ),
        "register_update": with_views(
            ["name_register", "vessel_pages"],
            f"{_FOUND} SELECT reg_id, coalesce(mmsi, CASE WHEN n_matches = 1 "
            "THEN TRY_CAST(first_mmsi AS INT) END) AS mmsi, r.name, "
            + ", ".join(
                f"CASE WHEN {_NAMED} THEN coalesce(first_{c}, '---') ELSE {c}_scrape END AS {c}_scrape"
                for c in ("name", "imo", "mmsi")
            )
            + ", coalesce(n_matches, 0) AS n_matches, mmsi IS NULL AND coalesce(n_matches, 0) > 1 "
            "AS ambiguous FROM name_register r LEFT JOIN firsts ON lower(r.name) = a",
        ),
        "match_lists": with_views(
            ["name_register", "vessel_pages"],
            f"{_FOUND}, numbered AS (SELECT *, CAST((row_number() OVER "
            "(PARTITION BY a ORDER BY page_id) - 1) // 1000 AS INT) AS list_part FROM found) "
            "SELECT a AS register_name, list_part, count(*) AS n, "
            + ", ".join(
                f"string_agg({c}, ',' ORDER BY page_id) AS {c}" for c in ("name", "imo", "mmsi")
            )
            + " FROM numbered GROUP BY ALL",
        ),
    }
    # The same figures, whichever way they are put together.
    statements["fleet_figures_by_day"] = statements["fleet_figures"]
    return statements
