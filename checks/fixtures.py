"""Ship data derived by SQL from the given tables.

The statements run unchanged on Spark and DuckDB and read the given tables whole.
"""

from pyspark.sql import DataFrame, SparkSession

# The given table each view is derived from.
BASE_TABLES = {
    "positions": "events",
    "messages": "events",
    "register": "customer",
    "name_register": "part",
    "vessel_pages": "part",
    "raw_numbers": "part",
    "all_pages": "pages",
    "latin1_register": "documents",
}

_MMSI = (
    "CAST(CASE {id} % 5 WHEN 0 THEN 244000000 WHEN 1 THEN 245000000 "
    "WHEN 2 THEN 261000000 WHEN 3 THEN 211000000 ELSE 299000000 END + {id} AS INT)"
)

# Missing coordinates and speeds, jumps of two degrees, speeds above 20, moored
# vessels, exact copies (signup) and copies that differ in speed (error).
_POSITIONS = f"""
WITH base AS (
  SELECT event_type, {_MMSI.format(id="user_id")} AS mmsi,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE
      CAST(40000 + (user_id*37) % 3000 + (event_id*7919) % 4000
        + CASE WHEN event_id % 50 = 0 THEN 20000 ELSE 0 END AS DOUBLE)
      / CAST(10000 AS DOUBLE) END AS lon,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE
      CAST(510000 + (user_id*53) % 3000 + (event_id*6101) % 4000 AS DOUBLE)
      / CAST(10000 AS DOUBLE) END AS lat,
    CAST(event_id % 2 AS INT) AS accuracy,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN user_id % 11 = 0
      THEN value/CAST(1000 AS DOUBLE) ELSE value/CAST(8 AS DOUBLE) END AS speed,
    CAST((event_id*31) % 3600 AS DOUBLE)/CAST(10 AS DOUBLE) AS course,
    CAST((event_id*17) % 255 - 127 AS DOUBLE) AS rotation,
    CAST(event_id % 16 AS INT) AS status,
    date_trunc('SECOND', ts) AS timestamp
  FROM events)
SELECT mmsi, lon, lat, accuracy, speed + coalesce(extra, CAST(0 AS DOUBLE)) AS speed,
  course, rotation, status, timestamp
FROM base LEFT JOIN (VALUES ('error', CAST(0 AS DOUBLE)), ('error', CAST(0.25 AS DOUBLE)),
  ('signup', CAST(0 AS DOUBLE)), ('signup', CAST(0 AS DOUBLE))) AS copies(kind, extra)
  ON event_type = kind
"""

# Missing draughts, fishing and other ship types, digits with and without a country.
_MESSAGES = f"""
SELECT {_MMSI.format(id="user_id")} AS mmsi,
  CAST(9000000 + user_id AS INT) AS imo,
  concat('VESSEL ', CAST(user_id AS VARCHAR(20))) AS name,
  concat('CS', CAST(user_id AS VARCHAR(20))) AS callsign, event_type AS destination,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 120 AS DOUBLE) END AS draught,
  CAST(user_id % 50 AS INT) AS dim_a, CAST(user_id % 40 AS INT) AS dim_b,
  CAST(user_id % 8 AS INT) AS dim_c, CAST(user_id % 7 AS INT) AS dim_d,
  CAST(CASE WHEN user_id % 3 = 0 THEN 70 ELSE 30 END AS INT) AS type_and_cargo,
  date_trunc('SECOND', ts) AS timestamp
FROM events
"""

# A missing mmsi in one segment, an invalid one with negative balance, ships without port.
_REGISTER = f"""
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN 1
    ELSE {_MMSI.format(id="c_custkey")} END AS mmsi,
  CASE c_nationkey % 5 WHEN 0 THEN 'YE' WHEN 1 THEN 'SCH' WHEN 2 THEN 'UK'
    WHEN 3 THEN 'TX' ELSE NULL END AS port_code,
  c_name AS name, abs(c_acctbal)/CAST(10 AS DOUBLE) AS ton_gt,
  abs(c_acctbal)/CAST(4 AS DOUBLE) AS power_main
FROM customer
"""

# Most ships have a name of their own; those of one brand share a few names, and those
# of another share the words in front, as fleets do.
_SHIP_LETTERS = (
    "translate(md5(CAST(p_partkey AS VARCHAR(20))), '0123456789abcdef', 'aeiourstnlmpdcgb')"
)
_SHIP = f"""CASE WHEN p_brand = 'Brand#1' THEN p_name WHEN p_brand = 'Brand#2'
  THEN concat('santa maria ', substr({_SHIP_LETTERS}, 1, 9)) ELSE
  concat(substr({_SHIP_LETTERS}, 1, 5), ' ', substr({_SHIP_LETTERS}, 6, 6)) END"""

_NAME_REGISTER = f"""
SELECT CAST(p_partkey AS VARCHAR(20)) AS reg_id,
  CASE WHEN p_size % 2 = 0 THEN NULL ELSE CAST(244000000 + p_partkey AS INT) END AS mmsi,
  CASE WHEN p_size = 9 THEN '' WHEN p_size = 19 THEN NULL ELSE {_SHIP} END AS name,
  'prev' AS name_scrape, 'prev imo' AS imo_scrape, 'prev mmsi' AS mmsi_scrape
FROM part
"""

# A good link, one outside the container, one without the class, a broken one, one in a
# comment, and one with a bracket in a value and character references in its target.
_VESSEL_PAGES = f"""
SELECT p_partkey AS page_id, concat(
  '<html><body><a class="ship-link" href="/vessels/OUTSIDE-IMO-1-MMSI-2">x</a>',
  '<table><tbody><tr><td><a class="ship-link" href="/vessels/',
  CASE p_size % 4 WHEN 0 THEN upper(replace({_SHIP}, ' ', '-'))
    WHEN 1 THEN substr({_SHIP}, 1, length({_SHIP}) - 1)
    WHEN 2 THEN concat({_SHIP}, ' II') ELSE {_SHIP} END,
  '-IMO-', CAST(9000000 + p_partkey AS VARCHAR(20)),
  '-MMSI-', CAST(244000000 + p_partkey AS VARCHAR(20)),
  '">y</a><a href="/vessels/PLAIN-IMO-3-MMSI-4">z</a>',
  '<a class="ship-link" href="/broken">w</a>',
  '<!-- <a class="ship-link" href="/vessels/HIDDEN-IMO-5-MMSI-6">c</a> -->',
  '<a title="a > b" class="ship-link" href="/ports/R&amp;D?a=1&#38;b=&lt;&#x33;&gt;">p</a>',
  '</td></tr></tbody></table></body></html>') AS html
FROM part
"""

# The whole text of a document; characters that Latin-1 lacks and line breaks are
# replaced. A file has no empty text apart from a missing one, nor spaces around one.
_LATIN1 = """
SELECT CAST(doc_id AS VARCHAR(20)) AS reg_id, lang AS port_code,
  nullif(trim(regexp_replace(text, {pattern}, '_'{every})), '') AS name
FROM documents
"""
_OUTSIDE_LATIN1 = "'[^ -~\u00a1-\u00ff]'"

# Overlapping on purpose: a position may lie in two ports.
_PORTS = """
SELECT * FROM (VALUES
 ('YE', CAST(4.2 AS DOUBLE), CAST(51.2 AS DOUBLE), CAST(4.6 AS DOUBLE), CAST(51.6 AS DOUBLE)),
 ('SCH', CAST(4.0 AS DOUBLE), CAST(51.0 AS DOUBLE), CAST(4.2 AS DOUBLE), CAST(51.2 AS DOUBLE)),
 ('UK', CAST(4.5 AS DOUBLE), CAST(51.5 AS DOUBLE), CAST(4.8 AS DOUBLE), CAST(51.8 AS DOUBLE))
) AS t(port_code, west, south, east, north)
"""

# Numbers and other text in one column.
_RAW_NUMBERS = """
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN CAST(p_size AS VARCHAR(20))
  WHEN 1 THEN CAST(p_retailprice AS VARCHAR(20)) WHEN 2 THEN concat('-', CAST(p_partkey AS VARCHAR(20)))
  WHEN 3 THEN p_name ELSE '' END AS raw
FROM part
"""

VIEWS = {
    "all_pages": "SELECT page_id, html FROM pages",
    "positions": _POSITIONS,
    "messages": _MESSAGES,
    "register": _REGISTER,
    "name_register": _NAME_REGISTER,
    "vessel_pages": _VESSEL_PAGES,
    "ports": _PORTS,
    "raw_numbers": _RAW_NUMBERS,
}

SPARK_LATIN1 = _LATIN1.format(pattern=_OUTSIDE_LATIN1, every="")
DUCKDB_LATIN1 = _LATIN1.format(pattern=_OUTSIDE_LATIN1, every=", 'g'")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in BASE_TABLES:
        table = BASE_TABLES[name]
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if name == "vessel_pages":
            # Its rows are small and the pages made of them large: few tasks read many.
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.repartition(tasks, "p_partkey")
        rows.createOrReplaceTempView(table)
    return spark.sql(SPARK_LATIN1 if name == "latin1_register" else VIEWS[name])


def with_views(names: list[str], sql: str) -> str:
    """The statement with the named views as common table expressions in front.

    ``sql`` starts with SELECT or with further common table expressions.
    """
    views = ", ".join(
        f"{n} AS ({DUCKDB_LATIN1 if n == 'latin1_register' else VIEWS[n]})" for n in names
    )
    return f"WITH RECURSIVE {views}{' ' if sql.startswith('SELECT') else ', '}{sql}"
