"""Traffic tables derived from the driver's ``events``, ``part`` and ``customer``: observations, road network, speed segments.

The SQL of network and segments reads the same in Spark and in DuckDB but for the integer division.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OBSERVATIONS = """
SELECT obs_id, journey_id, local_time AS capture_time, local_time, speed_mph, link_key FROM (
  SELECT obs_id, journey_id, timestampadd(MICROSECOND, us, TIMESTAMP_NTZ'2025-09-20 19:00:00') AS local_time, speed_mph,
    CASE WHEN k % 20 = 0 THEN NULL ELSE concat('W', CAST(li div 4 AS STRING), '_0_', CAST(li AS STRING)) END AS link_key
  FROM (SELECT *, (us div 90000000 + user_id % 7) % 48 AS li FROM (
    SELECT event_id AS obs_id, concat('J', CAST(user_id AS STRING)) AS journey_id, user_id,
      timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 600 AS us,
      CAST(get_json_object(props, '$.k') AS INT) AS k, value AS speed_mph FROM {events})))"""

OBSERVATIONS_SQL = """
SELECT obs_id, journey_id, TIMESTAMP '2025-09-20 19:00:00' + to_microseconds(us) AS event_time, speed_mph,
  CASE WHEN k % 20 = 0 THEN NULL ELSE 'W' || (li // 4) || '_0_' || li END AS link_key
FROM (SELECT *, (us // 90000000 + user_id % 7) % 48 AS li FROM (
  SELECT event_id AS obs_id, 'J' || user_id AS journey_id, user_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 600 AS us,
    CAST(json_extract_string(props, '$.k') AS INT) AS k, value AS speed_mph FROM events)) WHERE journey_id IS NOT NULL"""

# The first parts make the ring (its links are observed), its reverse links and ramps, the others the other roads. Geometry is of all kinds.
NETWORK_SQL = """
SELECT net_id, link_key, from_node_id, to_node_id, heading, CAST(400 + 10 * (i % 5) AS DOUBLE) AS length, Matched_GID, geometry, name FROM (
  SELECT CAST(kind * 100 + i AS BIGINT) AS net_id, i, link_key, from_node_id, to_node_id, heading,
    CASE WHEN i % 11 = 10 THEN NULL ELSE concat(CAST(100 + (i div 4) AS {text}), '.0') END AS Matched_GID,
    CASE WHEN kind = 0 AND i % 13 = 12 THEN 'bad'
      WHEN kind = 1 THEN concat('LINESTRING (-', CAST(97300 - (i + 1) * 2 AS {text}), 'e-3 32.75, -', CAST(97300 - i * 2 AS {text}), 'e-3 32.75)')
      ELSE concat('LINESTRING (-', CAST(97300 - i * 2 AS {text}), 'e-3 32.75, -', CAST(97300 - (i + 1) * 2 AS {text}), 'e-3 32.75)') END AS geometry,
    concat('Road ', CAST(i AS {text})) AS name
  FROM (SELECT i, 0 AS kind, concat('W', CAST((i div 4) AS {text}), '_0_', CAST(i AS {text})) AS link_key, i AS from_node_id, (i + 1) % 48 AS to_node_id, CAST(90 + i % 3 AS DOUBLE) AS heading FROM {ring}
    UNION ALL SELECT i, 1, concat('R', CAST((i div 4) AS {text}), '_0_', CAST(i AS {text})), (i + 1) % 48, i, CAST(270 AS DOUBLE) FROM {ring}
    UNION ALL SELECT i, 2, concat('P', CAST(i AS {text}), '_1_', CAST(i AS {text})), i, 1000 + i, CAST(120 AS DOUBLE) FROM {ring} WHERE i % 6 = 0) AS u
  UNION ALL
  SELECT 1000 + i, i, concat('Q', CAST((i div 4) AS {text}), '_0_', CAST(i AS {text})), 10000 + i, 10001 + i, CAST(80 + p_size AS DOUBLE),
    CASE WHEN i % 11 = 10 THEN NULL ELSE CAST(1000 + (i div 50) AS {text}) END,
    CASE i % 6 WHEN 0 THEN concat('LINESTRING (', a, ' ', y, ', ', c, ' ', z, ')') WHEN 1 THEN concat('LINESTRING(', a, ' ', y, ',', b, ' ', z, ',', c, ' ', y, ')')
      WHEN 2 THEN concat('MULTILINESTRING ((', a, ' ', y, ', ', b, ' ', y, '), (', b, ' ', z, ', ', c, ' ', y, '))')
      WHEN 3 THEN concat('{{"type": "LineString", "coordinates": [[', a, ', ', y, '], [', b, ', ', z, '], [', c, ', ', z, ']]}}')
      WHEN 4 THEN concat('{{"type": "MultiLineString", "coordinates": [[[', a, ', ', y, '], [', b, ', ', y, ']], [[', b, ', ', z, '], [', c, ', ', z, ']]]}}') ELSE NULL END, p_name
  FROM (SELECT p_partkey AS i, p_size, p_name, concat('-', CAST(97000 - p_partkey % 50 * 2 AS {text}), 'e-3') AS a, concat('-', CAST(96999 - p_partkey % 50 * 2 AS {text}), 'e-3') AS b,
      concat('-', CAST(96998 - p_partkey % 50 * 2 AS {text}), 'e-3') AS c, concat(CAST(30000 + (p_partkey div 50) % 100 * 10 AS {text}), 'e-3') AS y, concat(CAST(30001 + (p_partkey div 50) % 100 * 10 AS {text}), 'e-3') AS z FROM {part} WHERE p_partkey > 48) AS q) AS n"""

#: The first parts.
RING_SQL = "(SELECT p_partkey - 1 AS i FROM {part} WHERE p_partkey <= 48) AS x"

# The first customers' segments are along the ring, the others' beside the other roads.
SEGMENTS_SQL = """
SELECT LinkID, GID, CASE WHEN k = 5 THEN 'bad' WHEN k < 0 AND h % 3 = 1 THEN concat('LINESTRING (-', a, 'e-3 ', lat, ', -', b, 'e-3 ', lat2, ', -', c, 'e-3 ', lat, ')')
    WHEN k < 0 AND h % 3 = 2 THEN concat('MULTILINESTRING ((-', a, 'e-3 ', lat, ', -', b, 'e-3 ', lat, '), (-', b, 'e-3 ', lat2, ', -', c, 'e-3 ', lat2, '))')
    ELSE concat('LINESTRING (-', a, 'e-3 ', lat, ', -', c, 'e-3 ', lat, ')') END AS Geometry, Heading, SpeedLimit
FROM (
  SELECT c_custkey AS LinkID, h, k, concat(CAST(100 + g AS {text}), CASE WHEN k % 2 = 0 THEN '' ELSE '.0' END) AS GID, CAST(97300 - g * 8 AS {text}) AS a, CAST(97296 - g * 8 AS {text}) AS b, CAST(97292 - g * 8 AS {text}) AS c,
    concat(CAST(CASE k WHEN 2 THEN 3275050 WHEN 3 THEN 3276000 ELSE 3275000 END + c_nationkey AS {text}), 'e-5') AS lat, '0' AS lat2,
    CAST(CASE k WHEN 1 THEN 270 WHEN 2 THEN NULL ELSE 90 END AS DOUBLE) AS Heading, CAST(CASE WHEN k = 4 OR g = 9 THEN 0 ELSE 30 + 5 * ((g + k) % 6) END AS DOUBLE) AS SpeedLimit
  FROM (SELECT c_custkey, c_nationkey, c_custkey AS h, c_custkey % 12 AS g, (c_custkey div 12) % 6 AS k FROM {customer} WHERE c_custkey <= 144) AS r
  UNION ALL
  SELECT c_custkey, h, -1, CAST(1000 + g AS {text}), CAST(97000 - h % 25 * 4 AS {text}), CAST(96998 - h % 25 * 4 AS {text}), CAST(96996 - h % 25 * 4 AS {text}),
    concat(CAST(3000000 + g % 100 * 1000 + c_nationkey * 7 AS {text}), 'e-5'), concat(CAST(3000050 + g % 100 * 1000 + c_nationkey * 7 AS {text}), 'e-5'),
    CASE WHEN h % 5 = 4 THEN NULL ELSE CAST(70 + c_nationkey * 2 AS DOUBLE) END, CASE WHEN h % 7 = 6 THEN NULL WHEN h % 7 = 5 THEN CAST(0 AS DOUBLE) ELSE CAST(25 + 5 * (c_nationkey % 8) AS DOUBLE) END
  FROM (SELECT c_custkey, c_nationkey, c_custkey AS h, c_custkey * 4 div 150 AS g FROM {customer} WHERE c_custkey > 144) AS o) AS m"""


def duck(sql: str) -> str:
    return sql.format(text="VARCHAR", ring=RING_SQL.format(part="part"), part="part", customer="customer").replace(" div ", " // ")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_OBSERVATIONS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


#: Every third observation in the order of the input belongs to one journey then.
HOT_OBSERVATIONS_SQL = "SELECT * REPLACE (CASE WHEN obs_id % 3 = 0 THEN 'J0' ELSE journey_id END AS journey_id) FROM obs"


def hot_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All observations, a third of them of one journey."""
    return observations(spark, sf_dir).withColumn("journey_id", F.when(F.col("obs_id") % 3 == 0, "J0").otherwise(F.col("journey_id")))


def _tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` with the names of its tables as Spark fills them in."""
    own = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "customer")}
    named = sql.format(text="STRING", ring=RING_SQL.format(part="@part@"), **{t: f"@{t}@" for t in own}).replace("{", "{{").replace("}", "}}")
    used = {t: df for t, df in own.items() if f"@{t}@" in named}
    for t in used:
        named = named.replace(f"@{t}@", f"{{{t}}}")
    return spark.sql(named, **used)


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, NETWORK_SQL)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir, SEGMENTS_SQL)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links of the ring: its reverse links and ramps, and the other roads, have no observations."""
    return network(spark, sf_dir).filter("net_id < 100").select("link_key")
