"""Road, ping and vehicle views derived from the given tables.

The same text runs in Spark and in the checking engine; only the expression for
"microseconds since the epoch" differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("nation", "customer", "supplier", "orders", "events")
SPARK_EPOCH_US = "unix_micros(CAST(ts AS TIMESTAMP))"
DUCK_EPOCH_US = "epoch_us(ts)"
_SUPPLIERS = "(SELECT COUNT(*) FROM supplier)"


def _padded(number: str) -> str:
    return f"LPAD(CAST({number} AS STRING), CAST(GREATEST(4, LENGTH(CAST({number} AS STRING))) AS INT), '0')"


VIEWS: dict[str, str] = {
    "f_nodes": """
SELECT s_suppkey AS node_seq, CAST(s_suppkey AS STRING) AS node_id,
       21e0 + CAST((s_suppkey * 7919) % 4000 AS DOUBLE) / 1e5 AS lat,
       105.8e0 + CAST((s_suppkey * 104729) % 5000 AS DOUBLE) / 1e5 AS lon
FROM supplier
UNION ALL
SELECT 1000000 + n_nationkey, CONCAT('N', CAST(n_nationkey AS STRING)),
       21.02e0 + CAST(n_nationkey AS DOUBLE) / 1e3, 105.81e0 + CAST(n_nationkey % 5 AS DOUBLE) / 2e2
FROM nation""",
    "f_way_nodes": f"""
SELECT s_suppkey AS way_id, 0 AS pos, CAST(s_suppkey AS STRING) AS ref FROM supplier
UNION ALL SELECT s_suppkey, 1, CAST((s_suppkey + 1) % {_SUPPLIERS} AS STRING) FROM supplier
UNION ALL SELECT s_suppkey, 2, CAST((s_suppkey * 3 + 1) % {_SUPPLIERS} AS STRING) FROM supplier
UNION ALL SELECT s_suppkey, 3, CASE WHEN s_suppkey % 11 = 10 THEN 'missing'
                 ELSE CAST((s_suppkey * 7 + 2) % {_SUPPLIERS} AS STRING) END FROM supplier
UNION ALL SELECT 1000000 + n_nationkey, 0, CONCAT('N', CAST(n_nationkey AS STRING)) FROM nation
UNION ALL SELECT 1000000 + n_nationkey, 1, CONCAT('N', CAST((n_nationkey + 5) % 25 AS STRING)) FROM nation""",
    "f_way_tags": """
SELECT s_suppkey AS way_id,
       CASE s_suppkey % 7 WHEN 6 THEN 'footway' WHEN 1 THEN 'primary' ELSE 'residential' END AS highway,
       CASE s_suppkey % 4 WHEN 0 THEN '50' WHEN 1 THEN '30' WHEN 2 THEN '50 mph' END AS maxspeed,
       CASE s_suppkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '-1' END AS oneway,
       CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name
FROM supplier
UNION ALL SELECT 1000000 + n_nationkey, 'residential', NULL, NULL, n_name FROM nation""",
    "f_pings": f"""
SELECT event_id AS ping_id,
       CASE user_id % 5 WHEN 0 THEN 'Truck' WHEN 4 THEN 'Walker' ELSE 'Bot' END AS entity_type,
       CONCAT(CASE user_id % 5 WHEN 0 THEN 'Truck_' WHEN 4 THEN 'Walker_' ELSE 'Bot_' END,
              {_padded('user_id')}) AS entity_id,
       CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE 21e0 + CAST((event_id * 6151) % 4000 AS DOUBLE) / 1e5 END AS latitude,
       CASE WHEN event_id % 89 = 0 THEN NULL
            ELSE 105.8e0 + CAST((event_id * 3571) % 5000 AS DOUBLE) / 1e5 END AS longitude,
       CASE WHEN event_type = 'error' THEN value % 5e0 WHEN event_id % 61 = 0 THEN 0e0
            ELSE value % 60e0 END AS speed,
       1704067200000 + CAST(FLOOR((EPOCH_US_TS - 1704067200000000) / 1e6) AS BIGINT) AS timestamp
FROM events""",
    # Every customer is a stop: blocks of 25 are dealt to five vehicles with 3 to 7 stops each.
    "f_stops": f"""
WITH dealt AS (
  SELECT c_custkey,
         CAST(FLOOR(c_custkey / 25e0) AS BIGINT) * 5
           + CASE WHEN c_custkey % 25 < 3 THEN 0 WHEN c_custkey % 25 < 7 THEN 1 WHEN c_custkey % 25 < 12 THEN 2
                  WHEN c_custkey % 25 < 18 THEN 3 ELSE 4 END AS v,
         CAST(c_custkey % 25 - CASE WHEN c_custkey % 25 < 3 THEN 0 WHEN c_custkey % 25 < 7 THEN 3
              WHEN c_custkey % 25 < 12 THEN 7 WHEN c_custkey % 25 < 18 THEN 12 ELSE 18 END AS INT) AS stop_idx
  FROM customer)
SELECT v + 1 AS vehicle_no, CONCAT('Truck_', {_padded('v + 1')}) AS vehicle_id, stop_idx,
       CONCAT('Cust_', CAST(c_custkey AS STRING)) AS cust_id,
       21e0 + CAST((c_custkey * 5003) % 4000 AS DOUBLE) / 1e5 AS latitude,
       105.8e0 + CAST((c_custkey * 9973) % 5000 AS DOUBLE) / 1e5 AS longitude
FROM dealt""",
    "f_route_updates": f"""
SELECT o_orderkey AS update_seq,
       CONCAT('Truck_', {_padded(f'o_custkey % {_SUPPLIERS}')}) AS vehicle_id,
       CASE WHEN o_orderkey % 7 = 0 THEN ''
            ELSE CONCAT('E_', CAST(o_custkey % {_SUPPLIERS} AS STRING), '_',
                        CAST((o_custkey % {_SUPPLIERS} + 1) % {_SUPPLIERS} AS STRING)) END AS path_csv,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice % 5000e0 END AS time
FROM orders""",
}


def view_text(name: str, engine: str) -> str:
    return VIEWS[name].replace("EPOCH_US_TS", SPARK_EPOCH_US if engine == "spark" else DUCK_EPOCH_US)


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the parquet tables in ``sf_dir``, independent of the session's catalog."""
    text = view_text(name, "spark")
    sources = {}
    for table in TABLES:
        if f"FROM {table}" in text:
            text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
            sources[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(text, **sources)


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Way rows as a map file gives them: ordered refs (at most four here) and a tag list."""
    refs = (load_view(spark, sf_dir, "f_way_nodes").groupBy("way_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "ref"))).alias("members"))
            .select("way_id", F.col("members.ref").alias("refs")))
    tags = load_view(spark, sf_dir, "f_way_tags").select(
        "way_id",
        F.filter(F.array(*[F.struct(F.lit(k).alias("_k"), F.col(k).alias("_v"))
                           for k in ("highway", "maxspeed", "oneway", "name")]),
                 lambda t: t["_v"].isNotNull()).alias("tags"))
    return refs.join(tags, "way_id")
