"""Stand-ins for the reference's inputs, derived from the fixture tables.

Each Spark builder has a matching SQL CTE so the oracle sees the same rows.
Fixed derivation constants (chosen so every cleaning rule removes rows):
  total_amount  = l_extendedprice / 500 - 5   (null where l_tax = 0)
  trip_distance = (l_quantity - 2) * 2.1
  passengers    = l_linenumber - 1
  pickup time   = l_shipdate + ((l_orderkey*37 + l_linenumber*11) mod 1440) minutes
  pickup zone   = supplier -> nation (Zone) -> region (Borough)
  dropoff zone  = orders.o_custkey -> customer -> nation -> region
  ratings       = orders x lineitem: user o_custkey, item l_partkey,
                  rating 1 + floor((l_quantity - 1) / 10)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.predicates import DEFAULT_SENTINELS, ntz_epoch_seconds

# Fixture: one region plays the role of an unknown borough.
FIXTURE_SENTINELS = tuple(DEFAULT_SENTINELS) + ("MIDDLE EAST",)
SENTINELS_SQL = "('Unknown', 'N/A', '', 'None', 'MIDDLE EAST')"
FOCUS_BOROUGH = "AMERICA"   # stands in for the borough studied in depth


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def trips(spark: SparkSession, d: str, dropoff: bool = False) -> DataFrame:
    li = table(spark, d, "lineitem")
    t = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_id"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_orderkey"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice") / 500.0 - 5.0).alias("total_amount"),
        ((F.col("l_quantity") - 2.0) * 2.1).alias("trip_distance"),
        (F.col("l_linenumber") - 1).cast("double").alias("passenger_count"),
        F.timestamp_add("MINUTE", (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 1440,
                        F.col("l_shipdate")).alias("pickup_ts"),
    )
    if dropoff:
        o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.col("o_custkey").alias("DOLocationID"))
        t = t.join(o, "l_orderkey", "left")
    return t


TRIPS_SQL = """trips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_id, l_suppkey AS PULocationID, l_orderkey,
         CASE WHEN l_tax = 0 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice / 500.0 - 5.0 END AS total_amount,
         (l_quantity - 2.0) * 2.1 AS trip_distance,
         CAST(l_linenumber - 1 AS DOUBLE) AS passenger_count,
         l_shipdate + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 11) % 1440 AS BIGINT)) AS pickup_ts
  FROM lineitem)"""

TRIPS_DO_SQL = """trips_do AS (
  SELECT t.*, o_custkey AS DOLocationID FROM trips t LEFT JOIN orders ON t.l_orderkey = o_orderkey)"""


def zones_pickup(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("LocationID"), F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone")))


ZONES_PU_SQL = """zones_pu AS (
  SELECT s_suppkey AS LocationID, r_name AS Borough, n_name AS Zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def zones_dropoff(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("LocationID"), F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone")))


ZONES_DO_SQL = """zones_do AS (
  SELECT c_custkey AS LocationID, r_name AS Borough, n_name AS Zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def trips_zoned(spark: SparkSession, d: str) -> DataFrame:
    """Trips with pickup borough / zone."""
    from quarry.operators.joins import enrich
    return enrich(trips(spark, d), zones_pickup(spark, d), "PULocationID", "LocationID",
                  {"Borough": "PU_Borough", "Zone": "Zone"})


TRIPS_ZONED_SQL = """trips_z AS (
  SELECT t.*, z.Borough AS PU_Borough, z.Zone AS Zone
  FROM trips t LEFT JOIN zones_pu z ON t.PULocationID = z.LocationID)"""


def trips_both_ends(spark: SparkSession, d: str) -> DataFrame:
    """Trips with pickup and dropoff borough / zone."""
    from quarry.operators.joins import enrich_roles
    t = trips(spark, d, dropoff=True)
    t = enrich_roles(t, zones_pickup(spark, d), "LocationID",
                     {"PULocationID": {"Borough": "PU_Borough", "Zone": "pickup_zone"}})
    return enrich_roles(t, zones_dropoff(spark, d), "LocationID",
                        {"DOLocationID": {"Borough": "DO_Borough", "Zone": "dropoff_zone"}})


TRIPS_BOTH_SQL = """trips_b AS (
  SELECT t.*, p.Borough AS PU_Borough, p.Zone AS pickup_zone, q.Borough AS DO_Borough, q.Zone AS dropoff_zone
  FROM trips_do t LEFT JOIN zones_pu p ON t.PULocationID = p.LocationID
                  LEFT JOIN zones_do q ON t.DOLocationID = q.LocationID)"""


def ratings(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
                    (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("int").alias("rating"),
                    ntz_epoch_seconds("o_orderdate").alias("ts"))


RATINGS_SQL = """ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER) AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Delimited text lines ``borough,amount`` plus malformed ones, as a ``value`` column.

    * one line per trip: ``region,amount`` (5 decimals; blank amount where null)
    * one line per customer: ``segment,acctbal`` with a blank key for HOUSEHOLD
    * one line per nation: ``name`` only (one field), ``name,region`` (non-numeric)
      and ``name,<key>.5d`` (a number with a suffix: malformed)
    """
    t = trips_zoned(spark, d)
    a = t.select(F.concat_ws(",", F.col("PU_Borough"), F.when(F.col("total_amount").isNull(), F.lit("")).otherwise(F.format_string("%.5f", F.col("total_amount")))).alias("value"))
    c = table(spark, d, "customer").select(F.concat_ws(",", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("")).otherwise(F.col("c_mktsegment")), F.format_string("%.2f", F.col("c_acctbal"))).alias("value"))
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    one = n.select(F.col("n_name").alias("value"))
    bad = nr.select(F.concat_ws(",", "n_name", "r_name").alias("value"))
    odd = n.select(F.concat_ws(",", "n_name", F.concat(F.col("n_nationkey").cast("string"), F.lit(".5d"))).alias("value"))
    return a.unionByName(c).unionByName(one).unionByName(bad).unionByName(odd)


LINES_SQL = """lines AS (
  SELECT concat_ws(',', PU_Borough, coalesce(printf('%.5f', total_amount), '')) AS value FROM trips_z
  UNION ALL
  SELECT concat_ws(',', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_mktsegment END, printf('%.2f', c_acctbal)) FROM customer
  UNION ALL
  SELECT n_name FROM nation
  UNION ALL
  SELECT concat_ws(',', n_name, r_name) FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT concat_ws(',', n_name, n_nationkey || '.5d') FROM nation)"""
