"""Pattern mining and segmentation."""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.predicates import BASKET_HOURS, time_bucket
from quarry.operators import patterns as M
from quarry.operators import quality as Q
from quarry.operators import segment as SG
from quarry.plans import standins as S
from quarry.plans.fitted import fitted
from quarry.plans.registry import register, with_
from quarry.session import bounded_parts, cut_lineage
from quarry.plans.trip_queries import BASE, BOTH, SQ, rules8, rules_both


def basket_df(spark, d):
    t = Q.clean(S.trips_both_ends(spark, d), rules_both())
    t = t.withColumn("time_bucket", time_bucket("pickup_ts", BASKET_HOURS))
    return M.baskets(t, ["pickup_zone", "dropoff_zone", "time_bucket"])


BK_SQL = (*BOTH, f"""cb AS (SELECT * FROM trips_b
  WHERE total_amount IS NOT NULL AND total_amount > 0 AND total_amount <= 200 AND trip_distance > 0 AND trip_distance <= 100
    AND PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ} AND DO_Borough IS NOT NULL AND DO_Borough NOT IN {SQ}
    AND passenger_count > 0)""", """bk AS (SELECT list_sort(list_distinct(list_filter([pickup_zone, dropoff_zone,
  CASE WHEN hour(pickup_ts) >= 5 AND hour(pickup_ts) < 12 THEN 'morning' WHEN hour(pickup_ts) >= 12 AND hour(pickup_ts) < 17 THEN 'afternoon'
       WHEN hour(pickup_ts) >= 17 AND hour(pickup_ts) < 22 THEN 'evening' ELSE 'night' END], lambda x: x IS NOT NULL))) AS items FROM cb)""",
          """subsets AS (
  SELECT [x] AS s FROM (SELECT unnest(items) AS x FROM bk)
  UNION ALL SELECT [items[1], items[2]] FROM bk WHERE len(items) >= 2
  UNION ALL SELECT [items[1], items[3]] FROM bk WHERE len(items) = 3
  UNION ALL SELECT [items[2], items[3]] FROM bk WHERE len(items) = 3
  UNION ALL SELECT items FROM bk WHERE len(items) = 3)""",
          """nb AS (SELECT count(*) AS n FROM bk)""",
          """fi AS (SELECT s AS items, len(s) AS size, count(*) AS freq FROM subsets GROUP BY s
  HAVING count(*) >= ceil(0.001 * (SELECT n FROM nb)))""",
          """ru AS (SELECT list_sort(list_filter(x.items, lambda y: y <> c.c)) AS antecedent, c.c AS consequent,
  x.freq / (SELECT n FROM nb) AS support, x.freq / a.freq AS confidence,
  (x.freq / a.freq) / (k.freq / (SELECT n FROM nb)) AS lift
  FROM fi x, (SELECT items AS its, unnest(items) AS c FROM fi WHERE size >= 2) c, fi a, fi k
  WHERE x.items = c.its AND a.items = list_sort(list_filter(x.items, lambda y: y <> c.c)) AND k.items = [c.c]
    AND x.freq / a.freq >= 0.2)""")


@register("M1_F13_baskets", with_(*BK_SQL) + "SELECT items, count(*) AS n FROM bk GROUP BY items")
def m1(spark, d):
    b = basket_df(spark, d).select(F.array_sort("items").alias("items"))
    return b.groupBy("items").agg(F.count(F.lit(1)).alias("n"))


def fp(spark, d):
    """One fit for the four queries that read it."""
    def fit():
        b = cut_lineage(basket_df(spark, d))
        n = b.count()
        # FP-growth keeps baskets as objects, some 300 bytes each, in the partitions it is given
        return M.fit_fpgrowth(bounded_parts(b, 250_000, n), 0.001, 0.2), n
    return fitted(spark, d, "patterns", ("lineitem", "orders", "supplier", "customer", "nation", "region"), fit)


@register("M2_frequent_itemsets", with_(*BK_SQL) + """
SELECT items, CAST(size AS INTEGER) AS size, freq, round(freq / (SELECT n FROM nb), 9) AS support FROM fi""")
def m2(spark, d):
    model, n = fp(spark, d)
    return M.frequent_itemsets(model, n)


@register("M3_association_rules", with_(*BK_SQL) + """
SELECT antecedent, consequent, round(support, 9) AS support, round(confidence, 9) AS confidence, round(lift, 9) AS lift FROM ru""")
def m3(spark, d):
    return M.association_rules(fp(spark, d)[0])


@register("M4_top_rules_by_confidence", with_(*BK_SQL) + """
SELECT antecedent, consequent, round(support, 9) AS support, round(confidence, 9) AS confidence, round(lift, 9) AS lift FROM ru
ORDER BY round(confidence, 9) DESC, CAST(antecedent AS VARCHAR), consequent LIMIT 10""")
def m4(spark, d):
    return M.top_rules(M.association_rules(fp(spark, d)[0]), "confidence", 10)


@register("M4_top_rules_by_lift", with_(*BK_SQL) + """
SELECT antecedent, consequent, round(support, 9) AS support, round(confidence, 9) AS confidence, round(lift, 9) AS lift FROM ru
ORDER BY round(lift, 9) DESC, CAST(antecedent AS VARCHAR), consequent LIMIT 10""")
def m4b(spark, d):
    return M.top_rules(M.association_rules(fp(spark, d)[0]), "lift", 10)


C8_SQL = f"""c8 AS (SELECT * FROM trips_z
  WHERE total_amount IS NOT NULL AND total_amount > 0 AND total_amount <= 200 AND trip_distance > 0 AND trip_distance <= 100
    AND passenger_count > 0 AND passenger_count <= 9 AND PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ})"""
SEG_SQL = (*BASE, C8_SQL, """seg AS (SELECT PULocationID, CASE WHEN hour(pickup_ts) >= 6 AND hour(pickup_ts) < 12 THEN 'morning'
  WHEN hour(pickup_ts) >= 12 AND hour(pickup_ts) < 17 THEN 'afternoon' WHEN hour(pickup_ts) >= 17 AND hour(pickup_ts) < 22 THEN 'evening'
  ELSE 'night' END AS time_of_day, avg(trip_distance) AS avg_trip_distance, avg(total_amount) AS avg_total_amount
  FROM c8 GROUP BY ALL)""")


def seg_features(spark, d):
    return SG.segment_features(Q.clean(S.trips_zoned(spark, d), rules8()))


@register("M5_segment_features", with_(*SEG_SQL) + """
SELECT PULocationID, time_of_day, round(avg_trip_distance, 9) AS avg_trip_distance, round(avg_total_amount, 9) AS avg_total_amount FROM seg""")
def m5(spark, d):
    f = seg_features(spark, d)
    return f.select("PULocationID", "time_of_day", F.round("avg_trip_distance", 9).alias("avg_trip_distance"),
                    F.round("avg_total_amount", 9).alias("avg_total_amount"))


IDX_SQL = """ix AS (SELECT time_of_day, CAST(row_number() OVER (ORDER BY count(*) DESC, time_of_day) - 1 AS DOUBLE) AS idx
  FROM seg GROUP BY time_of_day)"""


@register("M6_string_index_frequency_desc", with_(*SEG_SQL, IDX_SQL) + """
SELECT time_of_day, idx AS time_of_day_index, count(*) AS n FROM seg JOIN ix USING (time_of_day) GROUP BY ALL""")
def m6(spark, d):
    enc, _ = SG.index_and_encode(seg_features(spark, d), "time_of_day")
    return enc.groupBy("time_of_day", "time_of_day_index").agg(F.count(F.lit(1)).alias("n"))


@register("M7_one_hot_drop_last", with_(*SEG_SQL, IDX_SQL) + """
SELECT PULocationID, time_of_day, CAST([CASE WHEN idx = 0 THEN 1.0 ELSE 0.0 END, CASE WHEN idx = 1 THEN 1.0 ELSE 0.0 END,
       CASE WHEN idx = 2 THEN 1.0 ELSE 0.0 END] AS DOUBLE[]) AS one_hot
FROM seg JOIN ix USING (time_of_day)""")
def m7(spark, d):
    enc, _ = SG.index_and_encode(seg_features(spark, d), "time_of_day")
    return enc.select("PULocationID", "time_of_day", vector_to_array("time_of_day_vec").alias("one_hot"))


@register("M13_standard_scaling", with_(*SEG_SQL) + """
SELECT PULocationID, time_of_day,
  [round((avg_trip_distance - (SELECT avg(avg_trip_distance) FROM seg)) / (SELECT stddev_samp(avg_trip_distance) FROM seg), 6),
   round((avg_total_amount - (SELECT avg(avg_total_amount) FROM seg)) / (SELECT stddev_samp(avg_total_amount) FROM seg), 6)] AS scaled
FROM seg""")
def m13(spark, d):
    s = SG.standardise(seg_features(spark, d), ["avg_trip_distance", "avg_total_amount"])
    return s.select("PULocationID", "time_of_day", F.transform("scaled", lambda x: F.round(x, 6)).alias("scaled"))
