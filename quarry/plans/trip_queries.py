"""Trip-revenue workload: scans, predicates, cleaning, joins, aggregates (S, P, Q, J, G, K)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import predicates as P
from quarry.operators import aggregate as G
from quarry.operators import increments as I
from quarry.operators import quality as Q
from quarry.operators.joins import enrich, members
from quarry.operators.membership import members_filtered
from quarry.plans import standins as S
from quarry.plans.registry import register, with_
from quarry.sources import io
from quarry.sources import tolerant as TS

SENT = S.FIXTURE_SENTINELS
SQ = S.SENTINELS_SQL
BASE = (S.TRIPS_SQL, S.ZONES_PU_SQL, S.TRIPS_ZONED_SQL)

CLEAN6_SQL = f"""clean AS (
  SELECT * FROM trips_z
  WHERE total_amount IS NOT NULL AND total_amount > 0 AND total_amount <= 200
    AND trip_distance > 0 AND trip_distance <= 100
    AND PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ})"""


def rules6():
    return Q.trip_rules(borough=("PU_Borough",), sentinels=SENT)


def rules8():
    return Q.trip_rules(borough=("PU_Borough",), passengers="passenger_count", sentinels=SENT)


def rules_both():
    return Q.trip_rules(borough=("PU_Borough", "DO_Borough"), passengers="passenger_count",
                        max_passengers=None, sentinels=SENT, passengers_last=True)


def cleaned(spark, d):
    return Q.clean(S.trips_zoned(spark, d), rules6())


# ---------------------------------------------------------------- flagship

def revenue_by_zone(spark, d):
    """S1 -> J2 -> Q1 -> G4 -> K1: top-10 (zone, borough) by cleaned revenue."""
    c = cleaned(spark, d)
    g = c.groupBy("Zone", "PU_Borough").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.round(F.sum("total_amount"), 2).alias("total_fare"),
        F.round(F.avg("total_amount"), 4).alias("avg_fare"))
    return g.orderBy(F.desc("total_fare"), "Zone").limit(10)


register("G4_revenue_by_zone_top10", with_(*BASE, CLEAN6_SQL) + """
SELECT Zone, PU_Borough, count(*) AS trip_count, round(sum(total_amount), 2) AS total_fare,
       round(avg(total_amount), 4) AS avg_fare
FROM clean GROUP BY Zone, PU_Borough ORDER BY total_fare DESC, Zone LIMIT 10""")(revenue_by_zone)

# ---------------------------------------------------------------- S: sources


@register("S1_parquet_scan_pruned", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity >= 49""")
def s1(spark, d):
    li = io.read_table(spark, f"{d}/lineitem.parquet")
    return li.where(F.col("l_quantity") >= 49).select("l_orderkey", "l_linenumber", "l_extendedprice")


def _scratch(spark, name):
    import uuid
    from quarry.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/quarry-scratch/{name}-{uuid.uuid4().hex}"


@register("S2_csv_zones_roundtrip", with_(S.ZONES_PU_SQL) + """
SELECT CAST(LocationID AS INTEGER) AS LocationID, Borough, Zone, 'Boro Zone' AS service_zone FROM zones_pu""")
def s2(spark, d):
    z = S.zones_pickup(spark, d).select(F.col("LocationID").cast("int"), "Borough", "Zone",
                                        F.lit("Boro Zone").alias("service_zone"))
    p = _scratch(spark, "zones_csv")
    z.write.mode("overwrite").csv(p, header=True)
    return io.read_csv(spark, p, io.ZONES_SCHEMA)


@register("S3_tsv_ratings_roundtrip", with_(S.RATINGS_SQL) + """
SELECT CAST("user" AS INTEGER) AS userId, CAST(item AS INTEGER) AS movieId, rating,
       ts AS "timestamp", to_timestamp(ts)::TIMESTAMP AS rated_at
FROM ratings""")
def s3(spark, d):
    r = S.ratings(spark, d).select(F.col("user").cast("int"), F.col("item").cast("int"), "rating", "ts")
    p = _scratch(spark, "ratings_tsv")
    r.write.mode("overwrite").csv(p, sep="\t", header=False)
    t = io.read_delimited(spark, p, "\t", io.RATINGS_TSV_SCHEMA)
    return t.withColumn("rated_at", P.epoch_to_ntz("timestamp"))


PARSE_SQL = """pairs AS (
  SELECT CASE WHEN split_part(trim(value), ',', 1) = '' THEN 'Unknown' ELSE split_part(trim(value), ',', 1) END AS "key",
         TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) AS value
  FROM lines
  WHERE value IS NOT NULL AND len(string_split(trim(value), ',')) >= 2
    AND TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) > 0
    AND NOT isnan(TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE)))"""


@register("S4_parse_pairs", with_(*BASE, S.LINES_SQL, PARSE_SQL) + """
SELECT "key", value FROM pairs""")
def s4(spark, d):
    return io.parse_pairs(S.lines(spark, d))


TAB_SQL = """tabbed AS (SELECT replace(value, ',', chr(9)) AS value FROM lines)"""


@register("S4_parse_pairs_tabs", with_(*BASE, S.LINES_SQL, TAB_SQL) + """
SELECT split_part(trim(value), chr(9), 1) AS "key", TRY_CAST(split_part(trim(value), chr(9), 2) AS DOUBLE) AS value
FROM tabbed WHERE len(string_split(trim(value), chr(9))) >= 2 AND TRY_CAST(split_part(trim(value), chr(9), 2) AS DOUBLE) > 0""")
def s4_tabs(spark, d):
    """Tab-separated form: malformed lines are skipped, the key is taken as it stands."""
    ln = S.lines(spark, d).select(F.translate("value", ",", "\t").alias("value"))
    return io.parse_pairs(ln, sep="\t", default_key=None)


@register("S4_parse_pairs_header", with_(*BASE, S.LINES_SQL) + """
SELECT split_part(trim(value), ',', 1) AS "key", TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) AS value
FROM (SELECT value FROM lines UNION ALL SELECT 'n_name,amount' FROM nation)
WHERE NOT starts_with(value, 'n_name') AND len(string_split(trim(value), ',')) >= 2
  AND TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) > 0""")
def s4_header(spark, d):
    """Header lines are skipped and a blank key is kept."""
    head = S.table(spark, d, "nation").select(F.lit("n_name,amount").alias("value"))
    return io.parse_pairs(S.lines(spark, d).unionByName(head), default_key=None, skip_prefixes=("n_name",))


REASON_SQL = """reasons AS (
  SELECT CASE WHEN value IS NULL THEN 'null_line' WHEN starts_with(value, 'n_name') THEN 'header'
              WHEN len(string_split(trim(value), ',')) < 2 THEN 'too_few_fields'
              WHEN TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) IS NULL OR isnan(TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE)) THEN 'not_a_number'
              WHEN TRY_CAST(split_part(trim(value), ',', 2) AS DOUBLE) <= 0 THEN 'not_positive' ELSE 'kept' END AS reason
  FROM (SELECT value FROM lines UNION ALL SELECT 'n_name,amount' FROM nation))"""


@register("S4_rejected_lines_by_reason", with_(*BASE, S.LINES_SQL, REASON_SQL) + """
SELECT reason, count(*) AS n FROM reasons GROUP BY reason""")
def s4_rejected(spark, d):
    """Why lines are left out; with the kept ones they are all lines."""
    head = S.table(spark, d, "nation").select(F.lit("n_name,amount").alias("value"))
    return TS.rejected_counts(TS.parse_pairs_checked(S.lines(spark, d).unionByName(head), skip_prefixes=("n_name",)))


BAD_CSV_SQL = """rec AS (SELECT CASE WHEN l_linenumber = 7 THEN 1 WHEN l_orderkey % 5 = 0 THEN 2 WHEN l_orderkey % 7 = 0 THEN 3 ELSE 0 END AS fault,
  CAST(l_orderkey AS INTEGER) AS id, CAST(l_quantity AS DOUBLE) AS q FROM lineitem)"""


@register("S2_rejected_records_by_reason", with_(BAD_CSV_SQL) + """
SELECT CASE fault WHEN 1 THEN 'field_count' WHEN 2 THEN 'bad_id' WHEN 3 THEN 'bad_q' ELSE 'kept' END AS reason, count(*) AS n,
       round(coalesce(sum(CASE WHEN fault = 0 THEN q END), 0), 2) AS total
FROM rec GROUP BY ALL""")
def s2_rejected(spark, d):
    """A CSV with records of too few fields and with text in number columns."""
    from pyspark.sql import types as T
    li = S.table(spark, d, "lineitem")
    k, q = F.col("l_orderkey").cast("string"), F.col("l_quantity").cast("double").cast("string")
    text = F.when(F.col("l_linenumber") == 7, k).when(F.col("l_orderkey") % 5 == 0, F.concat(F.lit("x"), k, F.lit(","), q)) \
        .when(F.col("l_orderkey") % 7 == 0, F.concat(k, F.lit(",much"))).otherwise(F.concat(k, F.lit(","), q))
    p = _scratch(spark, "bad_csv")
    li.select(text).write.text(p)
    c = TS.read_csv_checked(spark, p, T.StructType([T.StructField("id", T.IntegerType()), T.StructField("q", T.DoubleType())]), header=False)
    kept, rejected = TS.write_checked(c, _scratch(spark, "checked_csv"))
    both = kept.select(F.lit("kept").alias("reason"), "q").unionByName(rejected.select("reason", "q"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("q"), F.lit(0.0)), 2).alias("total"))


@register("S1_files_of_differing_schemas", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_tax AS DOUBLE) END AS l_tax, 'm' || (l_linenumber % 3) AS month
FROM lineitem""")
def s1_widened(spark, d):
    """Three files: whole numbers, doubles and decimals in one column, one without a column, one with it in capitals."""
    li = S.table(spark, d, "lineitem")
    kinds = [("int", "int", "int", None, None), ("bigint", "smallint", "double", "double", "l_tax"), ("bigint", "tinyint", "decimal(12,2)", "double", "L_TAX")]
    root, paths = _scratch(spark, "months"), []
    for m, (a, b, c, t, name) in enumerate(kinds):
        cols = [F.col("l_orderkey").cast(a), F.col("l_linenumber").cast(b), F.col("l_quantity").cast(c)] + ([F.col("l_tax").cast(t).alias(name)] if name else [])
        li.where(F.col("l_linenumber") % 3 == m).select(*cols).write.parquet(f"{root}/m{m}")
        paths.append(f"{root}/m{m}")
    r = TS.read_widened(spark, paths, "file")
    return r.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.regexp_extract("file", "/(m[0-9])/[^/]*$", 1).alias("month"))


@register("G6_increments_merged", with_(*BASE, S.LINES_SQL, PARSE_SQL) + """
SELECT "key", round(sum(value), 2) AS total_revenue, count(*) AS trip_count,
       round(avg(value), 4) AS avg_fare, min(value) AS min_fare, max(value) AS max_fare
FROM pairs GROUP BY "key" """)
def g6_increments(spark, d):
    """Three increments, one of them loaded twice, merged from their partial results."""
    folder, ln = _scratch(spark, "pair_parts"), S.lines(spark, d)
    for m in (0, 1, 2, 1):
        own = ln.where(F.pmod(F.coalesce(F.xxhash64("value"), F.lit(0)), F.lit(3)) == m)
        I.store_part(I.pair_part(io.parse_pairs(own)), folder, f"m{m}")
    r = I.merge_pairs(I.stored_parts(spark, folder))
    return r.select("key", F.round("total_revenue", 2).alias("total_revenue"), "trip_count", F.round("avg_fare", 4).alias("avg_fare"), "min_fare", "max_fare")


@register("G7_map_reduce_revenue", with_(*BASE, S.LINES_SQL, PARSE_SQL) + """
SELECT "key", round(sum(value), 2) AS total_revenue, count(*) AS trip_count,
       round(avg(value), 4) AS avg_fare, min(value) AS min_fare, max(value) AS max_fare
FROM pairs GROUP BY "key" """)
def g7(spark, d):
    r = G.reduce_pairs(io.parse_pairs(S.lines(spark, d)))
    return r.select("key", F.round("total_revenue", 2).alias("total_revenue"), "trip_count",
                    F.round("avg_fare", 4).alias("avg_fare"), "min_fare", "max_fare")


@register("S5_csv_sink_roundtrip", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, total_amount FROM clean""")
def s5(spark, d):
    from pyspark.sql import types as T
    p = _scratch(spark, "mr_input")
    io.write_csv(cleaned(spark, d).select("PU_Borough", "total_amount"), p)
    sch = T.StructType([T.StructField("PU_Borough", T.StringType()),
                        T.StructField("total_amount", T.DoubleType())])
    return spark.read.csv(p, schema=sch, header=False)


AUDIT6_SQL = f"""tagged AS (
  SELECT CASE WHEN NOT coalesce(total_amount IS NOT NULL, false) THEN 'null_amount'
              WHEN NOT coalesce(total_amount > 0, false) THEN 'non_positive_amount'
              WHEN NOT coalesce(total_amount <= 200, false) THEN 'extreme_amount'
              WHEN NOT coalesce(trip_distance > 0, false) THEN 'non_positive_distance'
              WHEN NOT coalesce(trip_distance <= 100, false) THEN 'extreme_distance'
              WHEN NOT coalesce(PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ}, false) THEN 'missing_PU_Borough'
              ELSE 'kept' END AS rule
  FROM trips_z),
rules(rule_order, rule) AS (VALUES (1, 'null_amount'), (2, 'non_positive_amount'), (3, 'extreme_amount'),
  (4, 'non_positive_distance'), (5, 'extreme_distance'), (6, 'missing_PU_Borough'), (7, 'kept')),
audit AS (
  SELECT CAST(r.rule_order AS INTEGER) AS rule_order, r.rule, CAST(count(t.rule) AS BIGINT) AS removed
  FROM rules r LEFT JOIN tagged t ON t.rule = r.rule GROUP BY r.rule_order, r.rule)"""


@register("S6_json_report_roundtrip", with_(*BASE, AUDIT6_SQL) + "SELECT rule_order, rule, removed FROM audit")
def s6(spark, d):
    from pyspark.sql import types as T
    p = _scratch(spark, "audit_json")
    io.write_report(Q.rule_audit(S.trips_zoned(spark, d), rules6()), p)
    sch = T.StructType([T.StructField("rule_order", T.IntegerType()), T.StructField("rule", T.StringType()),
                        T.StructField("removed", T.LongType())])
    return io.read_report(spark, p, sch)


@register("S7_drop_index_columns", "SELECT * FROM customer")
def s7(spark, d):
    c = S.table(spark, d, "customer").withColumn("Unnamed: 0", F.col("c_custkey") - 1)
    return P.drop_matching(c, r"^Unnamed")


@register("S8_bounded_fetch_after_agg", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, count(*) AS trip_count FROM clean GROUP BY PU_Borough ORDER BY trip_count DESC, PU_Borough LIMIT 3""")
def s8(spark, d):
    g = cleaned(spark, d).groupBy("PU_Borough").agg(F.count(F.lit(1)).alias("trip_count"))
    rows = io.small(g, 3, [F.desc("trip_count"), "PU_Borough"])
    return spark.createDataFrame(rows, "PU_Borough string, trip_count bigint")


@register("S9_labelled_text_split", """
SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label,
       CASE WHEN CAST(('0x' || substr(md5('42-' || CAST(d.doc_id AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0 < 0.2
            THEN 'test' ELSE 'train' END AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def s9(spark, d):
    return io.labelled_text(S.table(spark, d, "documents"), S.table(spark, d, "labels"))


@register("S10_lines_count", with_(*BASE, S.LINES_SQL) + "SELECT count(*) AS n_lines FROM lines")
def s10a(spark, d):
    return io.lines_count(S.lines(spark, d))


@register("S10_lines_containing_head", with_(*BASE, S.LINES_SQL) + """
SELECT value FROM lines WHERE contains(value, 'ASIA,1') ORDER BY value LIMIT 5""")
def s10b(spark, d):
    return io.lines_containing(S.lines(spark, d), "ASIA,1", 5, order_col="value")


@register("S10_distinct_first_field", with_(*BASE, S.LINES_SQL) + """
SELECT DISTINCT split_part(value, ',', 1) AS field FROM lines""")
def s10c(spark, d):
    return io.distinct_field(S.lines(spark, d), 0)


@register("S11_inspect_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def s11(spark, d):
    return io.inspect(S.table(spark, d, "lineitem"))


# ---------------------------------------------------------------- P: predicates


@register("P1_P2_project_rename", with_(S.TRIPS_SQL) + """
SELECT trip_id, PULocationID AS pickup_location, total_amount AS fare FROM trips""")
def p1(spark, d):
    t = S.trips(spark, d).select("trip_id", "PULocationID", "total_amount")
    return t.withColumnsRenamed({"PULocationID": "pickup_location", "total_amount": "fare"})


@register("P3_F11_derived_columns", with_(S.TRIPS_SQL) + """
SELECT trip_id, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
       total_amount / trip_distance AS fare_per_distance
FROM trips WHERE trip_distance > 0""")
def p3(spark, d):
    t = S.trips(spark, d).where(F.col("trip_distance") > 0)
    return t.select("trip_id", F.hour("pickup_ts").alias("pickup_hour"),
                    (F.col("total_amount") / F.col("trip_distance")).alias("fare_per_distance"))


@register("P4_P5_conjunctive_range_filter", with_(*BASE) + f"""
SELECT trip_id, PU_Borough, total_amount, trip_distance FROM trips_z
WHERE total_amount > 0 AND total_amount <= 200 AND trip_distance > 0 AND trip_distance <= 100
  AND PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ}""")
def p45(spark, d):
    t = S.trips_zoned(spark, d)
    a, dist = F.col("total_amount"), F.col("trip_distance")
    return t.where((a > 0) & (a <= 200) & (dist > 0) & (dist <= 100) & P.is_present("PU_Borough", SENT)) \
        .select("trip_id", "PU_Borough", "total_amount", "trip_distance")


@register("P6_null_test_unlabelled_docs", """
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""")
def p6(spark, d):
    j = S.table(spark, d, "documents").select("doc_id").join(S.table(spark, d, "labels"), "doc_id", "left")
    return j.where(F.col("quality").isNull()).select("doc_id")


@register("P7_is_present_flags", with_(S.ZONES_PU_SQL) + f"""
SELECT LocationID, Borough, (Borough IS NOT NULL AND Borough NOT IN {SQ}) AS present FROM zones_pu""")
def p7(spark, d):
    z = S.zones_pickup(spark, d)
    return z.select("LocationID", "Borough", P.is_present("Borough", SENT).alias("present"))


@register("P8_any_sentinel_rows", with_(*BASE) + f"""
SELECT trip_id, PU_Borough FROM trips_z WHERE PU_Borough IN {SQ}""")
def p8(spark, d):
    return S.trips_zoned(spark, d).where(P.any_sentinel("PU_Borough", SENT)).select("trip_id", "PU_Borough")


@register("P9_drop_incomplete_rows", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""")
def p9(spark, d):
    j = S.table(spark, d, "documents").select("doc_id", "lang").join(S.table(spark, d, "labels"), "doc_id", "left")
    return j.na.drop()


FARE_EDGES = [0, 20, 40, 60, 80, 100, 150, 200]
FARE_LABELS = ["0-20", "20-40", "40-60", "60-80", "80-100", "100-150", "150-200"]


@register("P10_bucketize_counts", with_(S.TRIPS_SQL) + """
SELECT CASE WHEN total_amount >= 0 AND total_amount < 20 THEN '0-20'
            WHEN total_amount >= 20 AND total_amount < 40 THEN '20-40'
            WHEN total_amount >= 40 AND total_amount < 60 THEN '40-60'
            WHEN total_amount >= 60 AND total_amount < 80 THEN '60-80'
            WHEN total_amount >= 80 AND total_amount < 100 THEN '80-100'
            WHEN total_amount >= 100 AND total_amount < 150 THEN '100-150'
            WHEN total_amount >= 150 AND total_amount < 200 THEN '150-200'
            ELSE 'other' END AS fare_bucket, count(*) AS n
FROM trips GROUP BY fare_bucket""")
def p10(spark, d):
    t = S.trips(spark, d).select(P.bucketize("total_amount", FARE_EDGES, FARE_LABELS).alias("fare_bucket"))
    return t.groupBy("fare_bucket").agg(F.count(F.lit(1)).alias("n"))


def _tod_sql(first):
    return f"""CASE WHEN hour(pickup_ts) >= {first} AND hour(pickup_ts) < 12 THEN 'morning'
            WHEN hour(pickup_ts) >= 12 AND hour(pickup_ts) < 17 THEN 'afternoon'
            WHEN hour(pickup_ts) >= 17 AND hour(pickup_ts) < 22 THEN 'evening' ELSE 'night' END"""


@register("P11_time_of_day_5_12_17_22", with_(S.TRIPS_SQL) + f"""
SELECT {_tod_sql(5)} AS time_bucket, count(*) AS n FROM trips GROUP BY time_bucket""")
def p11(spark, d):
    t = S.trips(spark, d).select(P.time_bucket("pickup_ts", P.BASKET_HOURS).alias("time_bucket"))
    return t.groupBy("time_bucket").agg(F.count(F.lit(1)).alias("n"))


@register("P12_time_of_day_6_12_17_22", with_(S.TRIPS_SQL) + f"""
SELECT {_tod_sql(6)} AS time_of_day, count(*) AS n FROM trips GROUP BY time_of_day""")
def p12(spark, d):
    t = S.trips(spark, d).select(P.time_bucket("pickup_ts", P.SEGMENT_HOURS).alias("time_of_day"))
    return t.groupBy("time_of_day").agg(F.count(F.lit(1)).alias("n"))


@register("P13_recode_binarise", """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                            WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END AS priority_code,
       CAST(o_orderstatus = 'F' AS INTEGER) AS is_final
FROM orders WHERE o_orderstatus <> 'P'""")
def p13(spark, d):
    o = S.table(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    m = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
    return o.select("o_orderkey", P.recode("o_orderpriority", m).alias("priority_code"),
                    P.binarise("o_orderstatus", "F").alias("is_final"))


@register("P14_columns_by_type", """
SELECT column_name, CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' ELSE 'categorical' END AS kind, n AS n_values
FROM information_schema.columns
JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM lineitem) ON COLUMNS(*) INTO NAME name VALUE n) ON name = column_name
WHERE table_name = 'lineitem' AND data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'VARCHAR')""")
def p14(spark, d):
    li = S.table(spark, d, "lineitem")
    kinds = [(c, "numeric") for c in P.numeric_cols(li)] + [(c, "categorical") for c in P.categorical_cols(li)]
    n = li.agg(*[F.count(c).alias(c) for c, _ in kinds])
    return n.selectExpr(f"stack({len(kinds)}, " + ", ".join(f"'{c}', '{k}', {c}" for c, k in kinds) + ") as (column_name, kind, n_values)")


@register("P15_align_columns", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
UNION ALL
SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal < 0""")
def p15(spark, d):
    c = S.table(spark, d, "customer")
    real = c.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    synth = c.where(F.col("c_acctbal") < 0).select("c_acctbal", "c_custkey", "c_nationkey", "c_name")
    a, b = P.align(real, synth)
    a, b = a.drop("c_mktsegment", "c_name"), b.drop("c_mktsegment", "c_name")
    return a.unionByName(b)


# ---------------------------------------------------------------- Q: data quality


@register("Q1_clean_audit_6_rules", with_(*BASE, AUDIT6_SQL) + "SELECT rule_order, rule, removed FROM audit")
def q1(spark, d):
    return Q.rule_audit(S.trips_zoned(spark, d), rules6())


@register("Q1_audit_increments_merged", with_(*BASE, AUDIT6_SQL) + "SELECT rule_order, rule, removed FROM audit")
def q1_increments(spark, d):
    """The audit of all trips from the stored audits of three increments."""
    folder, t = _scratch(spark, "audit_parts"), S.trips_zoned(spark, d)
    for m in range(3):
        I.store_part(I.audit_part(t.where(F.pmod(F.xxhash64("trip_id"), F.lit(3)) == m), rules6()), folder, f"m{m}")
    return I.merge_audits(I.stored_parts(spark, folder)).select("rule_order", "rule", "removed")


@register("Q2_clean_audit_8_rules", with_(*BASE, f"""tagged AS (
  SELECT CASE WHEN NOT coalesce(total_amount IS NOT NULL, false) THEN 'null_amount'
              WHEN NOT coalesce(total_amount > 0, false) THEN 'non_positive_amount'
              WHEN NOT coalesce(total_amount <= 200, false) THEN 'extreme_amount'
              WHEN NOT coalesce(trip_distance > 0, false) THEN 'non_positive_distance'
              WHEN NOT coalesce(trip_distance <= 100, false) THEN 'extreme_distance'
              WHEN NOT coalesce(passenger_count > 0, false) THEN 'non_positive_passengers'
              WHEN NOT coalesce(passenger_count <= 9, false) THEN 'excess_passengers'
              WHEN NOT coalesce(PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ}, false) THEN 'missing_PU_Borough'
              ELSE 'kept' END AS rule
  FROM trips_z)""", """rules(rule_order, rule) AS (VALUES (1, 'null_amount'), (2, 'non_positive_amount'),
  (3, 'extreme_amount'), (4, 'non_positive_distance'), (5, 'extreme_distance'), (6, 'non_positive_passengers'),
  (7, 'excess_passengers'), (8, 'missing_PU_Borough'), (9, 'kept'))""") + """
SELECT CAST(r.rule_order AS INTEGER) AS rule_order, r.rule, CAST(count(t.rule) AS BIGINT) AS removed
FROM rules r LEFT JOIN tagged t ON t.rule = r.rule GROUP BY r.rule_order, r.rule""")
def q2(spark, d):
    return Q.rule_audit(S.trips_zoned(spark, d), rules8())


BOTH = (S.TRIPS_SQL, S.TRIPS_DO_SQL, S.ZONES_PU_SQL, S.ZONES_DO_SQL, S.TRIPS_BOTH_SQL)


@register("Q3_clean_audit_both_ends", with_(*BOTH, f"""tagged AS (
  SELECT CASE WHEN NOT coalesce(total_amount IS NOT NULL, false) THEN 'null_amount'
              WHEN NOT coalesce(total_amount > 0, false) THEN 'non_positive_amount'
              WHEN NOT coalesce(total_amount <= 200, false) THEN 'extreme_amount'
              WHEN NOT coalesce(trip_distance > 0, false) THEN 'non_positive_distance'
              WHEN NOT coalesce(trip_distance <= 100, false) THEN 'extreme_distance'
              WHEN NOT coalesce(PU_Borough IS NOT NULL AND PU_Borough NOT IN {SQ}, false) THEN 'missing_PU_Borough'
              WHEN NOT coalesce(DO_Borough IS NOT NULL AND DO_Borough NOT IN {SQ}, false) THEN 'missing_DO_Borough'
              WHEN NOT coalesce(passenger_count > 0, false) THEN 'non_positive_passengers'
              ELSE 'kept' END AS rule
  FROM trips_b)""", """rules(rule_order, rule) AS (VALUES (1, 'null_amount'), (2, 'non_positive_amount'),
  (3, 'extreme_amount'), (4, 'non_positive_distance'), (5, 'extreme_distance'), (6, 'missing_PU_Borough'),
  (7, 'missing_DO_Borough'), (8, 'non_positive_passengers'), (9, 'kept'))""") + """
SELECT CAST(r.rule_order AS INTEGER) AS rule_order, r.rule, CAST(count(t.rule) AS BIGINT) AS removed
FROM rules r LEFT JOIN tagged t ON t.rule = r.rule GROUP BY r.rule_order, r.rule""")
def q3(spark, d):
    return Q.rule_audit(S.trips_both_ends(spark, d), rules_both())


@register("Q4_retention_summary", with_(*BASE, AUDIT6_SQL) + """
SELECT CAST(sum(removed) AS BIGINT) AS original, CAST(sum(removed) FILTER (WHERE rule = 'kept') AS BIGINT) AS final,
       CAST(sum(removed) FILTER (WHERE rule <> 'kept') AS BIGINT) AS removed,
       round(sum(removed) FILTER (WHERE rule <> 'kept') * 100.0 / sum(removed), 2) AS removal_pct,
       round(sum(removed) FILTER (WHERE rule = 'kept') * 100.0 / sum(removed), 2) AS retention_pct
FROM audit""")
def q4(spark, d):
    return Q.retention(Q.rule_audit(S.trips_zoned(spark, d), rules6()))


@register("Q5_removal_breakdown", with_(*BASE, AUDIT6_SQL) + """
SELECT rule_order, rule, removed, round(removed * 100.0 / (SELECT sum(removed) FROM audit), 2) AS pct_of_original
FROM audit WHERE rule <> 'kept'""")
def q5(spark, d):
    return Q.removal_breakdown(Q.rule_audit(S.trips_zoned(spark, d), rules6()))


@register("Q6_validation_checks", with_(*BASE, CLEAN6_SQL, """v AS (
  SELECT count(*) FILTER (WHERE PU_Borough IS NULL) AS c1, count(*) FILTER (WHERE total_amount IS NULL) AS c2,
         count(*) FILTER (WHERE total_amount <= 0) AS c3, count(*) FILTER (WHERE total_amount = 0) AS c4,
         count(*) FILTER (WHERE total_amount > 200) AS c5,
         count(*) FILTER (WHERE PU_Borough IN ('Unknown', 'N/A', '')) AS c6,
         count(*) FILTER (WHERE trip_distance > 100) AS c7 FROM clean)""", """l AS (
  SELECT 1 AS check_order, 'null_borough' AS check_name, c1 AS violations FROM v UNION ALL
  SELECT 2, 'null_amount', c2 FROM v UNION ALL SELECT 3, 'non_positive_amount', c3 FROM v UNION ALL
  SELECT 4, 'zero_amount', c4 FROM v UNION ALL SELECT 5, 'extreme_amount', c5 FROM v UNION ALL
  SELECT 6, 'unknown_borough', c6 FROM v UNION ALL SELECT 7, 'extreme_distance', c7 FROM v)""") + """
SELECT CAST(check_order AS INTEGER) AS check_order, check_name, CAST(violations AS BIGINT) AS violations,
       CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       (SELECT max(violations) FROM l) = 0 AS all_passed
FROM l""")
def q6(spark, d):
    c = cleaned(spark, d)
    b, a, dist = F.col("PU_Borough"), F.col("total_amount"), F.col("trip_distance")
    checks = [("null_borough", b.isNull()), ("null_amount", a.isNull()), ("non_positive_amount", a <= 0),
              ("zero_amount", a == 0), ("extreme_amount", a > 200),
              ("unknown_borough", b.isin("Unknown", "N/A", "")), ("extreme_distance", dist > 100)]
    return Q.validate(c, checks)


@register("Q7_missing_value_report", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id IS NULL) AS m0, count(*) FILTER (WHERE lang IS NULL) AS m1,
             count(*) FILTER (WHERE quality IS NULL) AS m2, count(*) FILTER (WHERE toxic IS NULL) AS m3 FROM j)
SELECT 'doc_id' AS column_name, CAST(m0 AS BIGINT) AS n_missing, round(m0 * 100.0 / n, 2) AS pct_missing FROM n UNION ALL
SELECT 'lang', CAST(m1 AS BIGINT), round(m1 * 100.0 / n, 2) FROM n UNION ALL
SELECT 'quality', CAST(m2 AS BIGINT), round(m2 * 100.0 / n, 2) FROM n UNION ALL
SELECT 'toxic', CAST(m3 AS BIGINT), round(m3 * 100.0 / n, 2) FROM n""")
def q7(spark, d):
    j = S.table(spark, d, "documents").select("doc_id", "lang").join(S.table(spark, d, "labels"), "doc_id", "left")
    return Q.missing(j, ["doc_id", "lang", "quality", "toxic"])


@register("Q8_class_balance", """
WITH g AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT quality, n, round(n * 100.0 / (SELECT sum(n) FROM g), 2) AS pct,
       round((SELECT max(n) FROM g) * 1.0 / (SELECT min(n) FROM g), 2) AS imbalance_ratio,
       (SELECT max(n) FROM g) * 1.0 / (SELECT min(n) FROM g) > 2.0 AS imbalanced
FROM g""")
def q8(spark, d):
    return Q.class_balance(S.table(spark, d, "labels"), "quality")


@register("Q10_infer_metadata", """
SELECT column_name, dtype, sdtype FROM (VALUES
  ('c_custkey', 'bigint', CASE WHEN (SELECT count(DISTINCT c_custkey) = count(*) FROM customer) THEN 'id' ELSE 'numerical' END),
  ('c_name', 'string', 'categorical'), ('c_nationkey', 'int', CASE WHEN (SELECT count(DISTINCT c_nationkey) = count(*) FROM customer) THEN 'id' ELSE 'numerical' END),
  ('c_acctbal', 'double', 'numerical'), ('c_mktsegment', 'string', 'categorical')) t(column_name, dtype, sdtype)""")
def q10(spark, d):
    return Q.infer_metadata(S.table(spark, d, "customer"))


@register("Q11_join_rows_preserved", with_(*BASE) + """
SELECT (SELECT count(*) FROM trips) AS before_count, (SELECT count(*) FROM trips_z) AS after_count,
       (SELECT count(*) FROM trips) = (SELECT count(*) FROM trips_z) AS preserved""")
def q11(spark, d):
    return Q.rows_preserved(S.trips(spark, d), S.trips_zoned(spark, d))


@register("Q11_dimension_key_unique", with_(S.ZONES_PU_SQL) + """
SELECT count(*) AS n_rows, count(DISTINCT LocationID) AS n_keys, count(*) = count(DISTINCT LocationID) AS "unique"
FROM zones_pu""")
def q11b(spark, d):
    return Q.unique_key(S.zones_pickup(spark, d), "LocationID")


# ---------------------------------------------------------------- J: joins


@register("J1_left_join_different_keys", with_(S.TRIPS_SQL, S.ZONES_PU_SQL) + """
SELECT t.trip_id, t.PULocationID, z.LocationID, z.Borough FROM trips t LEFT JOIN zones_pu z ON t.PULocationID = z.LocationID""")
def j1(spark, d):
    from quarry.operators.joins import sized_broadcast
    t, z = S.trips(spark, d), S.zones_pickup(spark, d)
    j = t.join(sized_broadcast(z), t.PULocationID == z.LocationID, "left")
    return j.select(t.trip_id, t.PULocationID, z.LocationID, z.Borough)


@register("J1_left_join_heavy_key", with_(S.TRIPS_SQL, S.ZONES_PU_SQL, """hot AS (
  SELECT trip_id, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE PULocationID END AS LocationID FROM trips)""") + """
SELECT h.trip_id, h.LocationID, z.Borough FROM hot h LEFT JOIN zones_pu z ON h.LocationID = z.LocationID""")
def j1_heavy(spark, d):
    """J1 where one key holds half of all rows and the dimension is joined by shuffle."""
    from quarry.operators.joins import join_heavy
    t = S.trips(spark, d).select("trip_id", "l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, F.lit(1)).otherwise(F.col("PULocationID")).cast("bigint").alias("LocationID"))
    z = S.zones_pickup(spark, d).select(F.col("LocationID").cast("bigint"), "Borough")
    return join_heavy(t, z, "LocationID", ["trip_id"]).select("trip_id", "LocationID", "Borough")


@register("J2_enrich_dimension", with_(*BASE) + "SELECT trip_id, PULocationID, PU_Borough, Zone FROM trips_z")
def j2(spark, d):
    return S.trips_zoned(spark, d).select("trip_id", "PULocationID", "PU_Borough", "Zone")


@register("J3_role_playing_dimension", with_(*BOTH) + """
SELECT trip_id, PU_Borough, pickup_zone, DO_Borough, dropoff_zone FROM trips_b""")
def j3(spark, d):
    return S.trips_both_ends(spark, d).select("trip_id", "PU_Borough", "pickup_zone", "DO_Borough", "dropoff_zone")


@register("J6_join_filter_aggregate_sort", with_(S.TRIPS_SQL, S.ZONES_PU_SQL) + f"""
SELECT z.Borough AS PU_Borough, count(*) AS trip_count, round(sum(t.total_amount), 2) AS revenue
FROM trips t JOIN zones_pu z ON t.PULocationID = z.LocationID
WHERE t.total_amount > 0 AND t.total_amount <= 200 AND t.trip_distance > 0 AND t.trip_distance <= 100
  AND z.Borough NOT IN {SQ}
GROUP BY z.Borough ORDER BY revenue DESC""")
def j6(spark, d):
    t = enrich(S.trips(spark, d), S.zones_pickup(spark, d), "PULocationID", "LocationID",
               {"Borough": "PU_Borough"}, how="inner")
    a, dist = F.col("total_amount"), F.col("trip_distance")
    f = t.where((a > 0) & (a <= 200) & (dist > 0) & (dist <= 100) & P.is_present("PU_Borough", SENT))
    return (f.groupBy("PU_Borough").agg(F.count(F.lit(1)).alias("trip_count"),
                                        F.round(F.sum("total_amount"), 2).alias("revenue"))
            .orderBy(F.desc("revenue")))


@register("J8_semi_join_membership", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def j8(spark, d):
    o = S.table(spark, d, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")) \
        .select(F.col("o_custkey").alias("c_custkey"))
    return members(S.table(spark, d, "customer").select("c_custkey", "c_name"), o, ["c_custkey"])


@register("J8_semi_join_behind_bloom_filter", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def j8b(spark, d):
    o = S.table(spark, d, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")) \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    return members_filtered(S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), o, ["l_orderkey"])


# ---------------------------------------------------------------- G: aggregates over trips


@register("G1_row_count", with_(*BASE, CLEAN6_SQL) + "SELECT count(*) AS n FROM clean")
def g1(spark, d):
    return cleaned(spark, d).agg(F.count(F.lit(1)).alias("n"))


@register("G2_global_avg_min_max", with_(*BASE, CLEAN6_SQL) + """
SELECT round(avg(total_amount), 4) AS avg_amount, min(total_amount) AS min_amount, max(total_amount) AS max_amount,
       round(avg(trip_distance), 4) AS avg_distance, min(trip_distance) AS min_distance, max(trip_distance) AS max_distance
FROM clean""")
def g2(spark, d):
    return cleaned(spark, d).agg(
        F.round(F.avg("total_amount"), 4).alias("avg_amount"), F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount"), F.round(F.avg("trip_distance"), 4).alias("avg_distance"),
        F.min("trip_distance").alias("min_distance"), F.max("trip_distance").alias("max_distance"))


@register("G3_K1_group_count_top10", with_(*BASE, CLEAN6_SQL) + """
SELECT Zone, PU_Borough, count(*) AS "count" FROM clean GROUP BY Zone, PU_Borough ORDER BY "count" DESC, Zone LIMIT 10""")
def g3(spark, d):
    return G.top_k(cleaned(spark, d).groupBy("Zone", "PU_Borough").count(), [F.desc("count"), "Zone"], 10)


@register("G5_group_count_avg_share", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, count(*) AS trip_count, round(avg(total_amount), 4) AS avg_value,
       round(count(*) * 100.0 / (SELECT count(*) FROM clean), 2) AS pct_of_total
FROM clean GROUP BY PU_Borough""")
def g5(spark, d):
    g = G.group_share(cleaned(spark, d), ["PU_Borough"], "total_amount")
    return g.withColumn("avg_value", F.round("avg_value", 4))


@register("G6_reduce_pairs_sorted", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough AS "key", round(sum(total_amount), 2) AS total_revenue, count(*) AS trip_count,
       round(avg(total_amount), 4) AS avg_fare, min(total_amount) AS min_fare, max(total_amount) AS max_fare
FROM clean GROUP BY PU_Borough""")
def g6(spark, d):
    pairs = cleaned(spark, d).select(F.col("PU_Borough").alias("key"), F.col("total_amount").alias("value"))
    r = G.reduce_pairs(pairs)
    return r.select("key", F.round("total_revenue", 2).alias("total_revenue"), "trip_count",
                    F.round("avg_fare", 4).alias("avg_fare"), "min_fare", "max_fare")


@register("G8_Q9_group_profile_percentiles", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, count(*) AS n, round(avg(total_amount), 4) AS avg_value, min(total_amount) AS min_value,
       max(total_amount) AS max_value,
       quantile_disc(total_amount, 0.25) AS q1_value, quantile_disc(total_amount, 0.5) AS median_value,
       quantile_disc(total_amount, 0.75) AS q3_value, quantile_disc(total_amount, 0.9) AS p90_value,
       quantile_disc(total_amount, 0.95) AS p95_value, quantile_disc(total_amount, 0.99) AS p99_value,
       count(*) < 100 AS small_sample
FROM clean GROUP BY PU_Borough""")
def g8(spark, d):
    g = G.group_profile(cleaned(spark, d), "PU_Borough", "total_amount", exact=True)
    return g.withColumn("avg_value", F.round("avg_value", 4))


FOCUS_SQL = f"focus AS (SELECT * FROM clean WHERE PU_Borough = '{S.FOCUS_BOROUGH}')"


def focus(spark, d):
    return cleaned(spark, d).where(F.col("PU_Borough") == S.FOCUS_BOROUGH)


@register("G9_bucket_share", with_(*BASE, CLEAN6_SQL, FOCUS_SQL, """b(bucket_order, bucket, lo, hi) AS (VALUES
  (1, '0-20', 0.0, 20.0), (2, '20-40', 20.0, 40.0), (3, '40-60', 40.0, 60.0), (4, '60-80', 60.0, 80.0),
  (5, '80-100', 80.0, 100.0), (6, '100-150', 100.0, 150.0), (7, '150-200', 150.0, 200.0), (8, 'other', NULL, NULL))""") + """
SELECT CAST(b.bucket_order AS INTEGER) AS bucket_order, b.bucket, CAST(b.lo AS DOUBLE) AS lo, CAST(b.hi AS DOUBLE) AS hi,
       CAST((SELECT count(*) FROM focus f WHERE (b.lo IS NOT NULL AND f.total_amount >= b.lo AND f.total_amount < b.hi)
              OR (b.lo IS NULL AND NOT (f.total_amount >= 0 AND f.total_amount < 200))) AS BIGINT) AS n,
       round((SELECT count(*) FROM focus f WHERE (b.lo IS NOT NULL AND f.total_amount >= b.lo AND f.total_amount < b.hi)
              OR (b.lo IS NULL AND NOT (f.total_amount >= 0 AND f.total_amount < 200))) * 100.0 / (SELECT count(*) FROM focus), 2) AS pct
FROM b""")
def g9(spark, d):
    return G.bucket_share(focus(spark, d), "total_amount", FARE_EDGES, FARE_LABELS)


@register("G10_tail_share_over_80", with_(*BASE, CLEAN6_SQL, FOCUS_SQL) + """
SELECT count(*) AS n, count(*) FILTER (WHERE total_amount > 80) AS n_over,
       round(count(*) FILTER (WHERE total_amount > 80) * 100.0 / count(*), 4) AS pct_over,
       round(avg(total_amount) FILTER (WHERE total_amount > 80) - 20.0, 4) AS lift_over_base
FROM focus""")
def g10(spark, d):
    return G.tail_share(focus(spark, d), "total_amount", 80.0, 20.0)


@register("G11_having_top_groups", with_(*BASE, CLEAN6_SQL, FOCUS_SQL) + """
SELECT PULocationID, count(*) AS trip_count, round(avg(total_amount), 4) AS avg_value, max(total_amount) AS max_value
FROM focus GROUP BY PULocationID HAVING count(*) > 10 ORDER BY avg(total_amount) DESC, PULocationID LIMIT 10""")
def g11(spark, d):
    r = G.top_groups(focus(spark, d), "PULocationID", "total_amount", 10, 10)
    return r.withColumn("avg_value", F.round("avg_value", 4))


CAPS = [50, 60, 70, 80, 90, 100, 150, 200]


@register("G12_cap_impact_sweep", with_(*BASE, CLEAN6_SQL, FOCUS_SQL,
          "caps(cap) AS (VALUES (50.0), (60.0), (70.0), (80.0), (90.0), (100.0), (150.0), (200.0))") + """
SELECT CAST(c.cap AS DOUBLE) AS cap, round(avg(f.total_amount), 4) AS avg_value, CAST(count(f.total_amount) AS BIGINT) AS kept,
       round(count(f.total_amount) * 100.0 / (SELECT count(*) FROM focus), 4) AS pct_kept
FROM caps c LEFT JOIN focus f ON f.total_amount <= c.cap GROUP BY c.cap""")
def g12(spark, d):
    return G.cap_impact(focus(spark, d), "total_amount", CAPS)


@register("G13_cap_strategies", with_(*BASE, CLEAN6_SQL, FOCUS_SQL, "caps(cap) AS (VALUES (80.0), (70.0))") + """
SELECT CAST(c.cap AS DOUBLE) AS cap, round(avg(f.total_amount), 4) AS avg_value, CAST(count(f.total_amount) AS BIGINT) AS kept,
       CAST((SELECT count(*) FROM focus) - count(f.total_amount) AS BIGINT) AS removed,
       round(count(f.total_amount) * 100.0 / (SELECT count(*) FROM focus), 4) AS pct_kept,
       round(((SELECT count(*) FROM focus) - count(f.total_amount)) * 100.0 / (SELECT count(*) FROM focus), 4) AS pct_removed
FROM caps c LEFT JOIN focus f ON f.total_amount <= c.cap GROUP BY c.cap""")
def g13(spark, d):
    return G.cap_strategies(focus(spark, d), "total_amount", [80.0, 70.0])


GROUP_CAPS = {"AMERICA": 100.0, "ASIA": 80.0, "EUROPE": 100.0, "AFRICA": 150.0}


@register("G14_group_specific_caps", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, count(*) AS n, round(avg(total_amount), 4) AS avg_amount FROM clean
WHERE total_amount <= CASE PU_Borough WHEN 'AMERICA' THEN 100.0 WHEN 'ASIA' THEN 80.0 WHEN 'EUROPE' THEN 100.0
                                      WHEN 'AFRICA' THEN 150.0 ELSE 200.0 END
GROUP BY PU_Borough""")
def g14(spark, d):
    c = G.clean_by_group_caps(cleaned(spark, d), "PU_Borough", "total_amount", GROUP_CAPS, default=200.0)
    return c.groupBy("PU_Borough").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("total_amount"), 4).alias("avg_amount"))


@register("Q1_S5_clean_export_with_observed_audit", with_(*BASE, AUDIT6_SQL) + "SELECT rule_order, rule, removed FROM audit")
def q1_observed(spark, d):
    """E1 in one job: the cleaned (borough, amount) CSV export and the per-rule
    audit come from the same scan (observed metrics of the writing job)."""
    from pyspark.sql import Observation
    rules = rules6()
    obs = Observation("clean_audit")
    # observed jobs run in a sibling session (same SparkContext): in Spark 4.1
    # a session that has used an Observation can no longer serialize ML
    # classification summaries, which would break later model training.
    side = spark.newSession()
    clean_rows = Q.clean(S.trips_zoned(side, d), rules, observation=obs)
    io.write_csv(clean_rows.select("PU_Borough", "total_amount"), _scratch(side, "mr_input_observed"))
    m = obs.get
    removed = [(i + 1, r.name, int(m[r.name])) for i, r in enumerate(rules)]
    kept = int(m["original"]) - sum(x[2] for x in removed)
    return spark.createDataFrame(removed + [(len(rules) + 1, "kept", kept)],
                                 "rule_order int, rule string, removed bigint")


@register("G6_G7_export_then_map_reduce", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough AS "key", round(sum(total_amount), 2) AS total_revenue, count(*) AS trip_count,
       round(avg(total_amount), 4) AS avg_fare, min(total_amount) AS min_fare, max(total_amount) AS max_fare
FROM clean GROUP BY PU_Borough""")
def g6g7(spark, d):
    """The reference's trip flow end to end: cleaned (borough, amount) rows are
    exported as headerless CSV, the exported text is read back, parsed
    tolerantly and reduced per borough (one shuffle: partial + final aggregate)."""
    p = _scratch(spark, "export_for_reduce")
    io.write_csv(cleaned(spark, d).select("PU_Borough", "total_amount"), p)
    pairs = io.parse_pairs(spark.read.text(p))
    r = G.reduce_pairs(pairs)
    return r.select("key", F.round("total_revenue", 2).alias("total_revenue"), "trip_count",
                    F.round("avg_fare", 4).alias("avg_fare"), "min_fare", "max_fare")


@register("G8_group_profile_approx", note="percentile_approx at Spark's default accuracy (the reference's form); rows-only")
def g8_approx(spark, d):
    g = G.group_profile(cleaned(spark, d), "PU_Borough", "total_amount")
    return g.withColumn("avg_value", F.round("avg_value", 4))
