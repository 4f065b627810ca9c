"""Files of differing schemas, rejected rows with their reasons, and increments."""
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import aggregate as G
from quarry.operators import increments as I
from quarry.sources import io
from quarry.sources import tolerant as TS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "double", "double"), ("int", "float", "double"),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(10,5)", "double"),
    ("decimal(5,1)", "double", "double"), ("date", "timestamp", "timestamp"), ("string", "int", "string"), ("boolean", "int", "string"),
    ("void", "int", "int"), ("array<int>", "array<bigint>", "array<bigint>")])
def test_wider_type(spark, a, b, want):
    x, y = (T._parse_datatype_string(t) if t != "void" else T.NullType() for t in (a, b))
    for got in (TS.wider_type(x, y), TS.wider_type(y, x)):
        assert got.simpleString() == want


def test_files_of_differing_schemas(spark, tmp_path):
    parts = [spark.createDataFrame([(1, 5, "a")], "id int, fee int, zone string"), spark.createDataFrame([(2 ** 40, 0.5)], "id bigint, FEE double"),
             spark.createDataFrame([(3, decimal.Decimal("7.25"), 1.0)], "id int, fee decimal(6,2), `late fee` double"), spark.createDataFrame([(4, 6, "b")], "id int, fee int, zone string")]
    paths = []
    for i, p in enumerate(parts):
        paths.append(f"{tmp_path}/m{i}")
        p.write.parquet(paths[-1])
    got = TS.read_widened(spark, paths, "file")
    assert got.drop("file").dtypes == [("id", "bigint"), ("fee", "double"), ("zone", "string"), ("late fee", "double")]
    assert rows(got.drop("file")) == sorted([(1, 5.0, "a", None), (2 ** 40, 0.5, None, None), (3, 7.25, None, 1.0), (4, 6.0, "b", None)], key=repr)
    assert {(r["id"], r["file"].split("/")[-2]) for r in got.collect()} == {(1, "m0"), (2 ** 40, "m1"), (3, "m2"), (4, "m3")}
    plan = TS.read_widened(spark, paths).where("zone = 'a'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(zone,a)" in plan and "fee" not in plan.replace("late fee", "")  # pruned, pushed down
    with pytest.raises(ValueError):
        TS.read_widened(spark, [])


LINES = [None, "", "a", "a,1", " ,2 ", "b,x", "b,-1", "b,0", "c,nan", "c,inf", "c,1e3,rest", "key,amount", "d,12.5d", "a,1"]


@pytest.mark.parametrize("options", [dict(), dict(default_key=None, skip_prefixes=("key",)), dict(strip=False)])
def test_checked_lines_are_the_kept_and_the_rejected(spark, options):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = TS.parse_pairs_checked(df, **options)
    assert rows(got.where("reason IS NULL").select("key", "value")) == rows(io.parse_pairs(df, **options))
    assert rows(got.select("line")) == sorted(((x,) for x in LINES), key=repr)
    assert sum(r["n"] for r in TS.rejected_counts(got).collect()) == len(LINES)
    why = {r["line"]: r["reason"] for r in got.collect()}
    assert why[None] == "null_line" and why["a"] == "too_few_fields" and why["b,x"] == why["c,nan"] == why["d,12.5d"] == "not_a_number" and why["b,0"] == "not_positive"
    assert why["key,amount"] == ("header" if options.get("skip_prefixes") else "not_a_number")


def test_checked_csv_records(spark, tmp_path):
    p = tmp_path / "z.csv"
    p.write_text('LocationID,Borough,fare\n1,"a, b",2.5\n2,b\n3,c,4,5\nx,d,1\n5,e,cheap\n,f,\n 7 ,g,1e2\n')
    schema = T.StructType([T.StructField("LocationID", T.IntegerType()), T.StructField("Borough", T.StringType()), T.StructField("fare", T.DoubleType())])
    c = TS.read_csv_checked(spark, str(p), schema)
    assert rows(c.where("reason IS NULL").drop("reason", "record")) == sorted([(1, "a, b", 2.5), (None, "f", None), (7, "g", 100.0)], key=repr)
    assert rows(c.where("reason IS NOT NULL").select("reason", "record")) == sorted([("field_count", "2,b"), ("field_count", "3,c,4,5"), ("bad_LocationID", "x,d,1"), ("bad_fare", "5,e,cheap")])
    kept, rejected = TS.write_checked(c, str(tmp_path / "out"))
    assert kept.count() == 3 and rows(rejected.select("reason", "record")) == rows(c.where("reason IS NOT NULL").select("reason", "record"))
    assert rejected.select("LocationID", "Borough", "fare").distinct().collect() == [(None, None, None)]


def test_increments_equal_the_batch_and_a_part_counts_once(spark, tmp_path):
    months = [[("a", 1.0), ("b", 2.0), (None, 4.0)], [("a", 5.0), ("a", None)], [("c", 0.5)]]
    frames = [spark.createDataFrame(m, "key string, value double") for m in months]
    for name in (0, 1, 2, 1):
        I.store_part(I.pair_part(frames[name]), str(tmp_path), f"m{name}")
    got = I.merge_pairs(I.stored_parts(spark, str(tmp_path)))
    assert rows(got) == rows(G.reduce_pairs(frames[0].unionByName(frames[1]).unionByName(frames[2])))
    I.store_part(I.pair_part(frames[2].limit(0)), str(tmp_path), "m0")
    assert {r["key"] for r in I.merge_pairs(I.stored_parts(spark, str(tmp_path))).collect()} == {"a", "c"}
