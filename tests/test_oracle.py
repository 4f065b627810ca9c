"""Every SQL-backed registered query equals its DuckDB oracle (sf0.001)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import digest, spark_type_name

SQL = E.oracle_sql()
NAMES = sorted(SQL)


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert set(SQL) <= set(qs)
    df = E.entry(spark)
    assert df.columns == ["Zone", "PU_Borough", "trip_count", "total_fare", "avg_fare"]
    assert df.count() <= 10


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    dcols = [c[0] for c in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    rel = duck.sql(SQL[name])
    dtypes = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields} == dtypes
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows, 6)[0] == digest(dcols, drows, 6)[0]
