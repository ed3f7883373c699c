import os

import duckdb
import pytest

import __spark_entry__ as E
from zonecast.plans import catalog

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 40


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0


@needs_data
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["zone_id", "hour", "demand"] and df.count() > 0


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    con = duck
    sdf = E.queries()[name](spark, SF)
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def cell(v):
        if v is None:
            return "<null>"
        if isinstance(v, float):
            return f"{round(v, 6):.6f}"
        return str(v)

    def norm(rows, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted("|".join(cell(r[i]) for i in order) for r in rows)
    assert norm([tuple(r) for r in sdf.collect()], sdf.columns) == norm(cur.fetchall(), dcols)
