"""Every registered query against its DuckDB oracle on the smallest test tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cohesion.plans import catalog

SF = os.environ.get("COHESION_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if type(v).__name__ == "date":
        return v.isoformat()
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(got, df.columns) == _rows(res.fetchall(), ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "submitter_participant_id" in df.columns
