"""Every registered query against its DuckDB oracle on the smallest scale (the driver's gate
runs the same comparison at sf0.01)."""

import math
from collections import Counter

import duckdb
import pytest

from ledgerline.plans import oracle_sql, queries

from conftest import SF_SMALL

SPARK_TO_DUCKDB = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR", "DoubleType": "DOUBLE",
                   "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "BinaryType": "BLOB"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        return
    rel = con.sql(sql)
    types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCKDB.get(type(f.dataType).__name__, type(f.dataType).__name__)
                   for f in df.schema.fields}
    assert spark_types == types
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, cur.fetchall())


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_coverage_invariant(spark):
    cov = queries()["qa_company_coverage"](spark, SF_SMALL).collect()
    assert all(r.n_expected == r.n_held + r.n_new + r.n_failed for r in cov)
    assert sum(r.n_expected for r in cov) == 221 and len(cov) == 148


def test_entry_smoke(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 148
