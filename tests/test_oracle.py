"""Every value-checked query against its DuckDB SQL on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_a_check_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert all(k == "pipeline" or k.startswith("op") for k in rows_only)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, duck, name):
    sdf = QUERIES[name](spark, sf_small)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, drows)
