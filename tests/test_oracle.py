"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in entry.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    kinds = dict(df.dtypes)
    assert {n: TYPES[kinds[n]] for n in names} == {d[0]: str(d[1]) for d in cursor.description}
    got = [tuple(r[n] for n in names) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_twin_has_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    rows = {r.method: r for r in entry.entry(spark).collect()}
    assert rows["OFFICIAL published total"].rows_used == 1
    naive = rows["NAIVE  SUM(all rows)"].total_starts
    assert naive > 10 * rows["OFFICIAL published total"].total_starts
