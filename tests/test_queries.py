"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    return float(f"{value:.10g}") + 0.0 if isinstance(value, float) else value


def rows(table):
    columns = [table.column(n).to_pylist() for n in sorted(table.column_names)]
    return sorted((tuple(plain(v) for v in row) for row in zip(*columns)), key=repr)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() == 5250


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, db, name):
    mine = QUERIES[name](spark, sf).toArrow()
    if name not in ORACLES:
        assert mine.num_rows > 0
        return
    theirs = db.sql(ORACLES[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert rows(mine) == rows(theirs)
