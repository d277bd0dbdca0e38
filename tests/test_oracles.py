"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cellamp.plans import file_queries, queries

QUERIES = queries.QUERIES | file_queries.QUERIES

TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = [tuple(None if v is None or v != v else v for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck, shared_runs):
    result = entry.queries()[name](spark, sf_dir)
    expected = duck.execute(entry.oracle_sql()[name])
    types = {c[0]: TYPES[str(c[1])] for c in expected.description}
    assert {f.name: f.dataType.simpleString() for f in result.schema} == types
    expected = expected.df()
    assert len(expected)
    assert _rows(result.toPandas()) == _rows(expected)
