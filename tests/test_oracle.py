"""Every registered query against its DuckDB oracle (rows-only where none)."""
import pytest

import __spark_entry__ as E
from conftest import SF01
from tablerail.testing import compare_frames, duckdb_for

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_for(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF01).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = con.execute(SQL[name]).df()
    ok, msg = compare_frames(got, want)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["stage", "status", "count"]
    assert df.count() > 0


def test_every_query_has_a_docstring():
    from tablerail.plans.catalog import load_all
    for name, e in load_all().items():
        assert e.doc, name
