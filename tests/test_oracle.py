"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from scripts.check_oracle import digest, duck
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_a_builder_and_entry_runs(spark):
    assert set(ORACLE) <= set(QUERIES)
    out = E.entry(spark)
    assert out.count() >= 0 and out.columns == ["airline_code", "avg_delay", "flight_count"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_non_sql_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
