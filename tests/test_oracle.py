"""Every query of the catalogue against its SQL, exactly, on the test tables."""

import pytest
from compare import TESTDATA, duck, duck_rows, spark_rows

from marketlens.plans import catalog, oracle

SF_DIR = f"{TESTDATA}/sf0.01"
QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(connection, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    different = [pair for pair in zip(rows, expected) if pair[0] != pair[1]]
    assert not different, different[:3]
