"""Every registered query against its SQL on the same tables: values and types."""

import pytest

import __spark_entry__ as entry_point
import parity
from merchantlake.registry.oracle import ORACLE
from merchantlake.registry.queries import QUERIES

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


#: Nothing to show is a right result of these on the small tables.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return parity.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry_gives_rows(spark):
    assert entry_point.entry(spark).columns == ["Month", "City", "Merchant", "Purchase Total", "No of sales"]
    assert not entry_point.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, sf_dir, con, name):
    df, sql = QUERIES[name](spark, sf_dir), ORACLE[name]
    assert not df.isEmpty() or name in MAY_BE_EMPTY
    assert parity.compare(df, con, sql) is None
    declared = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == declared
