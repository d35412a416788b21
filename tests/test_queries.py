import pytest

import __spark_entry__ as entry_module
from tools.compare import compare, oracle

SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db, SQL[name]) == []


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
