"""Every query of the catalogue against its SQL."""

import pytest
from conftest import SF_DIR

import oracle
from catalogue import CATALOGUE


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query(spark, duck, name):
    query = CATALOGUE[name]
    assert query.sql, "every query has SQL"
    assert oracle.differences(query.run(spark, SF_DIR), query.sql, duck) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(CATALOGUE) <= set(entry.oracle_sql()) <= set(entry.queries())
