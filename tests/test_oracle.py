"""Every registered query equals its SQL."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registered_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_entry_has_all_feature_columns(spark):
    from playthrough.schemas import FEATURE_COLUMNS

    df = contract.entry(spark)
    assert df.columns == FEATURE_COLUMNS
    assert df.limit(1).count() == 1
