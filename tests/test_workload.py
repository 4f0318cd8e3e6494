"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from check import compare, connect
from clickloom.workload.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_names_and_twins():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) > 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        good, note = compare(df, duck, ORACLES[name])
        assert good, note
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert "is_pref_cat" in df.columns and df.count() > 0
