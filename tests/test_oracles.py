"""Every registered query against its DuckDB twin, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import base
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(base.QUERIES))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    if name in ORACLES:
        error = compare(df, duck, ORACLES[name])
        assert error in (None, "both empty"), error
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "redacted_text", "redaction_count", "pii_detected", "entries"]
