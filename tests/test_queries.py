"""Every registered query equals its SQL oracle (DuckDB) on the smallest tables."""
import pytest

import __spark_entry__ as E
from tools.compare import digest

from conftest import SF

from intake_spark.plans import registry

KEYS = sorted(registry.QUERIES)


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["watch", "scan_no", "name", "size", "hash", "count"]
    assert df.count() == 109  # known-good flagship count at sf0.001


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    con = duck(SF["0.001"])
    s = E.queries()[key](spark, SF["0.001"]).toPandas()
    o = con.execute(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(s) == digest(o)
