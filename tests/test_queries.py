import os

import pytest

from greensward.plans import catalog
from tests.oracle import check

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", list(catalog.SQL))
def test_same_rows_as_sql(spark, name):
    check(spark, catalog.QUERIES[name], catalog.SQL[name], SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.SQL])
def test_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_contract():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
