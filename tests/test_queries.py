"""Every registered query of the volume operators against its SQL."""

from __future__ import annotations

import pytest

from stratovox.plans import catalog
from tests.compare import same


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, data, name):
    same(catalog.QUERIES[name](spark, data), catalog.ORACLE_SQL[name], data)


def test_entry_module_has_all_queries():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
