"""Every query of the subpackage runs on the smallest tables, and equals its SQL where it has one."""

import pytest

from conceptloom.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(name, spark, sf, same):
    if name in catalog.SQL:
        same(catalog.QUERIES[name], catalog.SQL[name])
    else:
        catalog.QUERIES[name](spark, sf).collect()
