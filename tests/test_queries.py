"""Every core query runs, and equals its SQL where it has one."""

import pytest

from conceptloom.plans import general, pipeline, pipeline_sql

QUERIES = general.QUERIES | pipeline.QUERIES
SQL = general.SQL | pipeline_sql.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, same):
    if name in SQL:
        same(QUERIES[name], SQL[name])
    else:
        QUERIES[name](spark, sf).collect()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["chapter_id", "node", "root", "depth"]
    assert set(e.oracle_sql()) <= set(e.queries())
