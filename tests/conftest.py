import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from conceptloom.runtime import local_session

    session = local_session("tests", cores="4", shuffle_partitions=4, memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def same(spark, sf):
    """Compare a query with its SQL on the smallest tables."""
    import duckdb

    from compare import canonical

    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for p in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")

    def check(query, sql):
        mine, theirs = query(spark, sf).toPandas(), db.execute(sql).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert canonical(mine) == canonical(theirs)

    return check
