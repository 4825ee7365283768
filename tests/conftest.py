import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clientele.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def day():
    """The n-th day of February 2024, as a load time."""
    return lambda n, hour=0: datetime(2024, 2, n, hour)


@pytest.fixture
def forced_shuffle(spark):
    """No broadcast by size, as with tables too large for one."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def values(df, *columns):
    """Rows as sorted tuples of text, to compare frames regardless of order."""
    df = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted(tuple(str(v) for v in row) for row in df.collect())
