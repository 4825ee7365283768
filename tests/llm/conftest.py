import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    """Rows of a test table as tuples of the named columns, by the first."""
    frames = {}

    def rows(name, *columns):
        if name not in frames:
            frames[name] = spark.read.parquet(f"{SF}/{name}.parquet").cache()
        return sorted(map(tuple, frames[name].select(*columns).collect()))

    return rows
