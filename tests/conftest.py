from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from docloom.session import local_session

    session = local_session("tests", shuffle_partitions=4)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture()
def table(spark):
    """table(schema, row, row, …) -> DataFrame"""

    def make(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def tuples(df, *columns):
    """The rows as a set-like sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
