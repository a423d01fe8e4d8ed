import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwatch.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """DataFrame from column names (or a DDL schema) and tuples."""

    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return make


def column(df, name, order=None):
    df = df.orderBy(order) if order else df
    return [r[name] for r in df.select(name, *([order] if order and order != name else [])).collect()]
