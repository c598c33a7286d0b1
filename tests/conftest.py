import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tastemill.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        8,
        **{
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_parts(spark):
    """Keep small test tables split over all partitions, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
