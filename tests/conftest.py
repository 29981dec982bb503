import datetime as dt

import pytest

from cartwise.session import build_session
from cartwise.sources import schemas

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(n: int) -> dt.date:
    """The n-th of March 2018."""
    return dt.date(2018, 3, n)


@pytest.fixture
def make(spark):
    """Tables from tuples, by schema name."""
    def build(name, rows):
        return spark.createDataFrame(rows, schemas.SCHEMAS[name])

    return build


def rows(df, *keys):
    """Rows as dictionaries, keyed by the given columns."""
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}
