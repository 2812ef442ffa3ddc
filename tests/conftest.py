from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.plans.shapes import Tables  # noqa: E402
from millrace.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        {
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, TESTDATA)


@pytest.fixture
def new_path(spark):
    from millrace.session import shared_path

    return lambda label="t": shared_path(spark, label)


def plan_of(df) -> str:
    """The physical plan as `explain` prints it."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
