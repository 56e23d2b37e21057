from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallybook.session import build_session

    session = build_session(
        "tests",
        "local[*]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df, *order):
    """Rows as tuples, in the given order if any."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
