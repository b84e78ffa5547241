from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tianguis.plans.frames import typed_frames  # noqa: E402
from tianguis.plans.star import plan_star  # noqa: E402
from tianguis.session import build_session  # noqa: E402
from tianguis.sources.raw import read_raw  # noqa: E402
from tianguis.sources.standin import StandIn  # noqa: E402

FIXTURES = str(ROOT / "tests" / "fixtures")
TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_partitions(spark):
    """Keep small range partitions apart, so the distributed paths really cross partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="session")
def raw(spark):
    return read_raw(spark, FIXTURES)


@pytest.fixture(scope="session")
def star(raw):
    return plan_star(raw)


@pytest.fixture(scope="session")
def frames(raw):
    return typed_frames(raw)


@pytest.fixture(scope="session")
def standin(spark):
    if not TESTDATA.exists():
        pytest.skip("no test tables")
    return StandIn(spark, str(TESTDATA))


def rows(df, *order):
    """Rows as dictionaries, sorted by the given columns."""
    found = [row.asDict() for row in df.collect()]
    return sorted(found, key=lambda r: tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in order))
