from __future__ import annotations

import gc
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillhouse.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def freed(request):
    """A test that counts the calls to the JVM begins when what earlier tests dropped has been released there."""
    if request.node.name == "test_headers_are_read_by_executors":
        dropped = request.getfixturevalue("spark").sparkContext._gateway._gateway_client.finalizer_deque
        gc.collect()
        end = time.monotonic() + 60
        while dropped and time.monotonic() < end:
            time.sleep(0.1)
        time.sleep(0.5)  # the last ones are on their way


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF


@pytest.fixture(scope="session")
def lines(spark, sf_dir):
    from tillhouse.plans.lines import sales_lines
    from tillhouse.sources import fixture

    return sales_lines(fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir))


def rows(df) -> list[tuple]:
    """Rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
