from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import SAMPLES, sql_session  # noqa: E402

from parcelledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(SAMPLES / "sf0.001")


@pytest.fixture(scope="session")
def sql(small):
    return sql_session(small)
