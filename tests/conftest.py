from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def table(spark, tmp_path):
    """A catalog table name of its own, stored under the test's folder."""
    import uuid

    from ledgerlake.sources import lake

    spark.conf.set(lake.TABLE_ROOT_SETTING, str(tmp_path / "tables"))
    return f"t_{uuid.uuid4().hex}"


def rows(df, *order):
    """Rows as tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
