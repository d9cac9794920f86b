from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hazardbook.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
