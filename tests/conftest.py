from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from accountlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    # Python workers import the repository from wherever the tests are started.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH")]))
    folder = tmp_path_factory.mktemp("spark")
    session = local_session("4", "accountlens-tests", memory="6g", shuffle_partitions=4,
                            warehouse=str(folder / "warehouse"), shared=str(folder / "shared"))
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples; None sorts first."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
