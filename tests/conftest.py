import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gleanmark.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-")  # driver and tasks share this machine's disk
    session = local_session("*", "tests", **{"spark.checkpoint.dir": shared})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a table as sorted tuples."""

    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return of
