import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sievework.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a result."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
