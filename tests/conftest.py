import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cataloom.operators.changes import Audit  # noqa: E402
from cataloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def audit():
    return Audit(datetime(2024, 1, 2, 3, 4, 5), 7)


def rows(df, *columns):
    """Sorted row tuples, for comparing without order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture
def rows_of():
    return rows
