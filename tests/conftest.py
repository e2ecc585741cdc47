import os
import sys
from pathlib import Path

import pytest

TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(TESTS.parent))
# Python workers import the package and the scorers defined in tests.
os.environ["PYTHONPATH"] = os.pathsep.join([str(TESTS.parent), str(TESTS), os.environ.get("PYTHONPATH", "")])

from cohortflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "*",
        app="tests",
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def databases(spark):
    """Fresh, empty raw and mart databases."""
    from cohortflow.sources.tables import create_all

    for name in ("raw", "analytics"):
        spark.sql(f"drop database if exists {name} cascade")
    create_all(spark)


def rows(df, *columns):
    """Sorted rows as tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
