import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, categories, numbers  # noqa: E402
from tabwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def contract():
    """Wells: two measured columns, one of which may hold texts, and a category."""
    columns = (ColumnSpec("id", ID), *numbers("depth"), *numbers("flow", coercible=True), *categories("soil"), ColumnSpec("target", TARGET))
    return DatasetContract("wells", columns, ("Yes", "No"))
