from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tideline-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of a small frame."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
