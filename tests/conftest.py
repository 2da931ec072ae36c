from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallywood import build_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    if not TESTDATA.is_dir():
        pytest.skip("test tables are not there")
    return str(TESTDATA)


@pytest.fixture
def plan_text(capsys):
    """Formatted plan of a frame as text."""

    def explain(frame) -> str:
        capsys.readouterr()
        frame.explain("formatted")
        return capsys.readouterr().out

    return explain
