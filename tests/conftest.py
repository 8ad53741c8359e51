from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[1]), os.environ.get("PYTHONPATH", "")])

from lodestone.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def tiny():
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test tables here")
    return str(DATA / "sf0.001")
