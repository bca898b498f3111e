from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for path in (str(ROOT), str(ROOT / "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from surveyflow import default_spec  # noqa: E402
from surveyflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "surveyflow-tests",
        spark__master="local[*]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__warehouse__dir=str(shared / "warehouse"),
        spark__checkpoint__dir=str(shared / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def spec():
    return default_spec()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("SURVEYFLOW_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
