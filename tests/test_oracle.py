"""Every query of the survey engine against its SQL on the same files."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_module
from surveyflow.plans.oracle import oracle_statements
from surveyflow.plans.queries import registered

QUERIES, SQL = registered(), oracle_statements()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries_return_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_no_sql_without_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_optional_operators_may_be_absent(tmp_path):
    """Without the text operators and the pipeline the entry module still offers all other queries."""
    root = Path(entry_module.__file__).resolve().parent
    shutil.copytree(root / "surveyflow", tmp_path / "surveyflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.registered()), len(e.oracle_sql()) > 50)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr


def test_entry_without_what_only_the_optional_operators_need(tmp_path):
    root = Path(entry_module.__file__).resolve().parent
    (tmp_path / "tiktoken.py").write_text("raise ImportError('hidden')\n")
    (tmp_path / "tokenizers.py").write_text("raise ImportError('hidden')\n")
    (tmp_path / "xxhash.py").write_text("raise ImportError('hidden')\n")
    code = "import __spark_entry__ as e; print(len(e.queries()) >= 69, len(e.oracle_sql()) > 60)"
    env = {**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr


def test_flagship(spark):
    rows = {r["Depression_Severity"]: r["Total_Pacienti"] for r in entry_module.entry(spark).collect()}
    assert rows == {"Minimala": 570, "Usoara": 181, "Moderat_Severa": 103, "Severa": 94, "Moderata": 36}
