from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from gapwise.plans.oracles import ORACLES
from gapwise.plans.queries import all_queries
from tests.parity import differences, oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_sql():
    assert sorted(all_queries()) == sorted(ORACLES)
    assert set(contract.queries()) >= set(contract.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, name) == []


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["week_start", "wau_users", "wau_sessions"]
    assert rows.count() == 5


@pytest.mark.parametrize("broken", ["folder", "module"])
def test_entry_without_the_optional_subpackage(tmp_path, broken):
    """An empty folder that a removed subpackage left, or a module that only it needs: the other
    queries stay."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    for name in ("gapwise", "__spark_entry__.py"):
        target = tmp_path / name
        (shutil.copytree if name == "gapwise" else shutil.copy)(f"{root}/{name}", target)
    if broken == "folder":
        shutil.rmtree(tmp_path / "gapwise" / "llm", ignore_errors=True)
        (tmp_path / "gapwise" / "llm" / "__pycache__").mkdir(parents=True)
    block = "sys.modules['xxhash'] = None; " if broken == "module" else ""
    code = f"import sys; {block}import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert out.stdout.split() == [str(len(all_queries())), str(len(ORACLES))], out.stderr
