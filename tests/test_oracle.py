"""Every registered query against its SQL twin, at the smallest scale."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from barloom.plans.oracle import all_sql
from barloom.plans.queries import all_queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert all_queries().keys() == all_sql().keys()
    assert all_queries().keys() <= queries().keys() and oracle_sql().keys() <= queries().keys()


def test_the_rest_works_without_the_optional_folders(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "barloom", tmp_path / "barloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert [line.split() for line in said.stdout.splitlines()] == [sorted(all_queries()), sorted(all_sql())]


def test_entry(spark):
    assert entry(spark).columns[-1] == "RSI" and entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_twin(spark, database, name):
    assert differences(queries()[name](spark, SF_DIR), database.sql(all_sql()[name])) is None
