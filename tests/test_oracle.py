"""Every registered warehouse query against its independent DuckDB SQL (sf0.001)."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from carespark.plans.registry import QUERIES
from oracle.compare import compare, duck

from conftest import ROOT, SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "summary_key" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert not problems, problems


def test_the_rest_stands_without_the_optional_operators(tmp_path):
    rest = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=rest)
    code = ("import __spark_entry__ as e; from carespark.plans.registry import QUERIES; "
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()); print('whole')")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert out.stdout.strip().endswith("whole"), out.stderr
