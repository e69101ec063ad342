"""Every registered query vs its DuckDB oracle (independent SQL formulation).

Runs at sf0.001 in the default suite (fast); set TALLYLINE_ORACLE_SF to a
directory (e.g. /root/testdata/sf0.01) for the driver's scale.
"""

import os

import pytest

import __spark_entry__ as E
from harness import compare, duck, type_diffs
from tallyline.plans import registry

SF = os.environ.get("TALLYLINE_ORACLE_SF", "/root/testdata/sf0.001")
registry.load_all()
KEYS = sorted(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = registry.QUERIES[key](spark, SF)
    ok, msg = compare(df, con, registry.ORACLE[key])
    assert ok, msg
    assert type_diffs(df, con, registry.ORACLE[key]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 82
    assert df.count() > 0


def test_entry_without_the_optional_subpackage(tmp_path):
    """The entry imports and keeps its queries where the training-data folders are absent."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(
        "llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                         cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE))], out.stderr[-500:]
