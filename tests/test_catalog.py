"""Every registered query against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from wafertide.plans import catalog


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for path in glob.glob(f"{tiny}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n in catalog.ORACLES])
def test_query_equals_sql(spark, duck, tiny, name):
    got = catalog.QUERIES[name](spark, tiny)
    want = duck.sql(catalog.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    ours = sorted((repr([r[n] for n in names]) for r in got.collect()))
    theirs = sorted(repr([r[want.columns.index(n)] for n in names]) for r in want.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_corpus_subpackage(tmp_path):
    """The entry module and the catalog stand without the subpackage."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/wafertide", tmp_path / "wafertide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and not [n for n in e.queries() if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
