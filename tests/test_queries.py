"""Every query with check SQL gives what DuckDB gives on the same files."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import canonical

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    found = duck.execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(frame.columns) == sorted(columns)
    rows = [tuple(row) for row in frame.collect()]
    assert canonical(frame.columns, rows) == canonical(columns, found.fetchall())


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_a_row_per_junction(spark):
    assert entry.entry(spark).count() == 8


def test_entry_without_the_corpus_operators(tmp_path):
    """The other queries are there when the corpus subpackage is not, with and without the pipeline's file."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json")
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    script = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    for gone in ("", "corpus_pipeline.py"):
        if gone and os.path.exists(tmp_path / "copy" / gone):
            os.remove(tmp_path / "copy" / gone)
        run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "copy", capture_output=True, text=True)
        assert run.returncode == 0, run.stderr
        names = run.stdout.split()
        assert "peak_hour" in names and "pipeline" not in names
        assert not [n for n in names if n.startswith("op")]
