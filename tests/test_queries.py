"""Every registered query that has SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from strataloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(str([r[c] for c in columns]) for r in df.collect())
    if name not in catalogue.ORACLE_SQL:
        assert rows
        return
    got = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert rows == sorted(str([r[names.index(c)] for c in columns]) for r in got.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_parts(tmp_path):
    """On a copy without the subpackage, with and without the pipeline's file, all record queries are still there."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "strataloom", tmp_path / "strataloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()), len(e.oracle_sql()))"]
    for name in (None, "corpus_pipeline.py"):
        if name and (root / name).exists():
            shutil.copy(root / name, tmp_path)
        got = subprocess.run(said, cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
        assert got == [*sorted(catalogue.QUERIES), str(len(catalogue.ORACLE_SQL))]
