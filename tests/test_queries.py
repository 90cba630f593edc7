"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checker import connect, differences
from conftest import ROOT
from registry import ORACLES, QUERIES

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", [
    "series_alerts", "impute_knn", "encode_auto", "merge_surveys", "join_by_respondent",
    "mutual_information", "enforce_k", "binary_metrics", "roc_points", "zip_samples",
    "expanding_folds", "winsorize_iqr", "mode_of",
])
def test_same_with_one_partition(spark, con, sf_dir, name):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("left_over", ["", "corpus_pipeline.py", "medlark/llm/__pycache__/x.pyc"])
def test_training_data_part_may_be_absent(tmp_path, left_over):
    """The entry and the base tests stand without the optional part, whatever a deletion leaves behind."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    if left_over.endswith(".pyc"):
        (copy / left_over).parent.mkdir(parents=True)
        (copy / left_over).write_bytes(b"")
    elif left_over:
        shutil.copy(f"{ROOT}/{left_over}", copy)
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    names = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    out = subprocess.run([sys.executable, "-c", names], cwd=copy, env=env, capture_output=True, text=True, check=True)
    assert out.stdout.split() == sorted(QUERIES)
    run = [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"]
    assert subprocess.run(run, cwd=copy, env=env, capture_output=True).returncode == 0


def test_entry_lists_every_event_type(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and all(r["n_points"] > 0 for r in rows)
