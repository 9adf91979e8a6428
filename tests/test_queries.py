"""Every registered query beside its SQL twin on the smallest tables, and the driver's contract."""

from __future__ import annotations

import math

import duckdb
import pytest

from hyphalake.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


#: Queries that find nothing in the smallest tables.
FEW = {"p10_maf_filter", "t16_pairwise_contrasts", "t43_groups_with_many"}


@pytest.fixture(scope="module")
def twin():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return ""
    if isinstance(x, bool):
        return str(x)
    try:
        return f"{float(x):.6g}"
    except (TypeError, ValueError):
        return str(x)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, twin, name):
    got = registry.QUERIES[name](spark, FOLDER)
    names = sorted(got.columns)
    rows = sorted(tuple(plain(r[n]) for n in names) for r in got.collect())
    if name not in registry.ORACLE_SQL:
        assert rows or name in ("g7_sketch_pairs", "o4_strongest_terms")
        return
    rel = twin.sql(registry.ORACLE_SQL[name])
    at = [rel.columns.index(n) for n in names]
    assert sorted(rel.columns) == names
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert rows or name in FEW, name


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_training_data_subpackage(tmp_path):
    """The rest works when the subpackage and its pipeline are taken out."""
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parent.parent
    shutil.copytree(root / "hyphalake", tmp_path / "hyphalake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op1') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "hyphalake"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "hyphalake.llm" not in f.read_text(), f
