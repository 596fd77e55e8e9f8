"""Registered queries against their oracles, and plans."""

import glob
import os
import shutil
import subprocess
import sys
from decimal import Decimal

import duckdb
import pytest

from waymark.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, (float, Decimal)):
        return round(float(value), 5)
    return str(value) if hasattr(value, "isoformat") else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    out = QUERIES[name](spark, SF)
    got = out.collect()
    if name not in ORACLES:
        assert out.columns
        return
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(out.columns)
    assert rows(out.columns, got) == rows(columns, cursor.fetchall())


def test_library_stands_without_corpus_operators():
    for path in glob.glob(os.path.join(os.path.dirname(__file__), "..", "waymark", "**", "*.py"), recursive=True):
        if os.sep + "llm" + os.sep not in path:
            assert "waymark.llm" not in open(path, encoding="utf-8").read(), path


def test_entry_imports_and_runs_without_corpus_operators(tmp_path):
    root = os.path.join(os.path.dirname(__file__), "..")
    shutil.copytree(f"{root}/waymark", tmp_path / "waymark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 130 and set(o) <= set(q) and 'op1_decontaminate' not in q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    for name in ("dup_pairs_rule_a", "rect_counts", "tfidf_similar_pairs"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text
        if name != "tfidf_similar_pairs":
            assert "BroadcastNestedLoopJoin" not in text
    projected = QUERIES["page_hosts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string>" in projected


def test_heavy_rows_of_a_compact_file_are_dealt_to_many_tasks(spark):
    for name in ("detail_records", "poi_blocks", "line_hours", "hours_render", "price_with_menus", "address_neighbours"):
        assert "RoundRobinPartitioning" in QUERIES[name](spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString(), name
