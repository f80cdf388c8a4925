"""Driver contract, plan shape, and every registered query against its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import SF_SMALL
from tidemark.oracle import ORACLE_SQL
from tidemark.workloads import QUERIES



def queries():
    return QUERIES


def oracle_sql():
    return ORACLE_SQL


TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# writing stages run Python on executors by design; all others must stay JVM-side
EFFECT_QUERIES = {"history_run", "move_and_verify", "incremental_ingest", "staged_contents", "bronze_job", "history_exactly_once",
                  "tree_listing", "ranged_copies", "landing_files", "typed_appends"}


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["folder", "to_copy", "excluded", "has_extension"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    s_recs = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_recs = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, s_recs) == _rows(o_cols, o_recs)


@pytest.mark.parametrize("name", sorted(set(queries()) - EFFECT_QUERIES))
def test_no_python_in_query_plans(spark, name):
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan, f"{name}: {marker}"


def test_filters_pushed_and_columns_pruned(spark):
    plan = queries()["dates_drop"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "DataFilters" in plan
    plan = queries()["unprocessed_folders"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "BroadcastHashJoin" in plan


def test_effect_query_runs_from_another_working_directory(tmp_path):
    """Executor-side Python must import the package even when the driver's
    working directory is elsewhere (it ships itself before Python stages)."""
    import os
    import subprocess
    import sys as _sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "s.sparkContext.setLogLevel('ERROR')\n"
        "from __spark_entry__ import queries\n"
        "print('ROWS', queries()['move_and_verify'](s, %r).filter('ok and arrived').count())\n"
    ) % (repo, SF_SMALL)
    out = subprocess.run([_sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 50" in out.stdout, out.stderr[-2000:]
