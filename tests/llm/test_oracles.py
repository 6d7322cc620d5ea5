"""Every query with SQL against DuckDB on the smallest scale; every query runs and keeps its rows."""

import pytest

import __spark_entry__ as entry
from tests.parity_util import compare, duck
from wardlens.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.all_oracles()))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, registry.all_queries()[name], registry.all_oracles()[name], SF)["status"] == "match"


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_queries_run_from_any_folder(tmp_path):
    """The executors get the package with the query: their Python need not have it on its path."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as e\n"
            f"print('ROWS', e.queries()['op6_secret_grammar'](s, {SF!r}).count())")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS 200" in run.stdout, run.stderr[-1500:]
