"""Every registered query against its expected SQL, and what its plan must not contain."""

from __future__ import annotations

import pytest
from compare import compare, duck
from test_sources import SMALL

import __spark_entry__ as entry
from funnelworks.registry import QUERIES as NAMES

QUERIES = {n: q for n, q in entry.queries().items() if n in NAMES}
EXPECTED = {n: q for n, q in entry.oracle_sql().items() if n in NAMES}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_each_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    message, _, _ = compare(spark, con, SMALL, name, QUERIES[name], EXPECTED[name])
    assert not message


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", ["raw_marketing", "raw_opportunities", "raw_customer_monthly"])
def test_plans_have_no_products_and_read_few_columns(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    reads = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in line]
    assert reads and all("l_linenumber" not in line and "l_tax" not in line for line in reads)


def test_questions_read_published_tables_once(spark):
    """No question goes back to the base tables, and the funnel questions do not read a fact at all."""
    for name in ("q01_full_funnel", "q18b_budget_by_recommendation", "rd23"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "orders" not in plan and plan.count("fact_leads") <= 1


def test_a_stock_session_runs_the_build():
    """Without any preset folder: Spark's defaults are read from an empty configuration folder."""
    import os
    import subprocess
    import sys
    import tempfile

    code = (
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as e\n"
        "s = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert not s.conf.get('spark.checkpoint.dir', None)\n"
        f"print('ROWS', e.queries()['clean_customers'](s, '{SMALL}').count(), e.queries()['csv_leads'](s, '{SMALL}').count())\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": tempfile.mkdtemp(prefix="empty-conf-")}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300, cwd=os.path.dirname(entry.__file__))
    assert "ROWS 143 1495" in out.stdout, out.stderr[-2000:]


def test_filters_reach_the_scan(spark):
    plan = QUERIES["raw_opportunities"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,350000.0)" in plan
