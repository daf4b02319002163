"""What is written and shuffled on the way to a query."""

from __future__ import annotations

import datetime
import os

import pytest

from funnelworks import registry
from funnelworks.model import Exports
from funnelworks.operators.dedupe import surplus_rows
from funnelworks.schemas import EXPORT_FILES
from funnelworks.sources.warehouse import BASE_SCHEMAS, QUALIFIED_ABOVE, Warehouse


@pytest.fixture()
def folder(spark, tmp_path):
    """Ten orders of one customer, every third of them qualified, one key null and one twice; three lines for each order."""
    day = lambda i: datetime.datetime(1996, 1 + i % 3, 1 + i)
    keys = [*range(1, 9), 6, None]
    tables = {
        "region": [(0, "EUROPE")],
        "nation": [(0, "FRANCE", 0)],
        "customer": [(1, 0, 100.0, "BUILDING")],
        "orders": [
            (k, 1, "F", QUALIFIED_ABOVE + 1.0 if (k or 0) % 3 == 0 else 10.0, day(i), "1-URGENT") for i, k in enumerate(keys)
        ],
        "lineitem": [
            (k, 10 * i + n, n, 5.0, 100.0 + i, 0.05, "N", day(i + n)) for i, k in enumerate([*range(1, 9), None]) for n in range(3)
        ],
    }
    for name, content in tables.items():
        spark.createDataFrame(content, BASE_SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture()
def shared(spark, tmp_path, monkeypatch):
    """The folder in which intermediate tables are written."""
    kept = tmp_path / "kept"
    kept.mkdir()
    monkeypatch.setattr(registry, "work_dir", lambda s, purpose: f"{kept}/{purpose}")
    return kept


def test_csv_of_reference_data_needs_no_exports(spark, folder, shared):
    assert [tuple(r)[1] for r in registry.QUERIES["csv_regions"](spark, folder).collect()] == ["FRANCE"]
    assert sorted(os.listdir(shared)) == ["reference"]


def test_csv_of_one_export_writes_no_other(spark, folder, shared):
    assert registry.QUERIES["csv_marketing"](spark, folder).count()
    assert os.listdir(shared / "exports") == ["marketing"] and os.listdir(shared / "csv") == [EXPORT_FILES["marketing"]]
    assert registry.QUERIES["csv_corrupt_rows"](spark, folder).count() == len(Exports.names)
    assert sorted(os.listdir(shared / "csv")) == sorted(EXPORT_FILES.values())


def test_only_lines_of_qualified_orders_are_kept(spark, folder):
    plain, kept = Warehouse(spark, folder), Warehouse(spark, folder, keep_lines=True)
    assert sorted(r.l_orderkey for r in kept.order_lines().collect()) == [3, 3, 3, 6, 6, 6]
    for base in (lambda w: w.opportunity_base(), lambda w: w.billing_base(w.opportunity_base().selectExpr("opportunity_id AS customer_id"))):
        a, b = (sorted(map(tuple, base(w).collect()), key=str) for w in (plain, kept))
        assert a == b and a


def test_other_lines_are_left_out_before_the_shuffle(spark, folder):
    """Where the orders are too many for a broadcast, the scan of the lines is filtered by their keys."""
    plan = Warehouse(spark, folder).qualified_line_plan()
    plan.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "might_contain" in plan._jdf.queryExecution().optimizedPlan().toString() and plan.count() == 6
    assert plan.sparkSession.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits") != spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")


def test_copies_of_wide_rows_are_counted_from_digests(spark):
    """Rows that come once are left out before whole rows are shuffled; NULL equals NULL."""
    rows = [(1, "a", None, 2.0), (1, "a", None, 2.0), (1, None, "a", 2.0), (2, "b", None, 0.0), (2, "b", None, -0.0), (3, "c", "d", None)]
    df = spark.createDataFrame(rows, "k int, a string, b string, x double")
    counted = surplus_rows(df, df.columns)
    assert [tuple(r) for r in counted.collect()] == [(2,)] and "LeftSemi" in counted._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in surplus_rows(df.where("k = 3"), df.columns).collect()] == [(0,)]
