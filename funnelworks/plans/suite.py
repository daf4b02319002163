"""The run log: every analysis must run and return rows, every integrity test must find nothing."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import n_rows
from ..session import together
from .analyses import ANALYSES
from .integrity import integrity_tests
from .views import Views

#: Questions that look for exceptions.
MAY_BE_EMPTY = frozenset({"q19"})
LOG = "suite string, number int, label string, rows_returned bigint, ms bigint, status string"
Statement = tuple[str, int, str, Callable[[Views], DataFrame]]


def statements() -> list[Statement]:
    """(suite, number within the suite, label, plan) of all analyses."""
    seen: dict[str, int] = {}
    out = []
    for ident, (suite, _, plan) in ANALYSES.items():
        seen[suite] = seen.get(suite, 0) + 1
        out.append((suite, seen[suite], ident, plan))
    return out


def execute(v: Views, statement: Statement) -> tuple:
    """Runs one statement in full, every column of every row; a failure is its status and stops no other one."""
    suite, number, label, plan = statement
    start = time.perf_counter()
    rows = None
    try:
        seen = Observation()
        plan(v).observe(seen, n_rows().alias("rows")).write.format("noop").mode("overwrite").save()
        rows = seen.get["rows"]
        status = "PASS" if rows else "EMPTY"
    except Exception as e:  # noqa: BLE001 - whatever goes wrong belongs in the log
        status = f"ERROR ({type(e).__name__})"
    return suite, number, label, rows, round(1000 * (time.perf_counter() - start)), status


def execute_tests(v: Views) -> list[tuple]:
    start = time.perf_counter()
    try:
        found = sorted(integrity_tests(v).collect(), key=lambda r: r.test_name)  # one row per test
    except Exception as e:  # noqa: BLE001
        return [("integrity", 1, "integrity_tests", None, round(1000 * (time.perf_counter() - start)), f"ERROR ({type(e).__name__})")]
    each = round(1000 * (time.perf_counter() - start) / len(found))
    return [
        ("integrity", i, r.test_name, 1, each, "PASS" if r.failures == 0 else f"FAIL ({r.failures})")
        for i, r in enumerate(found, 1)
    ]


def run_log(v: Views, suite: list[Statement] | None = None) -> DataFrame:
    """(suite, number, label, rows_returned, ms, status), one row per executed statement and integrity test."""
    jobs = [partial(execute, v, s) for s in (statements() if suite is None else suite)]
    rows = together(jobs)
    return v.star.spark.createDataFrame([*rows, *execute_tests(v)], LOG)


def require_success(log: DataFrame, may_be_empty: frozenset[str] = frozenset()) -> None:
    """Raises when a statement or test of the log did not pass. The log has one row per statement. For the statements of
    ``may_be_empty``, no row is an answer."""
    fine = (F.col("status") == "PASS") | ((F.col("status") == "EMPTY") & F.col("label").isin(*may_be_empty))
    bad = log.where(~fine).collect()
    if bad:
        raise RuntimeError("; ".join(f"{r.label}: {r.status}" for r in bad))
