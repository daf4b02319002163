"""The full rebuild: clean, write, audit, run the suite, export, publish - in one Spark application."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Exports, Reference, Star
from ..operators.constraints import check_constraints
from ..session import together
from ..sources.exports import VIEW_NAMES, write_csv, write_json, write_sample
from ..sources.stages import Stages, get, put, version_of
from ..sources.tables import mark_published, read_published, read_star, write_star
from .cleaning import Cleaning
from .integrity import integrity_tests
from .model import ReportModel, report_model
from .quality import GateError, Quality, gate
from .reconcile import kpi_summary
from .suite import MAY_BE_EMPTY, require_success, run_log
from .views import Views

VIEWS, EXPORTS = "views", "exports"
#: Part of the version of every stage: with other rules, nothing that was built before is used again.
RULES = "3"


@dataclass(frozen=True)
class Build:
    folder: str
    star: Star
    log: DataFrame
    checks: DataFrame
    row_counts: DataFrame
    constraints: DataFrame
    integrity: DataFrame
    views: Views
    model: ReportModel
    run_log: DataFrame
    #: Stages that this run did; the others were found done.
    stages: tuple[str, ...]


def build(
    spark: SparkSession,
    cleaning: Cleaning,
    folder: str,
    pointer: str | None = None,
    may_be_empty: frozenset[str] = MAY_BE_EMPTY,
) -> Build:
    """Writes the clean star, its reporting views and its quality reports, runs all statements and integrity tests on them,
    writes what other tools get (views, report tables, summary, samples of the raw exports), and publishes.

    The audit - quality gate, declared constraints, integrity tests, run log - runs on the written tables, so what was checked
    is what readers get. On a violation GateError, or RuntimeError for a statement that fails, is raised and the build stays
    unpublished; the tables and reports remain for inspection. Publishing is one rename, of the marker in the folder, and,
    if ``pointer`` names a file, one more that makes this the current build there.

    Every stage is recorded with the version of its input: the files of the exports and reference data. A build that was
    stopped goes on where it was, if it is started again in the same folder with the same input; with other input it starts anew.
    """
    raw, reference = cleaning.raw, cleaning.ref
    given = [*[raw[n] for n in Exports.names], *[reference[n] for n in ("channels", "campaigns", "regions")]]
    days = [] if isinstance(cleaning.days, DataFrame) else cleaning.days
    stages = Stages(spark, folder, version_of(spark, given, RULES, cleaning.period, *days))

    cleaning.materialise(stages.table)
    write_star(cleaning.star(), folder, stages.step)
    star = read_star(spark, folder, cleaning.period)
    quality = Quality(raw, reference, star)
    log, checks, rows, constraints, views = together(
        [
            lambda: stages.table("cleaning_log", lambda: cleaning.log),
            lambda: stages.table("data_quality_results", lambda: quality.checks),
            lambda: stages.table("row_counts", lambda: quality.rows),
            lambda: stages.table("constraints", lambda: check_constraints(star)),
            lambda: Views(star).publish(lambda name, make, by=None: stages.table(f"{VIEWS}/{name}", make, by)),
        ]
    )
    integrity = stages.table("integrity_tests", lambda: integrity_tests(views))
    gate(checks)
    _require_none(constraints, F.concat_ws(" ", "table", "constraint", "kind"))
    _require_none(integrity, F.col("test_name"))

    model = report_model(star, checks, rows, log).publish(stages.table)
    ran, *_ = together([lambda: _suite(stages, views, may_be_empty), *_exports(stages, raw, views, model)])
    mark_published(spark, folder, cleaning.period)
    if pointer:
        put(spark, pointer, {"build": folder, "version": stages.version})
    return Build(folder, star, log, checks, rows, constraints, integrity, views, model, ran, tuple(stages.done))


def _suite(stages: Stages, views: Views, may_be_empty: frozenset[str]) -> DataFrame:
    """The run log, if all of it passed; a log with a failure is made anew by the next run."""
    log = stages.table("run_log", lambda: run_log(views))
    try:
        require_success(log, may_be_empty)
    except RuntimeError:
        stages.forget("run_log")
        raise
    return log


def _exports(stages: Stages, raw: Exports, views: Views, model: ReportModel) -> list:
    """The writes of everything that a build hands to other tools, a stage each."""

    def step(name: str, work) -> object:
        return partial(stages.step, f"{EXPORTS}/{name}", work)

    return [
        *[step(f"views/{n}", lambda path, n=n: write_csv(getattr(views, n), path)) for n in VIEW_NAMES],
        *[step(f"model/{n}", lambda path, n=n: write_csv(model[n], path)) for n in ReportModel.names],
        step("kpi", lambda path: write_json(kpi_summary(views), path)),
        *[step(f"samples/{n}", lambda path, n=n: write_sample(raw, n, path)) for n in Exports.names],
    ]


def _require_none(results: DataFrame, name: Column) -> None:
    """Raises when a row has failures and names all of them; the results have one row per declared constraint or test."""
    broken = results.where("failures > 0").orderBy(F.col("failures").desc())
    found = [f"{r.name}: {r.failures}" for r in broken.select(name.alias("name"), "failures").collect()]
    if found:
        raise GateError("; ".join(found))


def read_published_views(spark: SparkSession, folder: str) -> Views:
    return Views.published(read_published(spark, folder), f"{folder}/{VIEWS}")


def current_build(spark: SparkSession, pointer: str) -> str:
    """The folder of the build that was published last under this pointer."""
    found = get(spark, pointer)
    if found is None:
        raise FileNotFoundError(f"nothing is published under {pointer}")
    return found["build"]
