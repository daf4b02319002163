from __future__ import annotations

import pathlib
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from funnelworks.model import Exports, Reference, Star
from funnelworks.schemas import EXPORT_SCHEMAS, REFERENCE_SCHEMAS, STAR_SCHEMAS, ddl
from funnelworks.session import build_session, tune


@pytest.fixture(scope="session")
def spark():
    session = tune(build_session(8, "tests", spark__sql__shuffle__partitions="2"))
    yield session
    session.stop()


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def typed(rows, columns):
    """Rows as dicts or tuples to tuples that fit the declared types; missing columns are NULL."""
    out = []
    for r in rows:
        values = [r.get(c) for c in columns] if isinstance(r, dict) else list(r)
        out.append(
            tuple(
                money(v) if k.startswith("decimal") else float(v) if k == "double" and v is not None else v
                for v, k in zip(values, columns.values(), strict=True)
            )
        )
    return out


def frame(spark, rows, columns):
    return spark.createDataFrame(typed(rows, columns), ddl(columns))


@pytest.fixture(scope="session")
def make_exports(spark):
    """Exports from lists of rows; position is the order in the list."""

    def make(**tables):
        frames = {}
        for name, columns in EXPORT_SCHEMAS.items():
            rows = tables.get(name, [])
            with_pos = {**columns, "_pos": "bigint"}
            placed = [
                {**r, "_pos": i} if isinstance(r, dict) else (*r, i) for i, r in enumerate(rows)
            ]
            frames[name] = frame(spark, placed, with_pos)
        return Exports({n: (lambda df=df: df) for n, df in frames.items()})

    return make


@pytest.fixture(scope="session")
def reference(spark):
    channels = [(1, "Google Ads", "Paid Search", 1), (2, "LinkedIn Ads", "Paid Social", 1), (3, "Email", "Owned", 0)]
    campaigns = [
        (10, "High Intent", 1, "Leads", None),
        (11, "Brand", 1, "Awareness", None),
        (20, "Decision Makers", 2, "Leads", None),
        (30, "Newsletter", 3, "Leads", None),
    ]
    regions = [(1, "Brussels", "Capital"), (2, "Liège", "South"), (3, "Namur", "South"), (4, "East Flanders", "North")]
    synonyms = [("bruxelles", "Brussels"), ("LIEGE", "Liège"), ("oost-vlaanderen", "East Flanders")]
    frames = {
        "channels": frame(spark, channels, REFERENCE_SCHEMAS["channels"]),
        "campaigns": frame(spark, campaigns, REFERENCE_SCHEMAS["campaigns"]),
        "regions": frame(spark, regions, REFERENCE_SCHEMAS["regions"]),
        "synonyms": spark.createDataFrame(synonyms, "label string, name string"),
    }
    return Reference({n: (lambda df=df: df) for n, df in frames.items()})


@pytest.fixture(scope="session")
def make_star(spark):
    """A star from lists of rows; tables that are not given are empty, the calendar is Nov 2025 to Mar 2026."""
    from funnelworks.functions.dates import calendar

    def make(period=(20251101, 20260331), **tables):
        builders = {
            name: (lambda n=name, c=columns: frame(spark, tables.get(n, []), c)) for name, columns in STAR_SCHEMAS.items()
        }
        builders["dim_date"] = lambda: calendar(spark, "2025-10-01", "2026-04-30")
        return Star(builders, period)

    return make


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
