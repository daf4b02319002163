"""Declared keys and rules, checked as queries: every failure is counted, none stops the others."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Tables
from ..schemas import CONSTRAINTS, STAR_SCHEMAS, Rules
from .dedupe import surplus_rows
from .lookup import one_per_member
from .rows import anti_count, rows_of, union_all


#: Tables whose keys are few beside the rows that point to them.
DIMENSIONS = ("dim_date", "dim_channel", "dim_campaign", "dim_region")


def check_constraints(tables: Tables, rules: Mapping[str, Rules] = CONSTRAINTS) -> DataFrame:
    """(table, constraint, kind, failures) for every declared constraint of every table.

    NOT NULL, CHECK and the foreign keys to dimensions share one pass per table: the keys of a dimension are joined once
    each, broadcast when the dimension is small. A key counts its surplus rows, a foreign key between large tables its rows
    without a partner; a NULL is a failure only where the column must not be NULL.
    """
    return union_all([part for table, r in rules.items() for part in _table_checks(tables, table, r)])


def _table_checks(tables: Tables, table: str, rules: Rules) -> list[DataFrame]:
    df = tables[table]
    required = [c for c in STAR_SCHEMAS[table] if c not in rules.nullable]
    failing = [(f"{c} not null", "NOT NULL", F.col(c).isNull()) for c in required]
    failing += [(name, "CHECK", ~F.coalesce(F.expr(test), F.lit(True))) for name, test in rules.checks.items()]
    looked_up = df
    for column, (parent, key) in rules.foreign.items():
        if parent in DIMENSIONS:
            known = tables[parent].select(F.col(key).alias(f"_{column}")).where(F.col(key).isNotNull()).distinct()
            known = one_per_member(known, tables[parent])
            looked_up = looked_up.join(known, F.col(column) == F.col(f"_{column}"), "left")
            orphan = F.col(column).isNotNull() & F.col(f"_{column}").isNull()
            failing.append((f"{column} -> {parent}", "FOREIGN KEY", orphan))
    counted = looked_up.agg(*[F.count_if(cond).alias(f"f{i}") for i, (_, _, cond) in enumerate(failing)])
    parts = [
        rows_of(
            counted,
            table=[F.lit(table)] * len(failing),
            constraint=[F.lit(name) for name, _, _ in failing],
            kind=[F.lit(kind) for _, kind, _ in failing],
            failures=[F.col(f"f{i}") for i in range(len(failing))],
        )
    ]

    def named(one_row: DataFrame, name: str, kind: str) -> DataFrame:
        return one_row.select(
            F.lit(table).alias("table"),
            F.lit(name).alias("constraint"),
            F.lit(kind).alias("kind"),
            F.col("n").cast("bigint").alias("failures"),
        )

    for keys, kind in [(rules.primary_key, "PRIMARY KEY"), *[(u, "UNIQUE") for u in rules.unique]]:
        parts.append(named(surplus_rows(df, keys), ", ".join(keys), kind))
    for column, (parent, key) in rules.foreign.items():
        if parent in DIMENSIONS:
            continue
        child = df.where(F.col(column).isNotNull())
        name = f"{column} -> {parent}"
        parts.append(named(anti_count(child, tables[parent], column, key), name, "FOREIGN KEY"))
    return parts
