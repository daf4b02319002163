"""Measures: named calculations that any report groups and filters as it likes.

A measure is a formula over *parts*. A part is one aggregate of one fact, evaluated in the filter context of the
request: the dimensions its fact can reach. Each fact of a request is read once, into a base: its parts by the grouping
columns and by whatever else its contexts tell apart (the month, a filtered column, the last period). Every row of the base
is then dealt to the contexts it belongs to - its own month and the one after it, the filtered groups and those of a wider
context - and added up there. The small results of all facts are folded by the grouping columns, and the formulas are applied
last. Facts therefore never meet each other row by row.

Blank rules: a missing value stays NULL; it counts as 0 when added or subtracted; a ratio with a zero or missing
denominator is NULL; a count of nothing is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import count_where, dbl, n_rows, ratio
from ..model import month_of
from ..operators.rows import union_all
from ..schemas import MONTH as STORED_BY
from .model import RELATIONSHIPS, ReportModel

Predicate = Callable[[Column], Column]
MONTH = "DimDate.year_month"
#: Columns of cells and bases: which grouping columns are kept, the period, and the member that is counted.
SET, PERIOD, MEMBER = "_set", "_period", "_member"


@dataclass(frozen=True)
class Part:
    """One aggregate of one fact. ``only`` replaces the filters on a column, ``ignore`` drops those on a dimension.

    ``aggregate`` can be summed further, ``finish`` turns the sum into the value; with ``distinct`` the value is the number of
    members of that column for which ``aggregate`` is 1. Where a request neither groups by nor filters what a part
    replaces or drops, the part needs no context of its own: ``masked`` is its aggregate over the rows that ``only`` keeps, and
    a part that ignores a dimension is the sum of the part ``whole`` over that dimension's groups.
    """

    fact: str
    aggregate: Callable[[], Column]
    masked: Callable[[Column], Column] | None = None
    whole: str | None = None
    only: tuple[tuple[str, int], ...] = ()
    ignore: str | None = None
    months_back: int = 0
    last_by: str | None = None
    distinct: str | None = None
    finish: Callable[[Column], Column] = lambda c: c


@dataclass(frozen=True)
class Context:
    """Where parts of a fact look: the grouping columns they keep, the filters of the request that they obey, the values they
    set instead, and how many months they look back."""

    kept: tuple[str, ...]
    obeys: tuple[str, ...]
    sets: tuple[tuple[str, int], ...] = ()
    back: int = 0


@dataclass(frozen=True)
class Measure:
    label: str
    home: str
    formula: Callable[[dict[str, Column]], Column]


def known_count(cond: Column | None = None) -> Column:
    return F.nullif(n_rows() if cond is None else count_where(cond), F.lit(0))


def _sum_where(value: str, cond: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.sum(F.when(cond(), F.col(value)))


def _is(column: str, value) -> Callable[[], Column]:
    return lambda: F.col(column) == value


MKT, LEADS, OPPS, MONTHLY = "FactMarketingDaily", "FactLeads", "FactOpportunities", "FactCustomerMonthly"
CHECKS, COUNTS, CAMPAIGNS = "DataQualityChecks", "DataQualityRowCounts", "DimCampaign"
PAID = (("DimChannel.is_paid", 1),)
NOT_PAID = (("DimChannel.is_paid", 0),)

_spend = lambda: F.sum("spend")
_customers = lambda: known_count(F.col("is_won") == 1)
_revenue = _sum_where("won_value", _is("is_won", 1))

PARTS: dict[str, Part] = {
    "spend": Part(MKT, _spend, finish=dbl),
    "impressions": Part(MKT, lambda: F.sum("impressions")),
    "clicks": Part(MKT, lambda: F.sum("clicks")),
    "sessions": Part(MKT, lambda: F.sum("sessions")),
    "paid_spend": Part(MKT, _spend, only=PAID, masked=lambda m: F.sum(F.when(m, F.col("spend"))), finish=dbl),
    "leads": Part(LEADS, known_count),
    "mqls": Part(LEADS, lambda: known_count(F.col("is_mql") == 1)),
    "sqls": Part(LEADS, lambda: known_count(F.col("is_sql") == 1)),
    "score_sum": Part(LEADS, lambda: F.sum("lead_score")),
    "score_count": Part(LEADS, lambda: F.count("lead_score")),
    "leads_all_channels": Part(LEADS, known_count, ignore="DimChannel", whole="leads"),
    "leads_before": Part(LEADS, known_count, months_back=1),
    "opportunities": Part(OPPS, known_count),
    "customers": Part(OPPS, _customers),
    "closed": Part(OPPS, lambda: known_count(F.col("status").isin("Won", "Lost"))),
    "revenue": Part(OPPS, _revenue, finish=dbl),
    "cycle_sum": Part(OPPS, lambda: F.sum(F.when(F.col("is_won") == 1, F.col("sales_cycle_days")))),
    "cycle_count": Part(OPPS, lambda: F.count(F.when(F.col("is_won") == 1, F.col("sales_cycle_days")))),
    "open_value": Part(OPPS, _sum_where("expected_value", _is("status", "Open")), finish=dbl),
    "lost_value": Part(OPPS, _sum_where("expected_value", _is("status", "Lost")), finish=dbl),
    "paid_customers": Part(
        OPPS, _customers, only=PAID, masked=lambda m: known_count((F.col("is_won") == 1) & F.coalesce(m, F.lit(False)))
    ),
    "non_paid_revenue": Part(
        OPPS,
        _revenue,
        only=NOT_PAID,
        masked=lambda m: F.sum(F.when(m & (F.col("is_won") == 1), F.col("won_value"))),
        finish=dbl,
    ),
    "customers_all_channels": Part(OPPS, _customers, ignore="DimChannel", whole="customers"),
    "revenue_before": Part(OPPS, _revenue, months_back=1, finish=dbl),
    "mrr": Part(MONTHLY, _sum_where("mrr", _is("is_active", 1)), finish=dbl),
    "mrr_end": Part(MONTHLY, _sum_where("mrr", _is("is_active", 1)), last_by="month_key", finish=dbl),
    "active": Part(MONTHLY, lambda: F.max(F.when(F.col("is_active") == 1, 1)), distinct="customer_id"),
    "churned": Part(MONTHLY, lambda: F.sum("is_churned")),
    "to_scale": Part(CAMPAIGNS, lambda: known_count(F.col("recommendation") == "SCALE")),
    "to_reduce": Part(CAMPAIGNS, lambda: known_count(F.col("recommendation") == "REDUCE")),
    "issues_raw": Part(CHECKS, lambda: F.sum("raw")),
    "issues_clean": Part(CHECKS, lambda: F.sum("clean")),
    "blocking_clean": Part(CHECKS, lambda: F.sum(F.when(F.col("severity") == "BLOCKING", F.col("clean")))),
    "warning_clean": Part(CHECKS, lambda: F.sum(F.when(F.col("severity") == "WARNING", F.col("clean")))),
    "rows_loaded": Part(COUNTS, lambda: F.sum("clean_rows")),
    "rows_removed": Part(COUNTS, lambda: F.sum("removed")),
}


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a blank counts as 0; blank when both are."""
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def _when_spent(spend: Column, per: Column) -> Column:
    return F.when(spend > 0, ratio(spend, per))


def _growth(now: Column, before: Column) -> Column:
    return ratio(F.coalesce(now, F.lit(0)) - before, before)


_DEFINITIONS = [
    ("total_spend", "Total Spend", MKT, lambda p: p["spend"]),
    ("impressions", "Impressions", MKT, lambda p: p["impressions"]),
    ("clicks", "Clicks", MKT, lambda p: p["clicks"]),
    ("sessions", "Sessions", MKT, lambda p: p["sessions"]),
    ("ctr", "CTR", MKT, lambda p: ratio(p["clicks"], p["impressions"])),
    ("cpc", "CPC", MKT, lambda p: ratio(p["spend"], p["clicks"])),
    ("leads", "Leads", LEADS, lambda p: p["leads"]),
    ("mqls", "MQLs", LEADS, lambda p: p["mqls"]),
    ("sqls", "SQLs", LEADS, lambda p: p["sqls"]),
    ("avg_lead_score", "Avg Lead Score", LEADS, lambda p: ratio(p["score_sum"], p["score_count"])),
    ("opportunities", "Opportunities", OPPS, lambda p: p["opportunities"]),
    ("customers", "Customers", OPPS, lambda p: p["customers"]),
    ("session_to_lead_rate", "Session to Lead %", LEADS, lambda p: ratio(p["leads"], p["sessions"])),
    ("lead_to_mql_rate", "Lead to MQL %", LEADS, lambda p: ratio(p["mqls"], p["leads"])),
    ("mql_to_sql_rate", "MQL to SQL %", LEADS, lambda p: ratio(p["sqls"], p["mqls"])),
    ("sql_to_customer_rate", "SQL to Customer %", LEADS, lambda p: ratio(p["customers"], p["sqls"])),
    ("lead_to_customer_rate", "Lead to Customer %", LEADS, lambda p: ratio(p["customers"], p["leads"])),
    ("cpl", "CPL", MKT, lambda p: _when_spent(p["spend"], p["leads"])),
    ("cac", "CAC", MKT, lambda p: _when_spent(p["spend"], p["customers"])),
    ("revenue_per_spend", "Revenue / Spend", MKT, lambda p: ratio(p["revenue"], p["spend"])),
    ("won_revenue", "Won Revenue", OPPS, lambda p: p["revenue"]),
    ("average_deal_value", "Average Deal Value", OPPS, lambda p: ratio(p["revenue"], p["customers"])),
    ("average_sales_cycle", "Average Sales Cycle", OPPS, lambda p: ratio(p["cycle_sum"], p["cycle_count"])),
    ("win_rate", "Win Rate", OPPS, lambda p: ratio(p["customers"], p["closed"])),
    ("open_pipeline", "Open Pipeline", OPPS, lambda p: p["open_value"]),
    ("lost_value", "Lost Value", OPPS, lambda p: p["lost_value"]),
    ("mrr", "MRR", MONTHLY, lambda p: p["mrr"]),
    ("mrr_end_of_period", "MRR (end of period)", MONTHLY, lambda p: p["mrr_end"]),
    ("active_customers", "Active Customers", MONTHLY, lambda p: p["active"]),
    ("churned_customers", "Churned Customers", MONTHLY, lambda p: p["churned"]),
    ("churn_rate", "Churn Rate", MONTHLY, lambda p: ratio(p["churned"], _plus(p["active"], p["churned"]))),
    ("mom_leads", "MoM Leads %", LEADS, lambda p: _growth(p["leads"], p["leads_before"])),
    ("mom_revenue", "MoM Revenue %", OPPS, lambda p: _growth(p["revenue"], p["revenue_before"])),
    ("issues_found_raw", "Issues Found (raw)", CHECKS, lambda p: p["issues_raw"]),
    ("blocking_errors_left", "Blocking Errors Left", CHECKS, lambda p: p["blocking_clean"]),
    ("documented_warnings", "Documented Warnings", CHECKS, lambda p: p["warning_clean"]),
    ("rows_loaded", "Rows Loaded", COUNTS, lambda p: p["rows_loaded"]),
    ("rows_removed", "Rows Removed", COUNTS, lambda p: p["rows_removed"]),
    ("paid_spend", "Paid Spend", MKT, lambda p: p["paid_spend"]),
    ("paid_cac", "Paid CAC", MKT, lambda p: _when_spent(p["paid_spend"], p["paid_customers"])),
    ("non_paid_revenue_share", "Non-paid Revenue Share", OPPS, lambda p: ratio(p["non_paid_revenue"], p["revenue"])),
    ("share_of_leads", "Share of Leads", LEADS, lambda p: ratio(p["leads"], p["leads_all_channels"])),
    ("share_of_customers", "Share of Customers", OPPS, lambda p: ratio(p["customers"], p["customers_all_channels"])),
    ("arr_run_rate", "ARR Run-rate", MONTHLY, lambda p: p["mrr_end"] * 12),
    ("campaigns_to_scale", "Campaigns to Scale", MKT, lambda p: F.coalesce(p["to_scale"], F.lit(0))),
    ("campaigns_to_reduce", "Campaigns to Reduce", MKT, lambda p: F.coalesce(p["to_reduce"], F.lit(0))),
    ("issues_after_cleaning", "Issues After Cleaning", CHECKS, lambda p: p["issues_clean"]),
]


class _Asked(dict):
    """Stands in for the parts while a formula is read, and notes which ones it asks for."""

    def __init__(self):
        super().__init__()
        self.names: list[str] = []

    def __missing__(self, name: str) -> Column:
        if name not in PARTS:
            raise KeyError(name)
        if name not in self.names:
            self.names.append(name)
        return F.lit(1.0)


MEASURES: dict[str, Measure] = {ident: Measure(label, home, f) for ident, label, home, f in _DEFINITIONS}


def parts_of(ident: str) -> list[str]:
    if ident not in MEASURES:
        raise ValueError(f"unknown measure {ident!r}")
    asked = _Asked()
    MEASURES[ident].formula(asked)
    return asked.names


def check_registry() -> None:
    """Labels are unique, whatever their case."""
    labels = [m.label.lower() for m in MEASURES.values()]
    repeated = {x for x in labels if labels.count(x) > 1}
    if repeated or len(_DEFINITIONS) != len(MEASURES):
        raise ValueError(f"measure names are not unique: {sorted(repeated)}")


def column_label(table: str, column: str) -> str:
    """Name of a column in a report, where names ignore case: one that a measure of its table has too gets another one."""
    taken = {m.label.lower() for m in MEASURES.values() if m.home == table}
    return f"{column}_value" if column.lower() in taken else column


def check_names(columns: dict[str, Sequence[str]]) -> None:
    """No measure is named like a column of its table as reports show it. columns: those of each table."""
    clashes = []
    for table, names in columns.items():
        shown = {column_label(table, c).lower() for c in names}
        clashes += [f"{m.label} in {table}" for m in MEASURES.values() if m.home == table and m.label.lower() in shown]
        if len(shown) != len(names):
            clashes.append(f"columns of {table}")
    if clashes:
        raise ValueError(f"names are used twice: {', '.join(clashes)}")


def reach(table: str) -> dict[str, list[tuple[str, str, str, str]]]:
    """Dimensions a table's rows can be filtered by, each with the relationships that lead there."""
    paths: dict[str, list] = {table: []}
    todo = [table]
    while todo:
        here = todo.pop(0)
        for link in RELATIONSHIPS:
            if link[0] == here and link[2] not in paths:
                paths[link[2]] = [*paths[here], link]
                todo.append(link[2])
    return paths


class UnreachableError(ValueError):
    """A grouping column cannot filter a measure's fact; the result would repeat the total in every row."""


class Evaluator:
    """Evaluates measures over one report model."""

    def __init__(self, model: ReportModel):
        check_registry()
        self.model = model

    def evaluate(
        self,
        measures: Sequence[str],
        by: Sequence[str] = (),
        filters: dict[str, Predicate] | None = None,
    ) -> DataFrame:
        """One row per combination of the ``by`` columns ("Table.column") in which some measure has a value; without
        ``by`` columns, one row.

        ``filters`` (column -> predicate) act on every fact they reach, as slicers do. A ``by`` column has to reach
        every fact of the request. Result columns have the names of the ``by`` columns, with the table in front
        (Table_column) where two of them have one name.
        """
        filters = filters or {}
        for column in filters:
            self._check_column(column)
        needed = list(dict.fromkeys(p for m in measures for p in parts_of(m)))
        short = [c.split(".")[1] for c in by]
        names = [n if short.count(n) == 1 else c.replace(".", "_") for c, n in zip(by, short)]
        facts: dict[str, dict[Context, list[str]]] = {}
        rolled: list[str] = []
        asked = {*by, *filters}
        for p in needed:
            part = PARTS[p]
            only, ignore = part.only, part.ignore
            if only and part.masked and not asked & {c for c, _ in only}:
                only = ()
            if part.whole and not any(c.split(".")[0] == ignore for c in filters):
                rolled.append(p)
                p, ignore = part.whole, None
            if part.months_back and MONTH not in by:
                raise ValueError(f"a change over months needs {MONTH} among the grouping columns")
            reached = reach(part.fact)
            free = lambda c: c.split(".")[0] != ignore and c not in dict(only)  # noqa: B023, E731
            obeys = tuple(c for c in filters if free(c) and c.split(".")[0] in reached)
            context = Context(tuple(c for c in by if free(c)), obeys, only, part.months_back)
            members = facts.setdefault(part.fact, {}).setdefault(context, [])
            if p not in members:
                members.append(p)
        if by and not any(context.kept == tuple(by) for contexts in facts.values() for context in contexts):
            # all parts replace a filter: the rows are the groups that the first of their facts has
            fact = next(iter(facts))
            obeys = tuple(c for c in filters if c.split(".")[0] in reach(fact))
            facts[fact][Context(tuple(by), obeys)] = []

        kept = list(dict.fromkeys([tuple(by), *[c.kept for contexts in facts.values() for c in contexts]]))
        cells = [self._cells(fact, contexts, by, names, kept, filters) for fact, contexts in facts.items()]
        result = self._fold(cells, names, kept)
        for p in rolled:  # over the few rows of the result
            others = [n for c, n in zip(by, names) if c.split(".")[0] != PARTS[p].ignore]
            result = result.withColumn(p, F.sum(PARTS[p].whole).over(Window.partitionBy(*others)))
        values = {p: PARTS[p].finish(F.col(p)) for p in needed}
        result = result.select(*names, *[MEASURES[m].formula(values).alias(f"{m}") for m in measures])
        return result.where(_any_value(measures)) if by else result

    def _check_column(self, column: str) -> None:
        table, name = column.split(".")
        if table not in self.model.names or name not in self.model[table].columns:
            raise ValueError(f"no column {column!r} in the model")

    def _cells(
        self,
        fact: str,
        contexts: dict[Context, list[str]],
        by: Sequence[str],
        names: list[str],
        kept: list[tuple[str, ...]],
        filters: dict[str, Predicate],
    ) -> DataFrame:
        """All parts of one fact in all their contexts: the grouping columns, SET (which of them are kept) and the parts.

        The fact is read once. A condition that all contexts share is applied to its rows, others to the rows of the base.
        """
        paths = reach(fact)
        for column in [c for context in contexts for c in context.kept]:
            self._check_column(column)
            if column.split(".")[0] not in paths:
                raise UnreachableError(f"{column} does not filter {fact}")
        members = list(dict.fromkeys(p for parts in contexts.values() for p in parts))
        masks = {p: PARTS[p].only for c, parts in contexts.items() for p in parts if PARTS[p].only and not c.sets}
        shifted = any(c.back for c in contexts)
        sets = [c for context in contexts for c, _ in context.sets]
        extra = [c for only in masks.values() for c, _ in only]
        used = list(dict.fromkeys([*by, *[c for context in contexts for c in context.obeys], *sets, *extra]))
        frame = self._joined(fact, paths, [c for c in used if c.split(".")[0] in paths], shifted)

        at = lambda context, c: _flat(c, context.back and c.startswith("DimDate."))
        tests = {
            context: {
                **{at(context, c): filters[c](F.col(at(context, c))) for c in context.obeys},
                **{f"{_flat(c)}={v}": F.col(_flat(c)) == v for c, v in context.sets},
                **({"in calendar": F.col(at(context, MONTH)).isNotNull()} if context.back else {}),
            }
            for context in contexts
        }
        common = [k for k in next(iter(tests.values())) if all(k in t for t in tests.values())]
        for k in common:
            frame = frame.where(next(iter(tests.values()))[k])
        late = {context: [t for k, t in found.items() if k not in common] for context, found in tests.items()}
        days = {c: [t for k, t in found.items() if k not in common and "DimDate__" in k] for c, found in tests.items()}
        for each in (days, late):  # what no context wants; conditions on the calendar alone leave out months
            if len(contexts) > 1 and all(each.values()):
                frame = frame.where(reduce(or_, [reduce(and_, found) for found in each.values()]))

        mask = lambda p: reduce(and_, [F.col(_flat(c)) == v for c, v in masks[p]])
        aggregates = {p: (PARTS[p].masked(mask(p)) if p in masks else PARTS[p].aggregate()).alias(p) for p in members}
        if len(contexts) == 1:
            context = next(iter(contexts))
            keys = {n: F.col(at(context, c)) for c, n in zip(by, names) if c in context.kept}
            where = F.lit(kept.index(context.kept))
            return _added(_based(frame, keys, aggregates), list(keys), members).select(
                where.alias(SET), *[F.col(n) if n in keys else F.lit(None).alias(n) for n in names], *members
            )
        keys = {at(context, c): F.col(at(context, c)) for context in contexts for c in (*context.kept, *context.obeys)}
        keys |= {_flat(c): F.col(_flat(c)) for c in sets} | ({_flat(MONTH, True): F.col(_flat(MONTH, True))} if shifted else {})
        base = _based(frame, keys, aggregates)
        kinds = dict(base.dtypes)
        aside = [c for c in (PERIOD, MEMBER) if c in kinds]
        nothing = lambda kind: F.lit(None).cast(kind)
        dealt = []
        for context, parts in contexts.items():
            places = [
                (F.col(at(context, c)) if c in context.kept else nothing(kinds[_flat(c)]) if _flat(c) in kinds else F.lit(None)).alias(n)
                for c, n in zip(by, names)
            ]
            values = [(F.col(p) if p in parts else nothing(kinds[p])).alias(p) for p in members]
            row = F.struct(F.lit(kept.index(context.kept)).alias(SET), *places, *aside, *values)
            dealt.append(F.when(reduce(and_, late[context], F.lit(True)), row))
        rows = base.select(F.inline(F.filter(F.array(*dealt), lambda r: r.isNotNull())))
        sums = [(F.max(p) if PARTS[p].distinct else F.sum(p)).alias(p) for p in members]
        if aside:
            rows = rows.groupBy(SET, *names, *aside).agg(*sums)
        return _added(rows, [SET, *names], members)

    def _joined(self, fact: str, paths: dict, used: list[str], shifted: bool) -> DataFrame:
        """The fact with the dimension columns asked for, as Table__column. Only needed dimensions are joined. The calendar is
        joined on the day and on the month that facts are stored by; ``shifted`` adds its columns for the month after."""
        tables = list(dict.fromkeys(c.split(".")[0] for c in used))
        links = list(dict.fromkeys(link for t in tables for link in paths[t]))
        frame = self.model[fact]
        if any(table == fact and dimension == "DimDate" for table, _, dimension, _ in links):
            stored = self.model.by_month(fact)
            frame = frame if stored is None else stored
        by_month = STORED_BY in frame.columns
        own = [c.split(".")[1] for c in used if c.startswith(f"{fact}.")]
        frame = frame.withColumns({_flat(f"{fact}.{c}"): F.col(c) for c in own}) if own else frame
        for table, column, dimension, key in links:
            wanted = {c.split(".")[1] for c in used if c.startswith(f"{dimension}.")}
            onward = {link[1] for link in links if link[0] == dimension}
            source = F.col(column) if table == fact else F.col(_flat(f"{table}.{column}"))
            right = self.model[dimension]
            columns = {c: F.col(c).alias(_flat(f"{dimension}.{c}")) for c in wanted | onward}
            if dimension != "DimDate":
                right = right.select(F.col(key).alias("_key"), *columns.values())
                frame = frame.join(right, source == F.col("_key"), "left").drop("_key")
                continue
            right = right.select(
                F.col(key).alias("_key"), month_of(key).alias("_month"), F.col("year_month").alias("_now"), *columns.values()
            )
            if shifted:
                right = right.join(self._months(wanted), "_now", "left")
            same = source == F.col("_key")
            if by_month and table == fact:
                same &= F.col(STORED_BY) == F.col("_month")
            frame = frame.join(right, same, "left").drop("_key", "_month", "_now")
        return frame

    def _months(self, wanted: set[str]) -> DataFrame:
        """For each month that has one after it in the calendar (_now), the columns of that next month."""
        finer = wanted - {"year_month", "year", "quarter", "month", "month_name"}
        if finer:
            raise ValueError(f"a change over months cannot be split by {sorted(finer)}")
        before = F.date_format(F.add_months(F.to_date("year_month", "yyyy-MM"), -1), "yyyy-MM").alias("_now")
        columns = [F.col(c).alias(_flat(f"DimDate.{c}", True)) for c in sorted(wanted | {"year_month"})]
        return self.model["DimDate"].select(before, *columns).distinct()

    @staticmethod
    def _fold(cells: list[DataFrame], names: list[str], kept: list[tuple[str, ...]]) -> DataFrame:
        """The cells of all facts, a row per group; a blank member is a group like any other. What was found for fewer
        grouping columns is spread over the groups that have these values."""
        if len(cells) == 1 and len(kept) == 1 and names:
            return cells[0]
        columns = {c: t for frame in cells for c, t in frame.dtypes if c != SET and c not in names}
        kinds = {c: t for frame in cells for c, t in frame.dtypes if c in names and t != "void"}
        wide = [
            frame.select(
                SET,
                *[F.col(n).cast(kinds[n]).alias(n) if n in kinds else n for n in names],
                *[F.col(p) if p in frame.columns else F.lit(None).cast(t).alias(p) for p, t in columns.items()],
            )
            for frame in cells
        ]
        result = union_all(wide).groupBy(*([SET, *names] if names else [])).agg(*[F.max(p).alias(p) for p in columns])
        if not names or len(kept) == 1:
            return result
        for number, fewer in enumerate(kept):
            if number:
                own = [n for n, c in zip(names, kept[0]) if c in fewer]
                spread = {p: F.max(F.when(F.col(SET) == number, F.col(p))).over(Window.partitionBy(*own)) for p in columns}
                result = result.withColumns({p: F.coalesce(F.col(p), x) for p, x in spread.items()})
        return result.where(F.col(SET) == 0)


def _based(frame: DataFrame, keys: dict[str, Column], aggregates: dict[str, Column]) -> DataFrame:
    """Parts by the keys; by the period too where a part is that of the last one, and once more by member where members are
    counted. Both come from one pass over the rows."""
    periods = {PARTS[p].last_by for p in aggregates if PARTS[p].last_by}
    counted = {PARTS[p].distinct for p in aggregates if PARTS[p].distinct}
    if len(periods) > 1 or len(counted) > 1:
        raise ValueError(f"parts of one fact differ in {sorted(periods | counted)}")
    frame = frame.withColumns(keys) if keys else frame
    sums = [a for p, a in aggregates.items() if not PARTS[p].distinct]
    flags = [a for p, a in aggregates.items() if PARTS[p].distinct]
    if not counted:
        return frame.groupBy(*keys, *[F.col(c).alias(PERIOD) for c in periods]).agg(*(sums or [F.lit(None).alias("_none")]))
    one = [F.col(c).alias(MEMBER) for c in counted]
    if not sums:
        return frame.groupBy(*keys, *one).agg(*flags)
    frame = frame.withColumns({MEMBER: F.col(*counted), **({PERIOD: F.col(*periods)} if periods else {})})
    rest = [PERIOD] if periods else []
    by_member = F.grouping(MEMBER) == 0
    return frame.groupingSets([[*keys, *rest], [*keys, MEMBER]], *keys, *rest, MEMBER).agg(
        *[F.when(~by_member, a).alias(p) for p, a in aggregates.items() if not PARTS[p].distinct],
        *[F.when(by_member & F.col(MEMBER).isNotNull(), a).alias(p) for p, a in aggregates.items() if PARTS[p].distinct],
    )


def _added(base: DataFrame, keys: list[str], members: list[str]) -> DataFrame:
    """Rows of a base added up by the keys: the last period of some parts, the number of members of others."""
    if not {PERIOD, MEMBER} & {*base.columns}:
        if SET in keys:
            return base.groupBy(*keys).agg(*([F.sum(p).alias(p) for p in members] or [F.lit(None).alias("_none")]))
        return base

    def value(p: str) -> Column:
        if PARTS[p].distinct:
            return F.nullif(F.count_if(F.col(p) == 1), F.lit(0))
        return F.max_by(p, PERIOD) if PARTS[p].last_by else F.sum(p)

    return base.groupBy(*keys).agg(*[value(p).alias(p) for p in members])


def _any_value(measures: Sequence[str]) -> Column:
    return reduce(or_, [F.col(m).isNotNull() for m in measures])


def _flat(column: str, after: bool | int = False) -> str:
    return ("after__" if after else "") + column.replace(".", "__")
