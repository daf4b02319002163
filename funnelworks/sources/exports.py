"""CSV deliveries: raw exports, reference data, and what is written for others to read."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import REGION_SYNONYMS
from ..model import Exports, Reference, Tables
from ..functions.numeric import n_rows
from ..operators.dedupe import POSITION
from ..operators.rows import union_all
from ..plans.model import ReportModel
from ..plans.views import Views
from ..schemas import EXPORT_FILES, EXPORT_SCHEMAS, REFERENCE_SCHEMAS, STAR_SCHEMAS

VIEW_NAMES = [
    "channel_performance",
    "campaign_performance",
    "monthly_management",
    "funnel",
    "opportunity_detail",
    "customer_value",
]
SAMPLE_ROWS = 200
CORRUPT = "_corrupt"
#: How text is quoted in deliveries: quotes within quotes are doubled, empty text is missing.
QUOTING = {"quote": '"', "escape": '"', "nullValue": ""}


def _typed(name: str, kind: str) -> Column:
    """Text to its type; text that does not fit is NULL. Whole numbers may be written as 1.0."""
    c = F.col(name)
    if kind == "string":
        return c
    if kind in ("int", "bigint"):
        return c.try_cast("decimal(38,6)").try_cast(kind).alias(name)
    return c.try_cast(kind).alias(name)


def read_csv(spark: SparkSession, path: str, columns: dict[str, str], multi_line: bool = False) -> DataFrame:
    """The given columns of a CSV file (or folder of parts), as text, and CORRUPT.

    Columns are found by their names in the header, whatever their order and whatever else there is; a missing one is an
    error. A quote within quotes is doubled; empty text is NULL. Line breaks within quotes need ``multi_line``. CORRUPT is
    the text of a row that does not fit the header, else NULL.
    """
    if multi_line:
        return broken_csv(spark, path, columns).drop(POSITION)
    text = _header(spark, path, columns)
    strict = {"enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.schema(text).options(header=True, **QUOTING, **strict).csv(path)


def _header(spark: SparkSession, path: str, columns: dict[str, str]) -> str:
    """The columns of the files and CORRUPT, all text, as a schema."""
    found = spark.read.options(header=True, **QUOTING).csv(path).columns
    lacking = [c for c in columns if c not in found]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    return ", ".join(f"`{c}` string" for c in [*found, CORRUPT])


def broken_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """All columns of CSV files whose quoted text may hold line breaks, as text, CORRUPT and POSITION, read in splits.

    A line begins a row if the quotes before it are even in number. Lines are read in splits; each split's quotes are counted,
    a prefix sum over the splits of a file (a small table) tells whether a split begins within quotes, and within
    a split a running count does the same for its lines. The lines of a row, which may lie in two splits, are joined by the
    place of its first line. The header has no line break; a quote that is never closed makes one row of what follows it.
    """
    text = _header(spark, path, columns)
    place = ["_file", "_block"]
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        (F.length(F.regexp_replace("value", '[^"]', "")) % 2).alias("_odd"),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    running = Window.partitionBy(*place).orderBy("_row")
    before = running.rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*place).agg(F.sum("_odd").alias("_sum")).withColumn("_open", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    lines = lines.join(splits.drop("_sum"), place).withColumn(
        "_begins", (F.col("_open") + F.coalesce(F.sum("_odd").over(before), F.lit(0))) % 2 == 0
    )
    begun = F.when(F.col("_begins"), F.struct("_block", "_row"))
    lines = lines.withColumn("_first", F.last(begun, ignorenulls=True).over(running.rowsBetween(Window.unboundedPreceding, 0)))
    # where a split begins within a row, that row is the last one begun in the splits before
    ends = lines.groupBy(*place).agg(F.max(begun).alias("_last"))
    ends = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")
    lines = lines.join(ends, place).withColumn("_first", F.coalesce("_first", "_carried"))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_row", "value")))
    rows = lines.groupBy("_file", "_first").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("_text"))
    # the first row of each file is its header
    head = lines.groupBy("_file").agg(F.min("_first").alias("_head"))
    rows = rows.join(head, "_file").where("_first > _head AND _text <> ''")
    position = F.struct(F.col("_file").alias("file"), F.col("_first._block").alias("block"), F.col("_first._row").alias("row"))
    parsed = F.from_csv("_text", text, {**QUOTING, "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("_csv"), position.alias(POSITION)).select("_csv.*", POSITION)


def corrupt_rows(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """(export, rows, corrupt): rows of each delivered file, and how many of them do not fit its header."""
    # a row is known to fit only when all its columns are read
    whole = lambda name: F.concat_ws("", CORRUPT, *EXPORT_SCHEMAS[name])
    counts = [
        read_csv(spark, f"{folder}/{file}", EXPORT_SCHEMAS[name], multi_line).agg(
            F.lit(name).alias("export"), n_rows().alias("rows"), F.count(F.when(F.col(CORRUPT).isNotNull(), whole(name))).alias("corrupt")
        )
        for name, file in EXPORT_FILES.items()
    ]
    return union_all(counts)


def read_export(spark: SparkSession, path: str, columns: dict[str, str], multi_line: bool = False) -> DataFrame:
    """A raw export with the position of each row.

    Position is (file, offset of the split, row within the split). It orders rows as the files do, whatever way Spark
    packs splits into tasks, and it is taken at the scan, before any shuffle.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    if multi_line:
        rows = broken_csv(spark, path, columns).select(*columns, POSITION)
    else:
        rows = read_csv(spark, path, columns).select(*columns, position.alias(POSITION))
    return rows.select(*[_typed(c, kind) for c, kind in columns.items()], POSITION)


def read_exports(spark: SparkSession, folder: str, multi_line: bool = False) -> Exports:
    return Exports(
        {
            name: partial(read_export, spark, f"{folder}/{EXPORT_FILES[name]}", columns, multi_line)
            for name, columns in EXPORT_SCHEMAS.items()
        }
    )


def read_reference(
    spark: SparkSession, folder: str, synonyms: dict[str, str] | None = None
) -> Reference:
    spellings = REGION_SYNONYMS if synonyms is None else synonyms

    def table(name: str) -> DataFrame:
        columns = REFERENCE_SCHEMAS[name]
        return read_csv(spark, f"{folder}/{name}.csv", columns).select(*[_typed(c, k) for c, k in columns.items()])

    def region_synonyms() -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("name")) for a, b in spellings.items()])
        return spark.range(1).select(F.inline(pairs))

    return Reference({**{n: partial(table, n) for n in REFERENCE_SCHEMAS}, "synonyms": region_synonyms})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Blanks around a label are data here, so the writer must not trim them; quotes are doubled."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("errorifexists").options(header=True, quote='"', escape='"', **spaces).csv(path)


def write_export(exports: Exports, name: str, folder: str) -> None:
    """A raw export as CSV parts in ingest order, so that reading it back gives the same positions."""
    write_csv(exports[name].orderBy(POSITION).drop(POSITION), f"{folder}/{EXPORT_FILES[name]}")


def write_exports(exports: Exports, folder: str) -> None:
    for name in Exports.names:
        write_export(exports, name, folder)


def write_reference(reference: Reference, folder: str) -> None:
    """Reference data as CSV, one table per file name; synonyms are not a file."""
    for name in REFERENCE_SCHEMAS:
        write_csv(reference[name], f"{folder}/{name}.csv")


def sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows of an export in ingest order."""
    return df.orderBy(POSITION).limit(rows).drop(POSITION)


def write_sample(exports: Exports, name: str, folder: str) -> None:
    write_csv(sample(exports[name]).coalesce(1), f"{folder}/sample_{EXPORT_FILES[name]}")


def write_samples(exports: Exports, folder: str) -> None:
    for name in Exports.names:
        write_sample(exports, name, folder)


def read_sample(spark: SparkSession, folder: str, name: str) -> DataFrame:
    columns = EXPORT_SCHEMAS[name]
    rows = read_csv(spark, f"{folder}/sample_{EXPORT_FILES[name]}", columns)
    return rows.select(*[_typed(c, kind) for c, kind in columns.items()])


def write_views(views: Views, folder: str) -> None:
    for name in VIEW_NAMES:
        write_csv(getattr(views, name), f"{folder}/{name}")


def read_view(spark: SparkSession, folder: str, name: str, kinds: dict[str, str]) -> DataFrame:
    """An exported view, typed."""
    return read_csv(spark, f"{folder}/{name}", kinds).select(*[_typed(c, k) for c, k in kinds.items()])


def write_model(model: ReportModel, folder: str) -> None:
    for name in ReportModel.names:
        write_csv(model[name], f"{folder}/{name}")


def read_model(spark: SparkSession, folder: str) -> Tables:
    """The exported report tables, typed: what a report tool does on import."""
    star = {
        "DimDate": STAR_SCHEMAS["dim_date"],
        "DimChannel": {**STAR_SCHEMAS["dim_channel"], "sort_order": "int"},
        "DimCampaign": {**STAR_SCHEMAS["dim_campaign"], "recommendation": "string"},
        "DimRegion": STAR_SCHEMAS["dim_region"],
        "DimCustomer": {c: k for c, k in STAR_SCHEMAS["dim_customer"].items() if c != "lead_id"},
        "FactMarketingDaily": STAR_SCHEMAS["fact_marketing_daily"],
        "FactLeads": {**STAR_SCHEMAS["fact_leads"], "score_band": "string"},
        "FactOpportunities": {**STAR_SCHEMAS["fact_opportunities"], "revenue_date_key": "int"},
        "FactCustomerMonthly": STAR_SCHEMAS["fact_customer_monthly"],
        "DataQualityChecks": {
            "check_id": "string", "table": "string", "description": "string", "severity": "string",
            "raw": "bigint", "clean": "bigint",
        },
        "DataQualityRowCounts": {"table": "string", "raw_rows": "bigint", "clean_rows": "bigint", "removed": "bigint"},
        "CleaningLog": {"rule": "string", "table": "string", "rows_affected": "bigint", "action": "string"},
    }

    def load(name: str) -> DataFrame:
        return read_csv(spark, f"{folder}/{name}", star[name]).select(*[_typed(c, k) for c, k in star[name].items()])

    return ReportModel({n: partial(load, n) for n in ReportModel.names})


def write_json(one_row: DataFrame, path: str) -> None:
    one_row.coalesce(1).write.mode("errorifexists").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, each of which may span lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
