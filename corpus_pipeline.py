"""Stages that turn raw documents into packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next one's
docs. All but the last return the columns of `documents`, extra ones included. Missing doc_ids, missing and empty texts and
repeated rows are handled as the operators say; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.llm import decontaminate, language, lines, neardup, packing
from funnelworks.llm.shared import LAST, stored, table

#: Below this score no learned language fits a text.
LEAST_SURE = 0.1
#: Near-duplicates share 0.8 of their distinct runs of five words.
SHINGLE = 5


def carried(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """doc_id, text and lang, and all columns but the text under names that no operator uses; the names of all columns."""
    names = ["text" if c == "text" else f"_column_{i}" for i, c in enumerate(docs.columns)]
    others = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names) if n != "text"]
    return docs.select("doc_id", "text", "lang", *others), names


def restored(df: DataFrame, docs: DataFrame, names: list[str], **changed) -> DataFrame:
    """The columns of docs again, those in `changed` with new values."""
    kinds = dict(docs.dtypes)
    return df.select(*[(changed[c] if c in changed else F.col(n)).cast(kinds[c]).alias(c) for c, n in zip(docs.columns, names)])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_doc": F.coalesce("doc_id", F.lit(LAST)), "_row_key": F.xxhash64("text")})


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter, and those that no learned language fits, go. Without a language to learn, all that have
    a letter stay."""
    rows, names = carried(docs)
    model = language.fit(rows)
    if not model.languages:
        return restored(rows.where(F.col("text").rlike(r"\p{L}")), docs, names)
    found = language.identify(rows, model, names)
    return restored(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SURE)), docs, names)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of like lines stays in the corpus; documents that lose all their text go."""
    rows, names = carried(docs)
    found = lines.remove_lines(rows, [n for n in names if n != "text"])
    found = found.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"\S"))
    return restored(found, docs, names, text=F.col("kept_text"), n_chars=F.length("kept_text"))


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; repeated rows of one doc_id and text are one."""
    stays = neardup.groups(docs, size=SHINGLE).where("stays")
    stays = stays.select(F.col("doc").alias("_doc"), F.col("row_key").alias("_row_key")).distinct()
    kept = keyed(docs).join(stays, ["_doc", "_row_key"]).dropDuplicates(["_doc", "_row_key"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    found = decontaminate.contained(docs, table(spark, sf_dir, "benchmark"))
    found = found.select(F.coalesce("doc_id", F.lit(LAST)).alias("_doc"), F.col("row_key").alias("_row_key")).distinct()
    return keyed(docs).join(found, ["_doc", "_row_key"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in the training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("language", detect_language),
    ("line dedup", deduplicate_lines),
    ("minhash dedup", deduplicate_documents),
    ("decontamination", decontaminate_documents),
    ("packing", pack_sequences),
]
#: SQL has no form of the language model, of fuzzy lines or of packing; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
