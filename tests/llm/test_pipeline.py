"""The stages, one after the other, each against what its operator promises on its own input."""

from __future__ import annotations

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import SMALL, corpus, nothing  # noqa: F401 - fixtures

from funnelworks.llm import decontaminate, language, neardup
from funnelworks.llm.shared import held_out, stored


@pytest.fixture(scope="module")
def steps(spark, corpus):
    _, docs = corpus
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), "test"))
    return out


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_language_stage_keeps_all_that_can_be_read(steps):
    before, after = steps[0], steps[1]
    rejected = before.where(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).count()
    assert after.count() == before.count() - rejected
    assert set(language.fit(before).languages) <= {"en", "de", "fr", "es"}


def test_language_stage_without_a_language_to_learn(spark, corpus):
    _, docs = corpus
    letters = docs.where(F.col("text").rlike(r"\p{L}")).count()
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    only_held_out = docs.withColumn("lang", F.when(F.coalesce(held_out(), F.lit(True)), F.col("lang")))
    for given in (unknown, only_held_out):
        after = pipeline.detect_language(spark, given, SMALL)
        assert after.count() == letters and after.dtypes == given.dtypes
    assert letters < docs.count()


def test_line_stage(steps):
    before, after = steps[1], steps[2]
    assert after.count() <= before.count()
    assert after.where("n_chars <> length(text) OR NOT text RLIKE '\\\\S'").count() == 0
    longest = after.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    assert longest.join(before.groupBy("doc_id").agg(F.max(F.length("text")).alias("m")), "doc_id").where("n > m").count() == 0


def test_near_copy_stage_leaves_one_of_each_group(steps):
    before, after = steps[2], steps[3]
    assert after.count() == before.select("doc_id", "text").distinct().count() - _surplus(before)
    again = neardup.groups(after, pipeline.SHINGLE)
    assert again.where("NOT stays").count() == 0


def _surplus(df):
    distinct = df.select("doc_id", "text").distinct()
    return neardup.groups(distinct, pipeline.SHINGLE).where("NOT stays").count()


def test_decontamination_stage(spark, steps):
    before, after = steps[3], steps[4]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    leaks = decontaminate.contained(before, items).select("doc_id").distinct().count()
    assert leaks > 0 and after.count() == before.count() - leaks
    assert decontaminate.contained(after, items).count() == 0


def test_packing_stage(steps):
    pieces = steps[5]
    assert pieces.select("doc_id").distinct().count() == steps[4].select("doc_id").distinct().count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_empty_table(spark, nothing):
    docs = nothing
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "test-empty")
        assert docs.count() == 0


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    queries = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in queries} and "pipeline" in queries
    assert queries["pipeline"](spark, SMALL).count() > 100
