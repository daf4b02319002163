"""General operators against brute force, with hot keys."""

from __future__ import annotations

import random
import statistics
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelworks.functions.labels import norm, score_band
from funnelworks.functions.numeric import ratio, rounded
from funnelworks.operators import dedupe
from funnelworks.operators.dedupe import collapse_exact, keep_first, surplus_rows
from funnelworks.operators.lookup import label_map, map_label, mark_listed
from funnelworks.operators.median import twice_median

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def exact_medians(values):
    groups = {}
    for k, v in values:
        if k is not None and v is not None:
            groups.setdefault(k, []).append(v)
    return {k: statistics.median(v) * 2 for k, v in groups.items()}


def test_median_with_a_hot_key_and_heavy_tail(spark):
    rnd = random.Random(5)
    data = [("hot", Decimal(rnd.randrange(1, 10**9)).scaleb(-2)) for _ in range(3000)]
    data += [("hot", Decimal("7.00"))] * 1500
    data += [(f"k{i % 7}", Decimal(rnd.randrange(0, 500)).scaleb(-2)) for i in range(700)]
    data += [(None, Decimal("1.00")), ("k1", None), ("single", Decimal("3.33"))]
    got = twice_median(spark.createDataFrame(data, "k string, v decimal(18,2)"), "k", "v")
    assert {r["k"]: r["twice_median"] for r in rows(got)} == exact_medians(data)


@quick
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-3000, 3000)), min_size=1, max_size=40))
def test_median_equals_brute_force(spark, values):
    got = twice_median(spark.createDataFrame(values, "k string, v bigint"), "k", "v")
    assert {r["k"]: r["twice_median"] for r in rows(got)} == exact_medians(values)


def test_median_of_a_hot_key_is_not_one_task_of_values(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("k"), (F.col("id") * 37 % 49_999).alias("v"))
    plan = twice_median(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_" not in plan and "median(" not in plan


def test_keep_first_and_counts(spark):
    data = [(i % 5 if i % 3 else 0, f"v{i}", i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, v string, _pos bigint").repartition(7)
    first = {}
    for k, v, p in data:
        first.setdefault(k, (v, p))
    got = {r["k"]: (r["v"], r["_pos"], r["_copies"]) for r in rows(keep_first(df, ["k"]))}
    assert got == {k: (*vp, sum(d[0] == k for d in data)) for k, vp in first.items()}
    assert surplus_rows(df, ["k"]).first()["n"] == 300 - 5


def test_exact_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 1, 1), (None, 2, 2), ("a", 1, 3)], "a string, b int, _pos bigint")
    got = rows(collapse_exact(df), "_pos")
    assert [(r["_pos"], r["_copies"]) for r in got] == [(0, 2), (2, 1), (3, 1)]


def test_labels(spark):
    df = spark.createDataFrame(
        [("  Google  ADS ",), ("google\tads",), (None,), ("",)], "label string"
    ).select(norm("label").alias("n"))
    assert [r["n"] for r in df.collect()] == ["google ads", "google ads", None, ""]


def test_lookup_does_not_multiply_rows(spark):
    ref = spark.createDataFrame([(1, "Paid"), (2, "PAID ")], "id int, name string")
    df = spark.createDataFrame([("paid",), ("PAID ",), ("x",), (None,)], "label string")
    mapped = mark_listed(map_label(df, "label", label_map(ref, "name", "id"), "i"), "label", ref, "name", "listed")
    got = {r["label"]: (r["i"], r["listed"]) for r in rows(mapped)}
    assert len(rows(mapped)) == 4
    assert got == {"paid": (2, False), "PAID ": (2, True), "x": (None, False), None: (None, False)}


def test_numbers(spark):
    r = spark.range(1).select(
        rounded(F.lit(2.345), 2).alias("a"),
        rounded(F.lit(-2.5), 0).alias("b"),
        rounded(F.lit(None).cast("double"), 1).alias("c"),
        ratio(F.lit(1), F.lit(0)).alias("d"),
        ratio(F.lit(1), F.lit(4)).alias("e"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (2.35, -3.0, None, None, 0.25)


def test_score_bands(spark):
    df = spark.createDataFrame([(s,) for s in (None, 0, 39, 40, 59, 60, 79, 80, 100)], "s int")
    bands = [r["b"] for r in df.select(score_band("s").alias("b")).collect()]
    assert bands == ["Unknown", "0-39", "0-39", "40-59", "40-59", "60-79", "60-79", "80-100", "80-100"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_with_positions_of_any_type_and_null_keys(spark):
    """A key with a third of the rows, NULL keys, and positions of fixed and of variable width."""
    data = [(None if i % 9 == 4 else 0 if i % 3 else i, "k" if i % 2 else None, f"v{i}", (i * 7919) % 1009) for i in range(900)]
    best, count = {}, {}
    for a, b, v, p in data:
        count[a, b] = count.get((a, b), 0) + 1
        if (a, b) not in best or p < best[a, b][0]:
            best[a, b] = (p, v)
    want = {k: (v, count[k]) for k, (_, v) in best.items()}
    df = spark.createDataFrame(data, "a int, b string, v string, p bigint").repartition(5)
    pos = F.format_string("%06d", "p")
    for position in (F.col("p"), F.col("p").cast("decimal(38,0)"), pos, F.struct(pos.alias("x"), "p")):
        got = keep_first(df.withColumn("_pos", position).drop("p"), ["a", "b"])
        assert {(r["a"], r["b"]): (r["v"], r["_copies"]) for r in rows(got)} == want
    assert keep_first(df.withColumnRenamed("p", "_pos").limit(0), ["a"]).count() == 0


def test_keep_first_neither_sorts_nor_shuffles_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id % 990 AS k", "cast(id AS string) AS v", "id AS _pos").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(keep_first(df, ["k"]))
    assert "BroadcastHashJoin" in plan and "SortAggregate" not in plan and "hashpartitioning" not in plan
    found = plan_of(dedupe._repeats(df, ["k"], "_pos"))
    assert "HashAggregate" in found and "SortAggregate" not in found and "Sort " not in found
    wide = plan_of(dedupe._repeats(df.withColumn("_pos", F.struct("v", "_pos")), ["k"], "_pos"))
    assert "SortAggregate" not in wide
    assert "SortAggregate" not in plan_of(collapse_exact(df))
