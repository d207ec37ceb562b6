"""Vocabularies that no task and no driver holds: ranks over text, sparse rows against a vocabulary table."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.operators import assemble, report, static as St
from cohortframe.operators.running import ranked
from cohortframe.plans import offset_icu
from tests.test_plans import SMALL, offset  # noqa: F401

MANY = 150_000


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_over_text_both_ways(spark, by):
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("code"), (F.col("id") % 3).cast("string").alias("g"))
    df = df.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("code"), F.lit("0").alias("g")))
    one = {tuple(r) for r in ranked(df, ["code"], by).select("g", "code", "rank").collect()}
    dealt = ranked(df, ["code"], by, task_rows=100)
    assert {tuple(r) for r in dealt.select("g", "code", "rank").collect()} == one and dealt.schema["rank"].dataType.simpleString() == "int"
    down = {tuple(r) for r in ranked(df, [F.desc("code")], by, task_rows=100).select("g", "code", "rank").collect()}
    size = {g: sum(1 for x in one if not by or x[0] == g) for g in "012"}
    assert down == {(g, c, size[g] + 1 - r) for g, c, r in one}


def test_ranks_without_a_window(spark, monkeypatch):
    from cohortframe.operators import running

    monkeypatch.setattr(running.ranked, "__defaults__", ((), "rank", 1000))
    counts = spark.range(MANY).select(F.concat(F.lit("c"), "id").alias("code"), (F.col("id") % 977).alias("n"))
    places = report.code_frequency(counts)
    assert "Window" not in places._jdf.queryExecution().executedPlan().toString()
    rows = places.where("rank <= 3 or rank = 150000").orderBy("rank").collect()
    assert [(r.rank, r.n) for r in rows] == [(1, 976), (2, 976), (3, 976), (MANY, 0)]
    assert places.select("rank").distinct().count() == MANY
    levels = St.level_vocabulary(spark.range(MANY).selectExpr("concat('l', id) AS a", "id % 7 AS b"), ["a", "b"])
    assert [tuple(r) for r in levels.groupBy("column").agg(F.max("level_rank"), F.countDistinct("level_rank")).orderBy("column").collect()] == [
        ("a", MANY, MANY), ("b", 7, 7)
    ]


@pytest.fixture
def most_collected(spark, monkeypatch):
    """The largest result that came to the driver."""
    kind = type(spark.range(1))
    most, real = [0], kind.collect

    def collect(self):
        rows = real(self)
        most[0] = max(most[0], len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    return most


def test_sparse_rows_hold_no_vocabulary(spark, most_collected):
    """More features than may be broadcast: the vocabulary is joined, and a row costs its observed cells."""
    stays = spark.range(50).select(F.col("id").alias("stay_id"))
    cells = spark.range(MANY).select(
        (F.col("id") % 50).alias("stay_id"), (F.col("id") % 3).cast("int").alias("window"), F.format_string("f%07d", "id").alias("feature"),
        F.col("id").cast("double").alias("value"),
    )
    vocab = cells.select("feature").distinct().selectExpr("feature", "0 AS block", "0 AS position")
    static = St.numeric_vocabulary(spark, ["age"])
    places = session.small(assemble.sparse_vocabulary(assemble.feature_structure(vocab, static)))
    ages = stays.select("stay_id", F.lit("age").alias("feature"), F.lit(7.0).alias("value"))
    rows = assemble.sparse_rows(stays, places, cells, ages)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan
    sums = rows.select(
        "stay_id", F.size("steps").alias("steps"), F.expr("aggregate(steps, 0, (a, s) -> a + size(s.indices))").alias("n"),
        F.expr("aggregate(steps, true, (a, s) -> a AND forall(zip_with(s.indices, s.values, (i, v) -> i = v), x -> x))").alias("right"),
        F.expr("forall(steps, s -> s.indices = array_sort(s.indices))").alias("sorted"), "static",
    )
    assert [(r.steps, r.n, r.right, r.sorted, tuple(r.static.indices), tuple(r.static["values"])) for r in sums.collect()] == [
        (3, MANY // 50, True, True, (MANY,), (7.0,))
    ] * 50
    assert most_collected[0] <= 64


def test_sparse_plan_equals_dense(spark, offset):  # noqa: F811
    dense = offset_icu.prepare(**offset, params=SMALL)
    sparse = offset_icu.prepare(**offset, params=dataclasses.replace(SMALL, layout="sparse"))
    levels = St.level_vocabulary(offset["patient"], ["gender", "ethnicity", "unitstaytype"])
    again = assemble.densify(sparse["rows"], sparse["feature_vocab"], SMALL.windows.num_windows, levels)
    names = ["stay_id", "split", "duration", "event"]
    a, b = ({r.stay_id: r for r in df.select(*names, "x", "mask").collect()} for df in (dense["rows"], again))
    assert a == b
    assert [tuple(r) for r in dense["feature_vocab"].orderBy("idx").collect()] == [
        tuple(r) for r in sparse["feature_vocab"].select("feature", "kind", "idx").orderBy("idx").collect()
    ]
    assert dense["run_info"].drop("x").collect() == sparse["run_info"].collect()
    with pytest.raises(ValueError):
        offset_icu.prepare(**offset, params=dataclasses.replace(SMALL, layout="wide"))


def test_sparse_static_only(offset):  # noqa: F811
    out = offset_icu.prepare(offset["patient"], None, None, None, params=dataclasses.replace(SMALL, layout="sparse"))
    rows = out["rows"].collect()
    assert "steps" not in out["rows"].columns and all(len(r.static.indices) in (3, 4) for r in rows)
    fill = {r.feature: r.fill for r in out["feature_vocab"].collect()}
    assert fill["gender_F"] == 0.0 and fill["age"] > 18
