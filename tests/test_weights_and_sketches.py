"""Slot weights of report embeddings and mergeable distinct counts."""

import dataclasses
import math

import pytest
from pyspark.sql import functions as F

from cohortframe.operators import report, reports as R
from cohortframe.params import Codes, Reports
from cohortframe.plans import calendar_icu
from tests.test_plans import SMALL, calendar  # noqa: F401

DIM = 4096


def slot(spark, token):
    return spark.range(1).select(R.token_bucket(F.lit(token), DIM)).first()[0]


def test_weights_know_train_only(spark, frame):
    texts = frame("stay_id bigint, text string", [(1, "lung clear clear"), (1, "lung"), (2, "clear heart"), (3, "rare lung"), (4, "")])
    sums = R.slot_sums(texts, DIM)
    weights = R.idf_weights(sums, frame("stay_id bigint", [(1,), (2,), (4,)]), DIM)
    by = {r.pos: (r.reports, r.weight) for r in weights.collect()}
    assert len(by) == DIM
    expect = {"lung": 2, "clear": 2, "heart": 1, "rare": 0}
    for token, d in expect.items():
        assert by[slot(spark, token)] == (d, pytest.approx(math.log(5 / (1 + d)) + 1))
    vectors = {r.stay_id: r.embedding for r in R.weighted_vectors(sums, weights, DIM).collect()}
    assert vectors[1][slot(spark, "lung")] == pytest.approx((1 / 3 + 1) / 2 * (math.log(5 / 3) + 1))
    assert vectors[3][slot(spark, "rare")] == pytest.approx(0.5 * (math.log(5) + 1)) and sum(vectors[4]) == 0
    plain = {r.stay_id: r.embedding for r in R.hashed_vectors(texts, DIM).collect()}
    flat = weights.withColumn("weight", F.lit(1.0))
    assert {k: pytest.approx(v) for k, v in plain.items()} == {r.stay_id: r.embedding for r in R.weighted_vectors(sums, flat, DIM).collect()}
    assert R.weighted_vectors(R.slot_sums(texts.where("stay_id > 9"), DIM), weights, DIM).collect() == []


def test_plan_with_weights(calendar):  # noqa: F811
    some = {k: calendar[k] for k in ("icustays", "patients", "admissions", "radiology")}
    params = dataclasses.replace(SMALL, reports=Reports(dim=16, idf=True))
    out = calendar_icu.prepare(**some, params=params, static=False)
    assert out["slot_weights"].count() == 16
    row = out["rows"].where("stay_id = 2").first()
    assert len(row.radiology) == 16 and row.has_radiology == 1 and sum(row.radiology) > 0
    assert "slot_weights" not in calendar_icu.prepare(**some, params=SMALL, static=False)


def test_current_codes_of_the_own_admission(calendar, frame):  # noqa: F811
    some = {k: calendar[k] for k in ("icustays", "patients", "admissions")}
    diagnoses = frame("subject_id bigint, hadm_id bigint, icd_code string", [(1, 1002, "a"), (1, 1002, "a"), (1, 1002, "b"), (1, 1003, "c"), (2, 1002, "z")])
    params = dataclasses.replace(SMALL, codes=Codes(top_n=5, mode="current", fit_on="all", value="count"))
    out = calendar_icu.prepare(**some, diagnoses=diagnoses, params=params, static=False)
    assert [(r.code, r.n) for r in out["code_vocab"].orderBy("code_idx").collect()] == [("a", 2), ("b", 1)]
    assert {r.stay_id: list(r.icd) for r in out["rows"].collect() if sum(r.icd)} == {2: [1.0, 1.0]}


def test_sketches_merge(spark):
    one = spark.range(60_000).select((F.col("id") % 20_000).alias("subject_id"), F.lit("train").alias("split"))
    two = spark.range(30_000).select((F.col("id") + 10_000).cast("string").alias("subject_id"), F.lit("train").alias("split"))
    merged = report.merge_sketches(report.split_sketches(one), report.split_sketches(two))
    row = report.approximate_counts(merged).first()
    assert row.n_stays == 90_000 and abs(row.n_patients - 40_000) < 3 * 1.04 / 64 * 40_000
    nothing = report.approximate_counts(report.split_sketches(one.where("subject_id < 0")))
    assert nothing.collect() == []
    assert report.approximate_counts(report.split_sketches(one.select(F.lit(None).cast("int").alias("subject_id"), "split"))).first().n_patients == 0
