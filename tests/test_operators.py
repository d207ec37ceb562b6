"""Hand fixtures for the traps."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohortframe.operators import (
    assemble, codes as K, cohort as C, events as E, reports as R, report, select, split, static as St, timeaxis, transform,
)
from cohortframe.params import Split

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_age_text(frame):
    df = C.adults(C.numeric_text(frame("id int, age string", [(1, "> 89"), (2, "17"), (3, "18"), (4, ""), (5, None)]), "age"))
    assert rows(df, "id", "age") == [(3, 18.0)]


def test_first_stay_breaks_ties_and_precedes_filters(frame):
    df = frame("stay_id int, subject_id int, intime timestamp, age int",
               [(2, 1, at(0), 30), (1, 1, at(0), 10), (3, 1, at(-1), 5), (4, 2, None, 40), (5, 3, at(9), 50)])
    first = C.first_stay(df)
    assert rows(first, "stay_id") == [(3,), (5,)]
    assert rows(C.adults(first), "stay_id") == [(5,)]


def test_outcomes(frame):
    df = frame("d string", [("ICU",), ("Left",), (None,)])
    assert rows(C.map_outcome(df, "d", {"ICU": 1}), "event") == [(1,)]
    assert rows(C.map_outcome(df, "d", {"ICU": 1}, default=0), "event") == [(0,), (0,), (1,)]


def test_required_columns(frame):
    with pytest.raises(ValueError, match="subject_id"):
        C.require_columns(frame("stay_id int", [(1,)]), ["stay_id", "subject_id"])


def test_mean_of_means_is_not_pooled(frame):
    df = frame("stay_id int, hours double, instant int, feature string, value double",
               [(1, 0.1, 6, "a", 1.0), (1, 0.1, 6, "a", 3.0), (1, 0.5, 30, "a", 8.0)])
    assert E.hourly_mean(df).first().value == 4.0
    assert E.instant_then_hour_mean(df).first().value == 5.0


def test_window_mean_weights_hours_equally(frame):
    df = frame("stay_id int, hour int, feature string, value double",
               [(1, 0, "a", 1.0), (1, 3, "a", 3.0), (1, 4, "a", 9.0), (1, 8, "a", 100.0)])
    assert rows(E.window_mean(df, 4, 2), "window", "value") == [(0, 2.0), (1, 9.0)]


def test_first_value_skips_null_and_follows_order(frame):
    df = frame("stay_id int, instant int, feature string, value string, seq int",
               [(1, 0, "a", "late", 3), (1, 0, "a", None, 1), (1, 0, "a", "first", 2)])
    assert E.first_per_instant(df, "instant", "seq").first().value == "first"


def test_fan_out_matches_plain_join(frame, spark):
    events = frame("subject_id int, ts timestamp, e int", [(i % 3, at(i * 1.7 - 20), i) for i in range(120)])
    stays = frame("stay_id int, subject_id int, anchor_ts timestamp",
                  [(1, 0, at(0)), (2, 0, at(3)), (3, 1, at(-24)), (4, 1, at(1000)), (5, 2, None), (6, 2, at(24))])
    got = rows(timeaxis.fan_out_to_stays(events, stays, 24), "stay_id", "e")
    plain = events.join(stays, "subject_id")
    hours = (F.unix_micros("ts") - F.unix_micros("anchor_ts")) / 3.6e9
    want = rows(plain.withColumn("h", hours).where("h >= 0 and h < 24"), "stay_id", "e")
    assert got == want and want


def test_ceil_bins_drop_the_last_hour(frame):
    from cohortframe.functions import scalars as S

    df = frame("stay_id int, ts timestamp, feature string, value double",
               [(1, at(h), "a", h) for h in (0.0, 0.5, 1.0, 5.0, 5.5, 6.0, 6.1)])
    timed = timeaxis.within(timeaxis.anchor_to_first_event(df), 6, closed=True).withColumn("hour", S.ceil_bin("hours"))
    assert rows(timed, "hour", "value") == [(0, 0.0), (1, 0.5), (1, 1.0), (5, 5.0), (6, 5.5), (6, 6.0)]


def test_presence_threshold_includes_equality(frame):
    cells = frame("stay_id int, split string, hour int, feature string, value double",
                  [(1, "train", 0, "a", 1.0), (1, "train", 0, "b", None), (1, "train", 1, "a", 1.0), (1, "train", 1, "b", 2.0),
                   (2, "test", 0, "c", 1.0)])
    train = frame("stay_id int", [(1,), (9,)])
    rate = {k: dict(rows(select.presence(cells, train, 4, k), "feature", "presence")) for k in ("rows", "grid", "grid_nonempty")}
    assert rate["rows"] == {"a": 1.0, "b": 0.5, "c": 0.0}
    assert rate["grid"] == {"a": 0.25, "b": 0.125, "c": 0.0}
    assert rate["grid_nonempty"] == {"a": 0.5, "b": 0.25, "c": 0.0}
    kept = select.dense_enough(select.presence(cells, train, 4, "rows"), 0.5)
    assert rows(kept, "feature") == [("a",), ("b",)]


def test_not_sparse_is_strict(frame):
    df = frame("stay_id int, instant int, feature string", [(1, i, "a") for i in range(20)] + [(1, 0, "b"), (1, 0, "c"), (1, 1, "c")])
    assert rows(select.not_sparse(df, max_null_share=0.95), "feature") == [("a",), ("c",)]


def test_one_hot_levels(frame):
    df = frame("stay_id int, g string, k string", [(1, "F", "x"), (2, None, "y"), (3, "M", "x")])
    assert rows(St.level_vocabulary(df, ["k", "g"]).orderBy("column_idx"), "column_idx", "feature", "level_rank") == [
        (0, "k_x", 1), (0, "k_y", 2), (1, "g_F", 1), (1, "g_M", 2)]
    assert rows(St.one_hot(df, ["g", "k"]), "stay_id", "feature") == [
        (1, "g_F"), (1, "k_x"), (2, "k_y"), (3, "g_M"), (3, "k_x")]
    dropped = St.one_hot(df, ["g", "k"], St.level_vocabulary(df, ["g", "k"], drop_first=True))
    assert rows(dropped, "stay_id", "feature") == [(2, "k_y"), (3, "g_M")]


def test_scaler_counts_missing_as_zero(frame):
    cells = frame("stay_id int, split string, window int, feature string, value double",
                  [(1, "train", 0, "a", 4.0), (2, "train", 1, "a", 8.0), (3, "test", 0, "a", 99.0), (1, "train", 0, "flat", 0.0)])
    train = frame("stay_id int", [(1,), (2,)])
    p = {r.feature: (r["mean"], r.scale) for r in transform.scaler_params(cells, train, 2).collect()}
    dense = [4.0, 0.0, 0.0, 8.0]
    mean = sum(dense) / 4
    assert p["a"] == pytest.approx((mean, math.sqrt(sum((v - mean) ** 2 for v in dense) / 4)))
    assert p["flat"] == (0.0, 1.0)
    seen = {r.feature: (r["mean"], r.scale) for r in transform.scaler_params(cells, train, 2, True).collect()}
    assert seen["a"] == pytest.approx((6.0, 2.0))


def test_tensor_rows(frame):
    cohort = frame("stay_id int, age double, g string", [(1, 50.0, None), (2, None, "F"), (3, float("nan"), "new")])
    cells = frame("stay_id int, window int, feature string, value double", [(1, 1, "b", 7.0), (1, 0, "a", 3.0)])
    blocks = [St.Block("age", fill=40.0), St.Block("g", ("F", "M"))]
    layout = assemble.Layout(["a", "b"], [-1.0, -2.0], ["age", "g_F", "g_M"])
    rows_ = St.with_static_arrays(cohort, blocks).drop("age", "g")
    got = {r.stay_id: r for r in assemble.tensor_rows(rows_, cells, layout, 2).collect()}
    assert got[1].x == [[3.0, -2.0, 50.0, 0.0, 0.0], [-1.0, 7.0, 50.0, 0.0, 0.0]]
    assert got[1].mask == [[1.0, 0.0, 1.0, 1.0, 1.0], [0.0, 1.0, 1.0, 1.0, 1.0]]
    assert got[2].x == [[-1.0, -2.0, 40.0, 1.0, 0.0]] * 2
    assert got[2].mask == [[0.0, 0.0, 0.0, 1.0, 1.0]] * 2
    assert got[3].x == [[-1.0, -2.0, 40.0, 0.0, 0.0]] * 2
    bare = assemble.tensor_rows(cohort.select("stay_id"), cells, layout, 2).where("stay_id = 1").first()
    assert bare.x == [[3.0, -2.0], [-1.0, 7.0]]


def test_static_blocks(frame):
    df = frame("stay_id int, split string, a double, c string, z int",
               [(1, "train", 1.0, "y", 2), (2, "train", None, "x", None), (3, "test", 9.0, None, 4)])
    blocks = St.static_blocks(df, ["a"], ["c"], ["z"], df.where("split = 'train'"))
    assert [n for b in blocks for n in b.names] == ["a", "c_x", "c_y", "z"]
    assert [b.fill for b in blocks] == [1.0, None, 2.0]
    kept = St.static_blocks(df, ["a"], ["c"], ["z"])
    assert St.with_static_arrays(df, kept).where("stay_id = 2").first().static == [None, 1.0, 0.0, None]


def test_history_is_strictly_before(frame):
    stays = frame("stay_id int, subject_id int, anchor_ts timestamp", [(1, 1, at(10)), (2, 1, at(20)), (3, 2, at(5))])
    coded = frame("subject_id int, code string, coded_ts timestamp",
                  [(1, "A", at(10)), (1, "A", at(30)), (1, "B", at(1)), (1, "B", at(2)), (2, "C", at(9)), (7, "D", at(0))])
    assert rows(K.past_codes(stays, coded), "stay_id", "code") == [(1, "B"), (2, "A"), (2, "B")]
    assert rows(K.past_code_counts(stays, K.code_records(coded)), "code", "n") == [("A", 1), ("B", 4)]


def test_top_codes_break_ties_by_code(frame):
    counts = frame("code string, n bigint", [("b", 3), ("a", 3), ("c", 9), (None, 50)])
    assert rows(K.top_codes(counts, 2), "code_idx", "code") == [(0, "c"), (1, "a")]


def test_code_vectors(frame):
    cohort = frame("stay_id int, subject_id int", [(1, 1), (2, 1), (3, 2)])
    coded = frame("subject_id int, code string", [(1, "a"), (1, "a"), (1, "b"), (9, "b")])
    counts = K.subject_counts(coded)
    vocab = K.top_codes(K.total_counts(counts), 5)
    got = {r.stay_id: r.n for r in K.vector_per_subject(cohort, counts, vocab, 2, "n").collect()}
    assert got == {1: [2.0, 1.0], 2: [2.0, 1.0], 3: [0.0, 0.0]}


def test_reports(frame):
    df = frame("stay_id bigint, Study string, Impression string", [(1, "x", "y z"), (1, None, "q"), (2, "w", "w")])
    texts = R.report_text(df, "Study", "Impression")
    assert rows(texts, "stay_id", "text") == [(1, "x y z"), (2, "w w")]
    vectors = R.pool_vectors(R.encode_reports(texts, lambda batch: [[len(t), 1.0] for t in batch], batch_size=1))
    assert rows(vectors, "stay_id", "embedding") == [(1, [5.0, 1.0]), (2, [3.0, 1.0])]
    cohort = frame("stay_id bigint", [(1,), (2,), (3,)])
    got = {r.stay_id: (r.radiology, r.has_radiology) for r in R.with_vectors(cohort, vectors, 2).collect()}
    assert got == {1: ([5.0, 1.0], 1), 2: ([3.0, 1.0], 1), 3: ([0.0, 0.0], 0)}
    more = texts.unionByName(frame("stay_id bigint, text string", [(1, "..."), (5, "!"), (6, None)]), allowMissingColumns=True)
    native = {r.stay_id: sum(r.embedding) for r in R.hashed_vectors(more, 8).collect()}
    assert native == pytest.approx({1: 0.5, 2: 1.0, 5: 0.0})


def test_split_keeps_patients_together_and_hits_sizes(spark):
    df = spark.range(4000).selectExpr("id as stay_id", "id div 4 as subject_id")
    hashed = split.split_by_hash(df)
    assert hashed.groupBy("subject_id").agg(F.countDistinct("split").alias("k")).where("k > 1").isEmpty()
    exact = {r.split: r["count"] for r in split.split_exact(df, Split(exact=True)).groupBy("split").count().collect()}
    assert exact == {"train": 2800, "val": 400, "test": 800}


def test_stratified_split(spark):
    df = spark.range(1000).selectExpr("id as stay_id", "cast(id % 10 = 0 as int) as event")
    counts = {(r.event, r.split): r["count"] for r in split.stratified_split(df).groupBy("event", "split").count().collect()}
    assert counts == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}


def test_histogram_closes_the_top_edge(frame):
    df = frame("v double", [(0.0,), (4.9,), (5.0,), (10.0,)])
    assert rows(report.histogram(df, "v", 2), "bin", "n") == [(0, 2), (1, 2)]
    assert rows(report.histogram(frame("v double", [(3.0,), (3.0,)]), "v", 3), "bin", "n") == [(0, 2), (1, 0), (2, 0)]
    assert report.histogram(frame("v double", []), "v", 3).collect() == []


def test_exact_split_without_held_out_share(spark):
    df = spark.range(50).selectExpr("id as stay_id", "id as subject_id")
    assert {r.split for r in split.split_exact(df, Split(1.0, 0.0, 0.0, exact=True)).collect()} == {"train"}


def test_feature_unseen_in_train_keeps_its_cells(frame):
    cells = frame("stay_id bigint, window int, feature string, value double", [(1, 0, "a", 3.0), (2, 0, "b", 5.0)])
    params = frame("feature string, mean double, scale double", [("a", 1.0, 2.0)])
    assert rows(transform.scaled(cells, params), "feature", "value") == [("a", 1.0), ("b", 5.0)]
    vocabulary = frame("feature string, block int, position int", [("a", 0, 0), ("b", 0, 0)])
    layout = assemble.make_layout(vocabulary, params)
    out = assemble.tensor_rows(frame("stay_id bigint", [(1,), (2,)]), transform.scaled(cells, params), layout, 1)
    got = {r.stay_id: (r.x, r.mask) for r in out.collect()}
    assert got == {1: ([[1.0, 0.0]], [[1.0, 0.0]]), 2: ([[-0.5, 5.0]], [[0.0, 1.0]])}


def test_many_features_need_no_limit(spark):
    vocabulary = spark.range(150_000).selectExpr("concat('f', id) as feature", "0 as block", "0 as position")
    layout = assemble.make_layout(vocabulary)
    cells = spark.createDataFrame([(1, 0, "f149999", 2.0)], "stay_id bigint, window int, feature string, value double")
    row = assemble.tensor_rows(spark.createDataFrame([(1,)], "stay_id bigint"), cells, layout, 1).first()
    assert len(row.x[0]) == 150_000 and sum(row.mask[0]) == 1.0


def test_times_in_other_forms(frame):
    from cohortframe.functions import scalars as S
    from cohortframe.sources import tables

    df = frame("t string", [("2024-02-01 10:00:00",), ("01/02/2024 10:00",), ("soon",), (None,)])
    parsed = S.to_time("t", "dd/MM/yyyy HH:mm")
    assert [r.h for r in df.select(F.hour(parsed).alias("h")).collect()] == [10, 10, None, None]
    assert rows(tables.unparsed(df, {"t": parsed}), "column", "n_text", "n_unparsed") == [("t", 3, 1)]


def test_unseen_outcome_is_listed(frame):
    df = frame("split string, event int", [("train", 0), ("train", 1), ("train", 1)])
    got = rows(report.outcome_distribution(df, {0: "a", 1: "b", 2: "c"}), "event", "n", "pct")
    assert got[2] == (2, 0, 0.0) and got[1][:2] == (1, 2)
