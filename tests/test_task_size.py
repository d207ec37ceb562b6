"""What one task holds and does per row: partitions by bytes, one join or aggregate where one will do, no window over a file."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.operators import events as E
from cohortframe.plans import prepare
from cohortframe.sources import tables

SIZE, FIRST = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def conf(spark):
    saved = {k: spark.conf.get(k, None) for k in (SIZE, FIRST)}
    yield spark.conf
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_parts_are_small_and_finer_ones_stay(spark, conf):
    conf.set(SIZE, "64m")
    conf.unset(FIRST)
    session.small_parts(spark)
    assert int(conf.get(SIZE)) == session.PART_BYTES and int(conf.get(FIRST)) == session.PARTS
    conf.set(SIZE, "20000")
    conf.set(FIRST, "5000")
    session.small_parts(spark)
    assert (conf.get(SIZE), conf.get(FIRST)) == ("20000", "5000")


def test_queries_ask_for_small_parts(spark, conf):
    from cohortframe.catalog import QUERIES

    conf.set(SIZE, "64MB")
    QUERIES["code_current"](spark, "/root/testdata/sf0.001")
    assert int(conf.get(SIZE)) == session.PART_BYTES


@pytest.fixture
def charted(frame):
    rows = [(1, "2024-01-01 01:00:00", 3.0), (1, "2024-01-01 01:00:00", 5.0), (2, "2023-12-31 00:00:00", 7.0), (9, "2024-01-01 00:00:00", 1.0), (None, "2024-01-01 00:00:00", 1.0)]
    return frame("stay_id bigint, t string, v double", rows).select("stay_id", F.to_timestamp("t").alias("charttime"), "v")


def test_ed_series_joins_both_tables_at_once(frame, charted):
    stays = frame("stay_id bigint, t string", [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")])
    stays = stays.select("stay_id", F.to_timestamp("t").alias("intime"))
    series = prepare.ed_series(charted.withColumnRenamed("v", "hr"), charted.select("stay_id", "charttime", (F.col("v") * 2).alias("lab")), stays)
    assert [tuple(r) for r in series.collect()] == [(1, 1.0, 4.0, 8.0)]
    assert plan_of(series).count("Join ") == 1


def test_pivot_mean_is_one_aggregate(frame):
    df = frame("k int, feature string, v double", [(1, "a", 1.0), (1, "a", 3.0), (1, "c", 9.0), (2, None, 4.0), (3, "b", None)])
    wide = E.pivot_mean(df, ["k"], ["a", "b"], "v")
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 2.0, None), (2, None, None), (3, None, None)]
    assert plan_of(wide).count("Aggregate(") == 2


def test_first_numbers_of_texts_are_hashed(frame):
    rows = [(1, 5, "x", "> 4", 0), (1, 5, "x", "7", 1), (2, 5, "x", "3", 4), (2, 5, "x", "1", 9), (2, 5, "x", None, 0)]
    df = frame("stay_id int, instant int, feature string, value string, seq int", rows).withColumn("number", F.col("value").try_cast("double"))
    firsts = E.first_per_instant(df, "instant", "seq", taken="number")
    assert sorted((r.stay_id, r.value) for r in firsts.collect()) == [(1, None), (2, 3.0)]
    assert "SortAggregate" not in plan_of(firsts)


def test_first_values_of_a_stay_are_hashed(frame):
    from cohortframe.operators.losses import Losses
    from cohortframe.plans.emergency import first_values

    rows = [(1, "t", "x", "> 4", 0), (1, "t", "x", "7", 1), (2, "t", "x", "3", 4), (2, "t", "x", "1", 9), (2, "t", "x", None, 0)]
    df = frame("stay_id int, time string, feature string, value string, seq int", rows).withColumn("instant", F.timestamp_micros(F.lit(5)))
    cohort = frame("stay_id int, split string", [(1, "train"), (2, "val")])
    firsts = first_values(df, cohort, 0, Losses(), "labs")
    assert sorted((r.stay_id, r.value) for r in firsts.collect()) == [(1, None), (2, 3.0)]
    assert "SortAggregate" not in plan_of(firsts)


def test_file_order_sees_runs_and_not_rows(spark, tmp_path):
    rows = spark.range(30_000).select(F.col("id").alias("stay_id"), F.lit("train").alias("split")).coalesce(1)
    rows.write.partitionBy("split").parquet(f"{tmp_path}/rows")
    index = tables.file_index(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in index.collect()] == [("train", 0, 29_999, 30_000, True)]
    plan = plan_of(index)
    assert plan.index("Window") < plan.index("MapInArrow")
    # Rows out of order within a batch and from one batch to the next.
    for name, at in (("within", 3), ("between", 10_000)):
        order = F.when(F.col("id") == at, -1).otherwise(F.col("id"))
        rows = spark.range(0, 30_000, 1, 1).select(order.alias("stay_id"), F.lit("train").alias("split"))
        rows.write.partitionBy("split").parquet(f"{tmp_path}/{name}/rows")
        assert not tables.file_index(spark, f"{tmp_path}/{name}").first().in_order
    empty = spark.range(0, 5, 1, 1).select(F.when(F.col("id") != 2, F.col("id")).alias("stay_id"), F.lit("train").alias("split"))
    empty.write.partitionBy("split").parquet(f"{tmp_path}/nulls/rows")
    assert tuple(tables.file_index(spark, f"{tmp_path}/nulls").first())[1:] == ("train", 0, 4, 5, True)


def test_file_order_needs_no_aggregate_of_rows(spark):
    from cohortframe.catalog import QUERIES

    df = QUERIES["clustered_file_order"](spark, "/root/testdata/sf0.001")
    assert "Aggregate" not in plan_of(df) and df.where("n_files <> 1 OR NOT in_order").isEmpty()


def test_cell_texts_round_as_spark_does(spark):
    from cohortframe.catalog.datasets import _CellTexts

    values = np.array([0.00005, -0.00005, 0.00015, -0.00025, 0.000049999, 1.23456, -7.0, 0.0, 3e9, 0.5], np.float32)
    x = pa.array([[values.tolist(), [*(-values[:-1]).tolist(), 0.5]]], pa.list_(pa.list_(pa.float32())))
    mask = pa.array([[[1.0] * 10, [*[0.0] * 9, 1.0]]], pa.list_(pa.list_(pa.float32())))
    batch = pa.RecordBatch.from_arrays([pa.array([4]), x, mask], names=["stay_id", "x", "mask"])
    names = [*"abcdefgh", None, "j"]
    got = pa.Table.from_batches(list(_CellTexts(names, 1, most_cells=7).run([batch]))).to_pylist()
    for w, row in enumerate(got):
        want = spark.createDataFrame([(float(v) * (-1) ** w,) for v in values], "v double")
        whole = [r.v for r in want.select(F.round(F.col("v") * 10000).cast("bigint").alias("v")).collect()]
        whole[-1] = 5000
        assert row == {"stay_id": 4, "window": w, "cells": " ".join(f"{n}={v}/{1 if n == 'j' else 1 - w}" for n, v in zip(names, whole) if n)}
