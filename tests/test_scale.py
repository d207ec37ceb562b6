"""Plans under skew and at size: hot keys are split, nothing unbounded is broadcast or gathered."""

import pytest
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.operators import events as E, timeaxis

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.fixture
def skewed(spark):
    """A third of all events belong to one stay, half of those being copies of one event."""
    saved = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    hot = "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END"
    yield spark.range(0, 240_000, 1, 12).selectExpr(
        f"{hot} AS stay_id",
        "timestamp_micros(CASE WHEN id % 6 = 0 THEN 60000000 ELSE (id * 7919 % 800000) * 1000000 END) AS ts",
        "concat('f', id % 5) AS feature",
        "CAST(id % 101 AS DOUBLE) AS value",
    )
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_stay_is_split_in_the_anchor_join(skewed):
    hourly = E.hourly_mean(timeaxis.within(timeaxis.anchor_to_first_event(skewed), 240))
    plan = final_plan(hourly)
    assert "skew=true" in plan
    assert "partial_avg" in plan
    brute = (
        skewed.join(skewed.groupBy("stay_id").agg(F.min("ts").alias("t0")), "stay_id")
        .withColumn("h", (F.unix_micros("ts") - F.unix_micros("t0")) / 3.6e9)
        .where("h < 240")
        .groupBy("stay_id", F.floor("h").cast("int").alias("hour"), "feature")
        .agg(F.sum("value").alias("s"), F.count("*").alias("n"))
        .selectExpr("stay_id", "hour", "feature", "s / n AS value")
    )
    assert hourly.count() == brute.count()
    joined = hourly.alias("a").join(brute.alias("b"), ["stay_id", "hour", "feature"])
    assert joined.where("abs(a.value - b.value) > 1e-9").isEmpty()


def test_hot_stay_is_split_in_the_membership_test(spark, skewed):
    cohort = spark.range(0, 2000, 1, 4).selectExpr("id AS stay_id")
    kept = E.members(skewed, cohort)
    assert "skew=true" in final_plan(kept)
    assert kept.count() == 240_000


def test_small_checks_the_size(spark):
    few = session.small(spark.range(10).toDF("k"), max_rows=10)
    many = session.small(spark.range(11).toDF("k"), max_rows=10)
    hinted = [df._jdf.queryExecution().analyzed().toString().count("ResolvedHint") for df in (few, many)]
    assert hinted == [1, 0] and many.count() == 11


def test_run_removes_its_hand_over_tables(spark):
    with session.run(spark) as folder:
        df = session.barrier(spark.range(5).toDF("k"))
        assert df.count() == 5 and f"{folder.removeprefix('file:')}/" in df.inputFiles()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert f"{folder}/" not in session.fresh_path(spark, "later")


def test_barrier_lies_in_the_shared_folder(spark):
    df = session.barrier(spark.range(5).toDF("k"))
    assert df.inputFiles()[0].replace("file://", "").startswith(session.shared_dir(spark).replace("file:", ""))


def test_first_stay_limits_each_group_before_the_shuffle(spark):
    from cohortframe.operators.cohort import first_stay

    df = spark.range(1000).selectExpr("id AS stay_id", "id % 3 AS subject_id", "timestamp_micros(id) AS intime")
    plan = first_stay(df)._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("WindowGroupLimit"), plan.index("Exchange hashpartitioning(subject_id")
    assert before < after < plan.rindex("WindowGroupLimit")


def test_vocabulary_filters_reach_the_scan(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = E.allow_items(raw, {"click": "c", "view": "v"}, "event_type").select("feature")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type, [click,view])" in text and "ReadSchema: struct<event_type:string>" in text


QUERIES_WITHOUT_GLOBAL_SORT = ["hourly_mean", "window_mean", "code_history", "tensor_rows", "patient_events_to_stays"]


@pytest.mark.parametrize("name", QUERIES_WITHOUT_GLOBAL_SORT)
def test_no_cross_join_and_no_single_task_window(spark, name):
    from cohortframe.catalog import QUERIES

    plan = final_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Exchange SinglePartition" not in plan


def test_large_cohort_prunes_events_before_their_shuffle(spark):
    """A Bloom filter of the cohort's keys stands below the exchange of the events, and no row of the cohort is lost."""
    events = session.barrier(spark.range(200_000).selectExpr("id % 50000 AS stay_id", "id AS value"), "events")
    cohort = session.barrier(spark.range(0, 50_000, 50).selectExpr("id AS stay_id", "CASE WHEN id % 3 = 0 THEN 'val' ELSE 'train' END AS split"), "cohort")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        kept = E.members(events, cohort)
        plan = final_plan(kept)
        assert kept.count() == 4_000 and {r.stay_id % 50 for r in kept.select("stay_id").distinct().collect()} == {0}
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lines = plan.splitlines()
    above = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(stay_id" in line)
    assert any("might_contain" in line for line in lines[above:])
