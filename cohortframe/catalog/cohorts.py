"""Queries over cohort selection, labels and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe.catalog.base import CO, HORIZON, LABELS, OUTCOMES, Tables, query, r6, split_sql
from cohortframe.functions import scalars as S
from cohortframe.operators import cohort as C, split, survival
from cohortframe.params import Labels, Split
from cohortframe.plans import prepare


@query(
    "first_stay",
    f"""WITH {CO}, r AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY intime, stay_id) AS n FROM stays)
    SELECT subject_id, stay_id, priority FROM r WHERE n = 1""",
)
def first_stay(t: Tables):
    return C.first_stay(t.stays).select("subject_id", "stay_id", "priority")


_AGE = "CASE WHEN floor(c_acctbal / 100) > 89 THEN '> 89' ELSE CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR) END"


@query(
    "cohort_filters",
    f"""WITH {CO}, c AS (
      SELECT s.*, {_AGE} AS age_text FROM stays s JOIN customer ON c_custkey = subject_id)
    SELECT stay_id, subject_id, TRY_CAST(age_text AS DOUBLE) AS age, round(los_hours, 6) AS duration,
           CAST(CASE status WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS event
    FROM c WHERE TRY_CAST(age_text AS DOUBLE) >= 18 AND los_hours >= 24 AND los_hours <= {HORIZON}
      AND status IN ('F', 'P') AND deathtime IS NOT NULL""",
)
def cohort_filters(t: Tables):
    """Balance in hundreds as an age text, capped as ``> 89``; a returned item stands for a required column."""
    hundreds = F.floor(F.col("c_acctbal") / 100)
    age = F.when(hundreds > 89, "> 89").otherwise(hundreds.cast("int").cast("string"))
    customers = t.read("customer").select(F.col("c_custkey").alias("subject_id"), age.alias("age"))
    adult = C.adults(C.numeric_text(t.stays.join(customers, "subject_id"), "age"))
    long_enough = C.min_stay(C.exclude_longer(adult, "los_hours", HORIZON), "los_hours", 24)
    complete = C.complete_cases(long_enough, ["status", "deathtime"])
    coded = C.map_outcome(complete, "status", {"F": 1, "P": 2})
    return coded.select("stay_id", "subject_id", "age", r6("los_hours").alias("duration"), "event")


@query(
    "cohort_join",
    f"""WITH {LABELS} SELECT l.stay_id, l.subject_id, l.duration, l.event, c_mktsegment AS segment, n_name AS nation,
      o_totalprice AS price
    FROM labels l JOIN orders ON o_orderkey = l.stay_id LEFT JOIN customer ON c_custkey = l.subject_id
    LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def cohort_join(t: Tables):
    """Stays with patient and nation attached by left joins, then inner with the labels."""
    patients = t.read("customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey")
    )
    nations = t.read("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    orders = t.read("orders").select(
        F.col("o_orderkey").alias("stay_id"), F.col("o_custkey").alias("subject_id"), F.col("o_totalprice").alias("price")
    )
    static = orders.join(patients, "subject_id", "left").join(nations, "c_nationkey", "left").drop("c_nationkey")
    joined = C.join_static(t.labels, static)
    return joined.select("stay_id", "subject_id", "duration", "event", "segment", "nation", "price")


@query(
    "stays_with_admissions",
    """WITH adm AS (
      SELECT o_custkey, o_orderkey, count(l_orderkey) AS n_lines
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT o.o_orderkey AS stay_id, c_mktsegment AS segment, n_lines
    FROM orders o LEFT JOIN customer ON c_custkey = o.o_custkey
    LEFT JOIN adm ON adm.o_custkey = o.o_custkey AND adm.o_orderkey = o.o_orderkey""",
)
def stays_with_admissions(t: Tables):
    orders = t.read("orders").select(
        F.col("o_orderkey").alias("stay_id"), F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id")
    )
    patients = t.read("customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("segment"))
    lines = t.read("lineitem").groupBy(F.col("l_orderkey").alias("hadm_id")).agg(F.count("*").alias("n_lines"))
    admissions = orders.select("subject_id", "hadm_id").join(lines, "hadm_id")
    joined = C.stays_with_admissions(orders, patients, admissions)
    return joined.select("stay_id", "segment", "n_lines")


@query(
    "outcome_map_drop",
    "SELECT o_orderkey AS stay_id, CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS event FROM orders "
    "WHERE o_orderstatus IN ('F', 'P')",
)
def outcome_map_drop(t: Tables):
    mapped = C.map_outcome(t.read("orders"), "o_orderstatus", {"F": 1, "P": 2})
    return mapped.select(F.col("o_orderkey").alias("stay_id"), "event")


@query(
    "outcome_map_default",
    "SELECT o_orderkey AS stay_id, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS INTEGER) AS event "
    "FROM orders",
)
def outcome_map_default(t: Tables):
    mapped = C.map_outcome(t.read("orders"), "o_orderstatus", {"F": 1, "P": 2}, default=0)
    return mapped.select(F.col("o_orderkey").alias("stay_id"), "event")


@query(
    "labels_offset",
    f"""WITH {CO} SELECT stay_id,
      CASE WHEN offset_minutes IS NULL THEN NULL ELSE round(least(offset_minutes / 60.0, {HORIZON}.0), 6) END AS duration,
      CAST(CASE WHEN offset_minutes / 60.0 > {HORIZON} THEN 0 WHEN status = 'F' THEN 1 ELSE 0 END AS INTEGER) AS event
    FROM stays""",
)
def labels_offset(t: Tables):
    labels = survival.labels_from_offsets(t.stays, "offset_minutes", "status", "F", HORIZON)
    return labels.select("stay_id", r6("duration").alias("duration"), "event")


@query(
    "labels_calendar",
    f"""WITH {CO}, d AS (
      SELECT stay_id, (epoch_us(coalesce(deathtime, dod)) - epoch_us(intime)) / 3.6e9 AS to_death, los_hours FROM stays)
    SELECT stay_id, CAST(coalesce(to_death <= {HORIZON}, false) AS INTEGER) AS event,
      round(CASE WHEN coalesce(to_death <= {HORIZON}, false) THEN greatest(to_death, 0.0)
           WHEN los_hours IS NULL THEN NULL ELSE greatest(least(los_hours, {HORIZON}.0), 0.0) END, 6) AS duration
    FROM d""",
)
def labels_calendar(t: Tables):
    labels = survival.labels_from_calendar(t.stays, HORIZON)
    return labels.select("stay_id", "event", r6("duration").alias("duration"))


@query(
    "labels_competing",
    f"""WITH {CO} SELECT stay_id, round(los_hours, 6) AS duration,
      CAST(CASE status WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS INTEGER) AS event
    FROM stays WHERE los_hours <= {HORIZON}""",
)
def labels_competing(t: Tables):
    coded = C.map_outcome(t.stays, "status", {"F": 1, "P": 2, "O": 0}, "outcome")
    labels = survival.labels_competing(C.exclude_longer(coded, "los_hours", HORIZON), "los_hours", "outcome")
    return labels.select("stay_id", r6("duration").alias("duration"), "event")


@query(
    "labels_from_dispositions",
    f"""WITH {CO} SELECT stay_id, round(los_hours, 6) AS ed_los_hours,
      CAST(CASE status WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS INTEGER) AS outcome FROM stays""",
)
def labels_from_dispositions(t: Tables):
    """Length of stay with dispositions from a second table; open orders have none listed."""
    stays = t.stays
    named = S.lookup("o_orderstatus", {"F": "DIED", "P": "FLOOR"}, "UNKNOWN")
    outcomes = t.read("orders").select(F.col("o_orderkey").alias("stay_id"), named.alias("disposition"))
    labels = prepare.ed_labels(stays.select("stay_id", "intime", "outtime"), outcomes)
    return labels.withColumn("ed_los_hours", r6("ed_los_hours"))


@query(
    "horizon_censor",
    f"""WITH {CO} SELECT stay_id, CASE WHEN los_hours > 10000 THEN 10000.0::DOUBLE ELSE round(los_hours, 6) END AS duration,
      CAST(CASE WHEN los_hours > 10000 THEN 0 WHEN status = 'F' THEN 1 WHEN status = 'P' THEN 2 ELSE 0 END AS INTEGER) AS event
    FROM stays""",
)
def horizon_censor(t: Tables):
    coded = t.stays.select("stay_id", F.col("los_hours").alias("duration"),
                           S.lookup("status", {"F": 1, "P": 2}, 0).alias("event"))
    return survival.censor_at(coded, 10_000).withColumn("duration", r6("duration"))


@query("hash_split", f"SELECT c_custkey AS subject_id, {split_sql('c_custkey')} AS split FROM customer")
def hash_split(t: Tables):
    customers = t.read("customer").select(F.col("c_custkey").alias("subject_id"))
    return split.split_by_hash(customers, Split())


_H52 = "('0x' || substr(md5('42|' || CAST({} AS VARCHAR)), 1, 13))::BIGINT"


@query(
    "exact_split",
    f"""WITH s AS (SELECT DISTINCT o_custkey AS subject_id FROM orders),
    r AS (SELECT subject_id, row_number() OVER (ORDER BY {_H52.format('subject_id')}) AS k, count(*) OVER () AS n FROM s),
    h AS (SELECT *, ceil(round(n * 0.3, 6)) AS held FROM r),
    p AS (SELECT *, ceil(round(held * (0.2 / 0.3), 6)) AS test FROM h)
    SELECT o_orderkey AS stay_id, CASE WHEN k <= n - held THEN 'train' WHEN k <= n - test THEN 'val' ELSE 'test' END AS split
    FROM orders JOIN p ON subject_id = o_custkey""",
)
def exact_split(t: Tables):
    stays = t.read("orders").select(F.col("o_orderkey").alias("stay_id"), F.col("o_custkey").alias("subject_id"))
    return split.split_exact(stays, Split(exact=True)).select("stay_id", "split")


@query(
    "stratified_split",
    f"""WITH {LABELS}, r AS (
      SELECT stay_id, event, row_number() OVER (PARTITION BY event ORDER BY {_H52.format('stay_id')}) AS k,
             count(*) OVER (PARTITION BY event) AS n FROM labels)
    SELECT stay_id, event, CASE WHEN k <= n - ceil(round(n * 0.2, 6)) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def stratified_split(t: Tables):
    return split.stratified_split(t.labels.select("stay_id", "event")).select("stay_id", "event", "split")


@query(
    "canonical_keys",
    f"""SELECT DISTINCT o_custkey AS subject_id, o_orderstatus AS status, {split_sql('o_custkey')} AS split FROM orders""",
)
def canonical_keys(t: Tables):
    named = C.canonical(t.read("orders"), {"o_orderkey": "stay_id", "o_custkey": "subject_id", "o_orderstatus": "status"})
    checked = C.require_columns(named, ["stay_id", "subject_id"])
    return split.split_by_hash(checked.select("subject_id", "status").distinct())


@query(
    "split_partition",
    f"""WITH {LABELS} SELECT stay_id, subject_id, duration, event FROM labels WHERE split = 'val'""",
)
def split_partition(t: Tables):
    return split.part_of(t.labels, "val").drop("split")


@query(
    "n_events",
    f"""WITH {LABELS} SELECT CAST(2 AS INTEGER) AS configured, CAST(count(DISTINCT event) AS INTEGER) AS n_events
    FROM labels WHERE event <> 0""",
)
def n_events(t: Tables):
    return survival.observed_event_count(t.labels).withColumn("configured", F.lit(Labels(outcomes=OUTCOMES, competing=True).n_events))


@query(
    "time_scalars",
    f"""WITH {CO}, h AS (
      SELECT *, (epoch_us(coalesce(deathtime, dod)) - epoch_us(intime)) / 3.6e9 AS to_death FROM stays)
    SELECT stay_id, round(to_death, 6) AS to_death, round(CASE WHEN to_death IS NULL OR los_hours IS NULL THEN NULL
        ELSE least(to_death, los_hours) END, 6) AS first_end,
      round(CASE WHEN to_death IS NULL OR los_hours IS NULL THEN NULL ELSE greatest(to_death, los_hours, 0.0) END, 6) AS last_end,
      CAST(CASE WHEN status = 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_filled,
      CAST(floor(offset_minutes / 60.0) AS INTEGER) AS hour_bin
    FROM h WHERE los_hours >= 0 AND los_hours < {HORIZON}""",
)
def time_scalars(t: Tables):
    to_death = S.hours_between("intime", F.coalesce("deathtime", "dod"))
    timed = t.stays.where((F.col("los_hours") >= 0) & (F.col("los_hours") < HORIZON)).withColumn("to_death", to_death)
    return timed.select(
        "stay_id",
        r6("to_death").alias("to_death"),
        r6(S.strict_least("to_death", "los_hours")).alias("first_end"),
        r6(S.strict_greatest("to_death", "los_hours", F.lit(0.0))).alias("last_end"),
        S.indicator(F.col("status") == "F").alias("is_filled"),
        S.hour_bin(F.col("offset_minutes") / F.lit(60.0)).alias("hour_bin"),
    )
