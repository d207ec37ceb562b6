"""Registry of the checkable queries and the bindings of the library's inputs to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.operators import cohort as C, events as E, split, survival, timeaxis
from cohortframe.params import Split

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MAX_HOURS, WINDOW_HOURS, NUM_WINDOWS = 240, 24, 10
HORIZON = 20_000
FEATURES = ["click", "error", "purchase", "signup", "view"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
OUTCOMES = {0: "Open", 1: "Filled", 2: "Partial"}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with the SQL that gives the same rows where there is one."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(c) -> Column:
    return F.round(S.col(c), 6)


class Tables:
    """The test tables, and the library's canonical inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = session.small_parts(session.tune(spark)), folder
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    # -- series: events of a user ------------------------------------------------------------------------------------

    @cached_property
    def measurements(self) -> DataFrame:
        return self.read("events").select(
            F.col("user_id").alias("stay_id"), F.col("event_type").alias("feature"), "value", "ts", "event_id"
        )

    @cached_property
    def timed(self) -> DataFrame:
        return timeaxis.within(timeaxis.anchor_to_first_event(self.measurements), MAX_HOURS)

    @cached_property
    def hourly(self) -> DataFrame:
        return E.hourly_mean(self.timed)

    @cached_property
    def windows(self) -> DataFrame:
        return E.window_mean(self.hourly, WINDOW_HOURS, NUM_WINDOWS)

    @cached_property
    def split_windows(self) -> DataFrame:
        """Window means with the split of the user, a function of the user's number alone."""
        return split.split_by_hash(self.windows, subject="stay_id")

    @cached_property
    def users(self) -> DataFrame:
        users = self.read("events").select(F.col("user_id").alias("stay_id")).distinct()
        return split.split_by_hash(users.withColumn("subject_id", F.col("stay_id")))

    # -- cohort: orders of a customer --------------------------------------------------------------------------------

    @cached_property
    def stays(self) -> DataFrame:
        shipped = self.read("lineitem").groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("outtime"),
            F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("deathtime"),
            F.min(F.when(F.col("l_returnflag") == "A", F.col("l_shipdate"))).alias("dod"),
        )
        orders = C.canonical(
            self.read("orders"),
            {"o_orderkey": "stay_id", "o_custkey": "subject_id", "o_orderdate": "intime", "o_orderstatus": "status",
             "o_orderpriority": "priority"},
        )
        joined = orders.join(shipped.withColumnRenamed("l_orderkey", "stay_id"), "stay_id", "left")
        return joined.withColumns(
            {
                "dischtime": F.col("outtime"),
                "los_hours": S.hours_between("intime", "outtime"),
                "offset_minutes": (S.micros("outtime") - S.micros("intime")) / F.lit(6e7),
            }
        )

    @cached_property
    def labels(self) -> DataFrame:
        known = self.stays.where(F.col("los_hours").isNotNull())
        coded = known.withColumns(
            {
                "duration": F.greatest(F.col("los_hours"), F.lit(0.0)),
                "event": S.lookup("status", {"F": 1, "P": 2}, 0),
            }
        )
        cut = survival.censor_at(coded, HORIZON).select("stay_id", "subject_id", "duration", "event")
        return split.split_by_hash(cut)

    @cached_property
    def single_risk(self) -> DataFrame:
        return self.labels.withColumn("event", S.indicator(F.col("event") == 1))

    # -- static features: customers ----------------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        """Customers as stays; a negative balance counts as not recorded, and so does the segment of such a customer."""
        recorded = F.col("c_acctbal") >= 0
        return split.split_by_hash(
            self.read("customer").select(
                F.col("c_custkey").alias("stay_id"),
                F.col("c_custkey").alias("subject_id"),
                F.when(recorded, F.col("c_acctbal")).alias("balance"),
                F.when(recorded, F.col("c_mktsegment")).alias("segment"),
                (F.col("c_nationkey") % 5).cast("string").alias("zone"),
            )
        )

    # -- codes: part brands ordered by a customer ----------------------------------------------------------------------

    @cached_property
    def coded(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        parts = self.read("part").select("p_partkey", "p_brand")
        lines = self.read("lineitem").select("l_orderkey", "l_partkey")
        joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
            orders, F.col("l_orderkey") == F.col("o_orderkey")
        )
        return joined.select(
            F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"), F.col("p_brand").alias("code"),
            F.col("o_orderdate").alias("coded_ts"),
        )

    @cached_property
    def code_stays(self) -> DataFrame:
        return split.split_by_hash(
            self.read("orders").select(
                F.col("o_orderkey").alias("stay_id"), F.col("o_custkey").alias("subject_id"),
                F.col("o_orderkey").alias("hadm_id"), F.col("o_orderdate").alias("anchor_ts"),
            )
        )

    # -- vectors and texts ----------------------------------------------------------------------------------------------

    @cached_property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select((F.col("vec_id") % 150).alias("stay_id"), "embedding")

    @cached_property
    def texts(self) -> DataFrame:
        return self.read("documents").select("doc_id", (F.col("doc_id") % 150).alias("stay_id"), "lang", "source", "text")


SPLIT = Split()

# --- the same bindings in SQL ---------------------------------------------------------------------------------------


def split_sql(subject: str) -> str:
    part = f"substr(md5('42|' || CAST({subject} AS VARCHAR)), 1, 8)"
    return f"CASE WHEN {part} < 'b3333333' THEN 'train' WHEN {part} < 'cccccccc' THEN 'val' ELSE 'test' END"


TS = f"""
first_ts AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
timed AS (
  SELECT e.user_id AS stay_id, e.event_type AS feature, e.value, e.ts, e.event_id,
         (epoch_us(e.ts) - epoch_us(f.t0)) / 3.6e9 AS hours
  FROM events e JOIN first_ts f ON e.user_id = f.user_id),
inside AS (SELECT * FROM timed WHERE hours >= 0 AND hours < {MAX_HOURS}),
hourly AS (
  SELECT stay_id, CAST(floor(hours) AS INTEGER) AS hour, feature, avg(value) AS value FROM inside GROUP BY 1, 2, 3),
windows AS (
  SELECT stay_id, CAST(floor(hour / {WINDOW_HOURS}.0) AS INTEGER) AS win, feature, avg(value) AS value
  FROM hourly GROUP BY 1, 2, 3),
users AS (SELECT DISTINCT user_id AS stay_id, {split_sql('user_id')} AS split FROM events),
features AS (SELECT DISTINCT feature FROM hourly),
grid AS (
  SELECT u.stay_id, u.split, CAST(w.range AS INTEGER) AS win, f.feature, c.value
  FROM users u CROSS JOIN range({NUM_WINDOWS}) w CROSS JOIN features f
  LEFT JOIN windows c ON c.stay_id = u.stay_id AND c.win = w.range AND c.feature = f.feature)"""

CO = """
shipped AS (
  SELECT l_orderkey, max(l_shipdate) AS outtime, min(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS deathtime,
         min(l_shipdate) FILTER (WHERE l_returnflag = 'A') AS dod
  FROM lineitem GROUP BY l_orderkey),
stays AS (
  SELECT o_orderkey AS stay_id, o_custkey AS subject_id, o_orderdate AS intime, outtime, outtime AS dischtime, deathtime,
         dod, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice,
         (epoch_us(outtime) - epoch_us(o_orderdate)) / 3.6e9 AS los_hours,
         (epoch_us(outtime) - epoch_us(o_orderdate)) / 6e7 AS offset_minutes
  FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey)"""

LABELS = f"""{CO},
labels AS (
  SELECT stay_id, subject_id, least(greatest(los_hours, 0.0), {HORIZON}.0)::DOUBLE AS duration,
         CAST(CASE WHEN los_hours > {HORIZON} THEN 0 WHEN status = 'F' THEN 1 WHEN status = 'P' THEN 2 ELSE 0 END
              AS INTEGER) AS event,
         {split_sql('subject_id')} AS split
  FROM stays WHERE los_hours IS NOT NULL)"""

ST = f"""
customers AS (
  SELECT c_custkey AS stay_id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment, CAST(c_nationkey % 5 AS VARCHAR) AS zone,
         {split_sql('c_custkey')} AS split
  FROM customer)"""

CD = f"""
coded AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, p_brand AS code, o_orderdate AS coded_ts
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
code_stays AS (
  SELECT o_orderkey AS stay_id, o_custkey AS subject_id, o_orderdate AS anchor_ts, {split_sql('o_custkey')} AS split
  FROM orders)"""
