"""Queries over static features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import ST, Tables, query, r6
from cohortframe.functions import scalars as S
from cohortframe.operators import codes as K, static as static_ops, transform
from cohortframe.operators.split import part_of
from cohortframe.plans import prepare

_LEVELS = """
levels AS (SELECT DISTINCT 'segment' AS c, 1 AS ci, segment AS l FROM customers WHERE segment IS NOT NULL
           UNION ALL SELECT DISTINCT 'zone', 2, zone FROM customers WHERE zone IS NOT NULL),
vocab AS (SELECT c, ci, l, c || '_' || l AS feature, row_number() OVER (PARTITION BY c ORDER BY l) AS k FROM levels),
hot AS (SELECT stay_id, 'segment_' || segment AS feature FROM customers WHERE segment IS NOT NULL
        UNION ALL SELECT stay_id, 'zone_' || zone FROM customers WHERE zone IS NOT NULL)"""
CATEGORIES = ["segment", "zone"]


@query("one_hot", f"WITH {ST}, {_LEVELS} SELECT stay_id, feature, 1.0::DOUBLE AS value FROM hot")
def one_hot(t: Tables):
    return static_ops.one_hot(t.customers, CATEGORIES)


@query(
    "one_hot_drop_first",
    f"""WITH {ST}, {_LEVELS} SELECT stay_id, feature, 1.0::DOUBLE AS value FROM hot
    WHERE feature IN (SELECT feature FROM vocab WHERE k > 1)""",
)
def one_hot_drop_first(t: Tables):
    vocabulary = session.small(static_ops.level_vocabulary(t.customers, CATEGORIES, drop_first=True))
    return static_ops.one_hot(t.customers, CATEGORIES, vocabulary)


@query(
    "ordinal_map",
    """SELECT o_orderkey AS stay_id, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
      WHEN '3-MEDIUM' THEN 3 ELSE -1 END AS INTEGER) AS acuity FROM orders""",
)
def ordinal_map(t: Tables):
    acuity = S.lookup("o_orderpriority", {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3}, -1)
    return t.read("orders").select(F.col("o_orderkey").alias("stay_id"), acuity.alias("acuity"))


@query(
    "static_select",
    "SELECT c_custkey AS stay_id, c_acctbal, c_mktsegment, c_nationkey FROM customer",
)
def static_select(t: Tables):
    return static_ops.select_static(t.read("customer"), ["c_name"]).withColumnRenamed("c_custkey", "stay_id")


@query(
    "prefixed_names",
    """WITH c AS (SELECT p_brand AS code, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    r AS (SELECT code, n, row_number() OVER (ORDER BY n DESC, code) AS k FROM c)
    SELECT 'ICD_' || code AS feature, n, CAST(k - 1 AS INTEGER) AS code_idx FROM r WHERE k <= 15""",
)
def prefixed_names(t: Tables):
    vocab = K.top_codes(K.code_counts(t.coded), 15)
    return vocab.select(F.concat(F.lit("ICD_"), "code").alias("feature"), "n", "code_idx")


@query(
    "impute_static_mean",
    f"""WITH {ST} SELECT stay_id, round(coalesce(balance, (SELECT avg(balance) FROM customers WHERE split = 'train')), 6)
      AS balance FROM customers""",
)
def impute_static_mean(t: Tables):
    customers = t.customers
    means = transform.static_means(static_ops.numeric_features(customers, ["balance"]), part_of(customers, "train"))
    mean = means.select(F.coalesce("mean", F.lit(0.0))).scalar()
    filled = customers.withColumn("mean", mean).withColumn("balance", F.coalesce("balance", "mean"))
    return filled.select("stay_id", r6("balance").alias("balance"))


@query(
    "static_matrix",
    f"""WITH {ST}, {_LEVELS},
    order_ AS (SELECT 'balance' AS feature, 0 AS b, 0 AS k UNION ALL SELECT feature, ci, k FROM vocab),
    idx AS (SELECT feature, CAST(row_number() OVER (ORDER BY b, k) - 1 AS INTEGER) AS idx FROM order_),
    m AS (SELECT avg(balance) AS mean FROM customers WHERE split = 'train')
    SELECT c.stay_id, i.idx,
      round(CAST(CASE WHEN i.feature = 'balance' THEN coalesce(balance, (SELECT mean FROM m))
            WHEN h.feature IS NULL THEN 0.0 ELSE 1.0 END AS FLOAT)::DOUBLE, 6) AS value,
      CAST(CASE WHEN i.feature = 'balance' AND balance IS NULL THEN 0 ELSE 1 END AS INTEGER) AS mask
    FROM customers c CROSS JOIN idx i LEFT JOIN hot h ON h.stay_id = c.stay_id AND h.feature = i.feature""",
)
def static_matrix(t: Tables):
    """The static-only matrix, unrolled."""
    customers = t.customers
    blocks = static_ops.static_blocks(customers, ["balance"], CATEGORIES, train=part_of(customers, "train"))
    matrix = static_ops.with_static_arrays(customers, blocks)
    both = matrix.select("stay_id", F.posexplode(F.arrays_zip("static", "static_mask")).alias("idx", "z"))
    return both.select("stay_id", "idx", r6(F.col("z.static").cast("double")).alias("value"), F.col("z.static_mask").cast("int").alias("mask"))


@query(
    "demographics_long",
    """WITH p AS (SELECT c_custkey AS subject_id, c_mktsegment AS gender, CAST(floor(c_acctbal) AS INTEGER) AS age FROM customer),
    s AS (SELECT o_orderkey AS stay_id, gender, age FROM orders LEFT JOIN p ON o_custkey = subject_id),
    v AS (SELECT gender, row_number() OVER (ORDER BY gender) AS k FROM (SELECT DISTINCT gender FROM s WHERE gender IS NOT NULL))
    SELECT stay_id, 'age' AS feature, age::DOUBLE AS value FROM s WHERE age IS NOT NULL
    UNION ALL SELECT stay_id, 'gender_' || s.gender, 1.0::DOUBLE FROM s JOIN v ON s.gender = v.gender WHERE k > 1""",
)
def demographics_long(t: Tables):
    """Patient demographics joined to stays and encoded without the first level."""
    patients = t.read("customer").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("gender"),
        F.floor("c_acctbal").cast("int").alias("anchor_age"),
    )
    edstays = t.read("orders").select(F.col("o_orderkey").alias("stay_id"), F.col("o_custkey").alias("subject_id"))
    rows, _ = prepare.ed_static(patients, edstays)
    return rows.select("stay_id", "feature", "value")
