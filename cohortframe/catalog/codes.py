"""Queries over diagnosis codes, bound to the part brands a customer ordered."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import CD, Tables, query
from cohortframe.operators import codes as K, report
from cohortframe.operators.split import part_of
from cohortframe.plans import prepare

_PAST = "past AS (SELECT s.stay_id, s.split, c.code FROM code_stays s JOIN coded c USING (subject_id) WHERE c.coded_ts < s.anchor_ts)"
_TOP = """counted AS (SELECT code, count(*) AS n FROM past WHERE split = 'train' GROUP BY code),
vocab AS (SELECT code, n, row_number() OVER (ORDER BY n DESC, code) - 1 AS idx FROM counted
          QUALIFY row_number() OVER (ORDER BY n DESC, code) <= 10)"""


def _history_vocabulary(t: Tables, records):
    return K.top_codes(K.past_code_counts(part_of(t.code_stays, "train"), records), 10)


@query("code_history", f"WITH {CD}, {_PAST} SELECT DISTINCT stay_id, code FROM past")
def code_history(t: Tables):
    return K.past_codes(t.code_stays, t.coded)


@query("code_top_n", f"WITH {CD}, {_PAST}, {_TOP} SELECT code, n, CAST(idx AS INTEGER) AS code_idx FROM vocab")
def code_top_n(t: Tables):
    return _history_vocabulary(t, session.barrier(K.code_records(t.coded), "code_records"))


@query(
    "code_multi_hot",
    f"""WITH {CD}, {_PAST}, {_TOP}, has AS (SELECT DISTINCT stay_id, code FROM past)
    SELECT s.stay_id, string_agg(CASE WHEN h.code IS NULL THEN '0' ELSE '1' END, '' ORDER BY v.idx) AS bits
    FROM code_stays s CROSS JOIN vocab v LEFT JOIN has h ON h.stay_id = s.stay_id AND h.code = v.code GROUP BY 1""",
)
def code_multi_hot(t: Tables):
    records = session.barrier(K.code_records(t.coded), "code_records")
    vocab = session.held(_history_vocabulary(t, records))
    cells = K.code_cells(K.past_codes(t.code_stays, K.restrict_codes(records, vocab)), vocab)
    rows = K.vector_per_stay(t.code_stays.select("stay_id"), cells, vocab.count(), "icd")
    return rows.select("stay_id", F.array_join(F.transform("icd", lambda v: v.cast("int").cast("string")), "").alias("bits"))


@query(
    "code_current",
    f"WITH {CD} SELECT DISTINCT s.stay_id, c.code FROM code_stays s JOIN coded c ON c.subject_id = s.subject_id "
    "AND c.hadm_id = s.stay_id",
)
def code_current(t: Tables):
    return K.current_codes(t.code_stays, t.coded)


@query(
    "code_counts",
    """WITH pc AS (SELECT user_id AS subject_id, json_extract_string(props, '$.k') AS code FROM events),
    vocab AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) AS idx FROM pc GROUP BY code
              QUALIFY row_number() OVER (ORDER BY count(*) DESC, code) <= 20),
    n AS (SELECT subject_id, code, count(*) AS n FROM pc GROUP BY 1, 2)
    SELECT o_orderkey AS stay_id, string_agg(CAST(coalesce(n.n, 0) AS VARCHAR), ',' ORDER BY v.idx) AS counts
    FROM orders CROSS JOIN vocab v LEFT JOIN n ON n.subject_id = o_custkey AND n.code = v.code GROUP BY 1""",
)
def code_counts(t: Tables):
    coded = t.read("events").select(
        F.col("user_id").alias("subject_id"), F.get_json_object("props", "$.k").alias("code")
    )
    stays = t.code_stays.select("stay_id", "subject_id")
    counts = session.barrier(K.subject_counts(coded), "subject_counts")
    vocab = session.held(K.top_codes(K.total_counts(counts), 20))
    rows = K.vector_per_subject(stays, counts, vocab, vocab.count(), "n")
    return rows.select("stay_id", F.array_join(F.transform("n", lambda v: v.cast("int").cast("string")), ",").alias("counts"))


@query(
    "code_cells_of_stays",
    """WITH d AS (SELECT l_orderkey AS stay_id, p_brand AS code FROM lineitem JOIN part ON l_partkey = p_partkey),
    vocab AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) - 1 AS idx FROM d GROUP BY code
              QUALIFY row_number() OVER (ORDER BY count(*) DESC, code) <= 12)
    SELECT DISTINCT stay_id, CAST(idx AS INTEGER) AS pos, 1.0::DOUBLE AS value FROM d JOIN vocab USING (code)""",
)
def code_cells_of_stays(t: Tables):
    """Stand-alone multi-hot reshape: vocabulary over all rows, only stays that have a code."""
    diagnoses = t.coded.select(F.col("hadm_id").alias("stay_id"), F.col("code").alias("icd_code"))
    return prepare.ed_codes(diagnoses, 12)[1]


@query(
    "codes_per_stay_hist",
    f"""WITH {CD}, {_PAST}, n AS (
      SELECT s.stay_id, count(DISTINCT p.code)::DOUBLE AS v FROM code_stays s LEFT JOIN past p ON p.stay_id = s.stay_id GROUP BY 1),
    r AS (SELECT min(v) AS lo, max(v) AS hi FROM n),
    c AS (SELECT CAST(least(floor((v - lo) * 30.0 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n FROM n, r GROUP BY 1)
    SELECT CAST(range AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(30) LEFT JOIN c ON bin = range WHERE EXISTS (FROM c)""",
)
def codes_per_stay_hist(t: Tables):
    sums = K.past_code_sums(t.code_stays, t.coded)
    return report.histogram(session.barrier(report.codes_per_stay(t.code_stays, sums)), "n_codes", 30)


@query(
    "code_frequency",
    f"""WITH {CD}, {_PAST}, n AS (SELECT code, count(DISTINCT stay_id) AS n FROM past GROUP BY code),
    r AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, code) AS INTEGER) AS rank, code, n FROM n)
    SELECT rank, code, n FROM r""",
)
def code_frequency(t: Tables):
    return report.code_frequency(K.past_code_counts(t.code_stays, K.first_records(t.coded)))
