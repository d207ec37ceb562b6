"""The three data-set plans from raw tables to tensor rows, on raw tables derived from the test tables.

The raw tables are written once as SQL that both engines run; only the timestamp constructor differs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cohortframe import session
from cohortframe.catalog.base import Tables, query, r6, split_sql
from cohortframe.functions import scalars as S
from cohortframe.functions.fixed import APERIODIC_VITALS, ED_CATEGORIES, ED_NUMERIC, PERIODIC_VITALS
from cohortframe.operators import assemble
from cohortframe.params import Codes, Labels, Preparation, Reports, Windows
from cohortframe.plans import calendar_icu, emergency, offset_icu, prepare
from cohortframe.sources import tables

_DAY0 = 1_704_067_200_000_000  # 2024-01-01 in epoch microseconds
_START = f"({_DAY0} + (dayofyear(o_orderdate) % 30) * 86400000000)"

_AGE_TEXT = (
    "CASE WHEN floor(c_acctbal / 100) > 89 THEN '> 89' ELSE CAST(CAST(floor(c_acctbal / 100) AS INT) AS STRING) END"
)

OFFSET_RAW = {
    "patient": f"""SELECT c_custkey AS patientunitstayid, CAST(floor(c_custkey / 2.0) AS BIGINT) AS patienthealthsystemstayid,
      c_mktsegment AS gender, {_AGE_TEXT} AS age, CASE WHEN c_nationkey > 20 THEN NULL ELSE CAST(c_nationkey % 4 AS STRING) END
      AS ethnicity, 'type' AS unitstaytype, CAST(floor(abs(c_acctbal) * 3) AS BIGINT) AS unitdischargeoffset,
      CASE WHEN c_nationkey < 8 THEN 'Expired' WHEN c_nationkey < 22 THEN 'Alive' END AS hospitaldischargestatus
      FROM customer""",
    "vital_periodic": f"""SELECT user_id AS patientunitstayid, CAST(floor(({{us}}(CAST(ts AS TIMESTAMP)) - {_DAY0}) / 60000000.0) AS BIGINT) AS observationoffset,
      CASE WHEN event_type = 'view' THEN value END AS temperature, CASE WHEN event_type = 'click' THEN value END AS sao2,
      CASE WHEN event_type = 'purchase' THEN value END AS heartrate, CASE WHEN event_type = 'signup' THEN value / 2 END AS respiration,
      CASE WHEN event_type = 'view' THEN value + 100 END AS systemicsystolic, CAST(NULL AS DOUBLE) AS systemicdiastolic
      FROM events WHERE event_type <> 'error'""",
    "vital_aperiodic": f"""SELECT user_id AS patientunitstayid, CAST(floor(({{us}}(CAST(ts AS TIMESTAMP)) - {_DAY0}) / 60000000.0) AS BIGINT) AS observationoffset,
      value AS noninvasivesystolic, value / 2 AS noninvasivediastolic FROM events WHERE event_type = 'error'""",
    "lab": """SELECT o_custkey AS patientunitstayid, CAST(l_quantity * 400 AS BIGINT) AS labresultoffset,
      concat(l_returnflag, l_linestatus) AS labname, CASE WHEN l_discount < 0.09 THEN l_extendedprice END AS labresult
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

CALENDAR_RAW = {
    "icustays": f"""SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey AS stay_id, o_orderpriority AS first_careunit,
      {{ts}}({_START}) AS intime, {{ts}}(CAST({_START} + floor(o_totalprice) * 800000 AS BIGINT)) AS outtime FROM orders""",
    "patients": f"""SELECT c_custkey AS subject_id, c_mktsegment AS gender, CAST(floor(c_acctbal / 100) AS INT) AS anchor_age,
      CASE WHEN c_nationkey < 6 THEN {{ts}}({_DAY0} + c_nationkey * CAST(5 AS BIGINT) * 86400000000) END AS dod FROM customer""",
    "admissions": f"""SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, {{ts}}({_START} - 3600000000) AS admittime,
      CASE WHEN o_orderstatus <> 'O' THEN {{ts}}(CAST({_START} + floor(o_totalprice) * 1600000 AS BIGINT)) END AS dischtime,
      CASE WHEN o_orderpriority = '1-URGENT' THEN {{ts}}(CAST({_START} + floor(o_totalprice) * 1500000 AS BIGINT)) END AS deathtime,
      o_orderstatus AS admission_type, CAST(NULL AS STRING) AS admission_location FROM orders""",
    "chartevents": f"""SELECT l_orderkey AS stay_id, {{ts}}(CAST({_START} + l_quantity * 18000000000 - 3600000000 AS BIGINT)) AS charttime,
      CASE l_returnflag WHEN 'R' THEN 220045 WHEN 'A' THEN 220179 ELSE 99 END AS itemid, l_extendedprice / 1000 AS valuenum
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "labevents": """SELECT user_id AS subject_id, ts AS charttime, CASE event_type WHEN 'click' THEN 50912 WHEN 'view' THEN 50902
      WHEN 'error' THEN 50882 ELSE 98 END AS itemid, CASE WHEN value > 1 THEN value END AS valuenum FROM events""",
    "diagnoses": """SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, p_brand AS icd_code
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "radiology": f"""SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, {{ts}}({_START} + (n_chars % 300 - 20) * 3600000000) AS charttime,
      text FROM documents JOIN orders ON doc_id = o_orderkey""",
}

EMERGENCY_RAW = {
    "visits": """SELECT o_custkey AS MRN, o_orderkey AS CSN, floor(c_acctbal / 100) AS Age, 36.0 + c_nationkey / 10.0 AS Triage_Temp,
      CASE WHEN o_totalprice > 3000 THEN floor(o_totalprice / 5000) END AS Triage_HR, 16.0 AS Triage_RR, 97.0 AS Triage_SpO2,
      floor(o_totalprice / 3000) AS Triage_SBP, 80.0 AS Triage_DBP, CASE WHEN c_acctbal > 0 THEN 'F' END AS Gender,
      c_mktsegment AS Race, CAST(c_nationkey % 3 AS STRING) AS Ethnicity,
      CASE o_orderpriority WHEN '1-URGENT' THEN '1-Resuscitation' WHEN '2-HIGH' THEN '2-Emergent' WHEN '3-MEDIUM' THEN '3-Urgent'
        ELSE o_orderpriority END AS Triage_acuity, o_totalprice / 20000 AS ED_LOS,
      CASE o_orderstatus WHEN 'F' THEN 'ICU' WHEN 'P' THEN CASE WHEN c_nationkey < 12 THEN 'Inpatient' ELSE 'Observation' END
        ELSE CASE WHEN c_nationkey < 20 THEN 'Discharge' ELSE 'Left' END END AS ED_dispo
      FROM orders JOIN customer ON c_custkey = o_custkey""",
    "labs": f"""SELECT l_orderkey AS CSN, CAST({{ts}}(CAST({_START} + l_quantity * 600000000 AS BIGINT)) AS STRING) AS Result_time,
      CASE WHEN l_linenumber = 7 THEN 'seventh' ELSE l_returnflag END AS Component_name,
      CASE WHEN l_tax > 0.06 THEN '> 40' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS Component_value,
      CAST(round(l_extendedprice * 100) AS BIGINT) * 10 + l_linenumber AS seq FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "numerics": f"""SELECT l_orderkey AS CSN, CAST({{ts}}(CAST({_START} + l_linenumber * CAST(1500000000 AS BIGINT) AS BIGINT)) AS STRING) AS Time,
      CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'pulse' END AS Measure, l_extendedprice / 100 AS Value,
      CAST(round(l_extendedprice * 100) AS BIGINT) * 10 + l_linenumber AS seq FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pmh": """SELECT o_custkey AS MRN, p_brand AS Code
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "rads": "SELECT doc_id AS CSN, source AS Study, text AS Impression FROM documents",
}


def _raw(t: Tables, sources: dict, *names: str) -> dict[str, DataFrame]:
    bound = {n: t.read(n) for n in ["orders", "customer", "lineitem", "part", "events", "documents"]}

    def run(sql: str) -> DataFrame:
        text = sql.replace("{ts}", "timestamp_micros").replace("{us}", "unix_micros")
        used = {n: df for n, df in bound.items() if f" {n} " in f" {text} ".replace("\n", " ")}
        for n in used:
            for word in ("FROM", "JOIN"):
                text = f"{text} ".replace(f"{word} {n} ", f"{word} {{{n}}} ")
        return t.spark.sql(text.strip(), **used)

    return {name: run(sources[name]) for name in names or sources}


def _ctes(sources: dict) -> str:
    texts = {k: v.replace("{ts}", "make_timestamp").replace("{us}", "epoch_us") for k, v in sources.items()}
    return ",\n".join(f"{name} AS ({sql})" for name, sql in texts.items())


def _assembled_ctes(
    raw: dict, body: str, windows: Windows, denominator: str, block: str, numeric: Sequence[str],
    categorical: Sequence[str], trailing: Sequence[str] = (), least: float = 0.01,
) -> str:
    """From the CTEs ``cohort``, ``cells``, ``numeric`` and ``hot`` of ``body`` to the unrolled tensor, a row per window.

    Features stand by ``block`` (an SQL expression) and name, then numeric columns, levels by column, trailing columns.
    """
    fixed = [(c, 1, i) for i, c in enumerate(numeric)] + [(c, 3, i) for i, c in enumerate(trailing)]
    fixed_rows = " UNION ALL ".join(f"SELECT '{c}', {a}, {i}" for c, a, i in fixed)
    column = " ".join(f"WHEN feature LIKE '{c}\\_%' ESCAPE '\\' THEN {i}" for i, c in enumerate(categorical))
    counts = {
        "rows": "SELECT count(*) AS n FROM (SELECT DISTINCT stay_id, hour FROM tr)",
        "grid": f"SELECT count(*) * {windows.max_hours} AS n FROM cohort WHERE split = 'train'",
        "grid_nonempty": f"SELECT count(DISTINCT stay_id) * {windows.max_hours} AS n FROM tr",
    }
    return f"""WITH {_ctes(raw)}, {body},
tr AS (SELECT c.* FROM cells c JOIN cohort ON cohort.stay_id = c.stay_id WHERE split = 'train'),
den AS ({counts[denominator]}),
kept AS (SELECT feature FROM tr GROUP BY feature HAVING count(value) / (SELECT n::DOUBLE FROM den) >= {least}),
win AS (SELECT stay_id, CAST(floor(hour / {windows.window_hours}.0) AS INTEGER) AS w, feature, avg(value) AS value FROM cells
        WHERE value IS NOT NULL GROUP BY 1, 2, 3),
grid AS (SELECT c.stay_id, c.split, CAST(r.range AS INTEGER) AS w, k.feature, value FROM cohort c CROSS JOIN range({windows.num_windows}) r
         CROSS JOIN kept k LEFT JOIN win ON win.stay_id = c.stay_id AND win.w = r.range AND win.feature = k.feature),
scaler AS (SELECT feature, avg(coalesce(value, 0.0)) AS mean, stddev_pop(coalesce(value, 0.0)) AS sd FROM grid WHERE split = 'train'
           GROUP BY feature),
smean AS (SELECT feature, avg(value) AS mean FROM numeric_ n JOIN cohort c ON c.stay_id = n.stay_id WHERE split = 'train' GROUP BY 1),
levels AS (SELECT DISTINCT feature FROM hot),
flat AS (
  SELECT stay_id, w, g.feature, (coalesce(value, 0.0) - mean) / CASE WHEN sd > 1e-12 THEN sd ELSE 1 END AS value,
         CASE WHEN value IS NULL THEN 0 ELSE 1 END AS mask FROM grid g JOIN scaler s ON s.feature = g.feature
  UNION ALL
  SELECT n.stay_id, CAST(r.range AS INTEGER), n.feature, coalesce(n.value, s.mean, 0.0), CASE WHEN n.value IS NULL THEN 0 ELSE 1 END
  FROM numeric_ n LEFT JOIN smean s ON s.feature = n.feature CROSS JOIN range({windows.num_windows}) r
  UNION ALL
  SELECT c.stay_id, CAST(r.range AS INTEGER), l.feature, CASE WHEN h.feature IS NULL THEN 0.0 ELSE 1.0 END, 1
  FROM cohort c CROSS JOIN range({windows.num_windows}) r CROSS JOIN levels l
  LEFT JOIN hot h ON h.stay_id = c.stay_id AND h.feature = l.feature),
order_ AS (SELECT feature, 0 AS a, {block} AS b FROM kept UNION ALL {fixed_rows}
  UNION ALL SELECT feature, 2, CASE {column} END FROM levels),
place AS (SELECT feature, row_number() OVER (ORDER BY a, b, feature) AS k FROM order_),
windows AS (
SELECT f.stay_id, f.w AS "window", any_value(split) AS split, round(any_value(duration), 9) AS duration, any_value(event) AS event,
  string_agg(f.feature || '=' || CAST(CAST(round(CAST(f.value AS FLOAT)::DOUBLE * 10000) AS BIGINT) AS VARCHAR) || '/' || CAST(mask AS VARCHAR),
    ' ' ORDER BY k) AS cells
FROM flat f JOIN cohort c ON c.stay_id = f.stay_id JOIN place ON place.feature = f.feature GROUP BY f.stay_id, f.w)"""


def _assembled_sql(*args, **kwargs) -> str:
    return f"{_assembled_ctes(*args, **kwargs)} SELECT * FROM windows"


def _per_window(outputs: dict[str, DataFrame], *more: str) -> DataFrame:
    """One row per stay and window: every cell with its feature, value (four decimals) and mask, in feature order."""
    vocab = sorted(outputs["feature_vocab"].collect(), key=lambda r: r.idx)
    kept = ["stay_id", "split", "duration", "event", *more]
    rows = outputs["rows"].withColumn("duration", F.round("duration", 9)).select(*kept, "x", "mask")
    schema = StructType([*rows.schema[: len(kept)], StructField("window", IntegerType()), StructField("cells", StringType())])
    texts = rows.mapInArrow(_CellTexts([r.feature for r in vocab], len(kept)).run, schema)
    return texts.select("stay_id", "window", "split", "duration", "event", "cells", *more)


def _digits(numbers: np.ndarray) -> pa.Array:
    return pc.cast(pa.array(numbers), pa.string())


@dataclass
class _CellTexts:
    """Writes ``feature=value/mask`` of the cells of a batch, a feature at a time, and joins them by row and window."""

    names: list
    n_kept: int
    most_cells: int = 1_000_000

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                step = max(1, self.most_cells // max(1, len(batch.column(self.n_kept).flatten().flatten()) // batch.num_rows))
                for at in range(0, batch.num_rows, step):
                    yield self._rows(batch.slice(at, step))

    def _rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        x, mask = batch.column(self.n_kept), batch.column(self.n_kept + 1)
        windows = pc.list_value_length(x).to_numpy(zero_copy_only=False)
        steps = x.flatten()
        ten_thousandths = steps.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(steps), -1) * 10_000
        if not np.isfinite(ten_thousandths).all():
            raise ValueError("a cell is no finite number")
        # Half away from zero, as ``round`` has it.
        size = np.abs(ten_thousandths)
        whole = np.floor(size)
        values = (np.sign(ten_thousandths) * (whole + (size - whole >= 0.5))).astype(np.int64)
        seen = mask.flatten().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(values.shape)
        row = np.repeat(np.arange(batch.num_rows), windows)
        place = np.arange(len(steps)) - np.repeat(np.cumsum(windows) - windows, windows)
        # Static features are the same in every window of a row: their texts are made once and repeated.
        first = np.flatnonzero(place == 0)
        which = np.repeat(np.arange(len(first)), windows[windows > 0])
        fixed = ((values == values[first][which]) & (seen == seen[first][which])).all(axis=0)
        named = [i for i in range(min(len(self.names), values.shape[1])) if self.names[i] is not None]
        # The last argument of a join is what stands between the others.
        texts = []
        for once, places in groupby(named, lambda i: bool(fixed[i])):
            at = first if once else slice(None)
            cells = [
                pc.binary_join_element_wise(f"{self.names[i]}=", _digits(values[at, i]), "/", _digits(seen[at, i]), "") for i in places
            ]
            text = pc.binary_join_element_wise(*cells, " ")
            texts.append(text.take(pa.array(which)) if once else text)
        text = pc.binary_join_element_wise(*texts, " ") if texts else pa.array([""] * len(steps), pa.string())
        kept = [column.take(pa.array(row)) for column in batch.columns[: self.n_kept]]
        names = [*batch.schema.names[: self.n_kept], "window", "cells"]
        return pa.RecordBatch.from_arrays([*kept, pa.array(place.astype(np.int32)), text], names=names)


# --- offset ICU -------------------------------------------------------------------------------------------------------

_WIDE = Windows(10, 24)
_OFFSET = Preparation(windows=_WIDE, presence_denominator="rows")


def _vital_sql(table: str, columns: list) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    hourly = f"""SELECT patientunitstayid AS stay_id, CAST(floor(observationoffset / 60.0) AS INTEGER) AS hour, {means}
      FROM {table} WHERE observationoffset >= 0 AND observationoffset < {_WIDE.max_hours * 60} GROUP BY 1, 2"""
    return " UNION ALL ".join(f"SELECT stay_id, hour, '{c}' AS feature, {c} AS value FROM ({hourly})" for c in columns)


_OFFSET_BODY = f"""
cohort AS (
  SELECT patientunitstayid AS stay_id, TRY_CAST(age AS DOUBLE) AS age, gender, ethnicity, unitstaytype,
    least(unitdischargeoffset / 60.0, 240.0)::DOUBLE AS duration,
    CAST(CASE WHEN unitdischargeoffset / 60.0 > 240 THEN 0 WHEN hospitaldischargestatus = 'Expired' THEN 1 ELSE 0 END AS INTEGER) AS event,
    {split_sql('patienthealthsystemstayid')} AS split
  FROM patient WHERE TRY_CAST(age AS DOUBLE) >= 18 AND unitdischargeoffset / 60.0 >= 24),
lab_instant AS (SELECT patientunitstayid AS stay_id, CAST(floor(labresultoffset / 60.0) AS INTEGER) AS hour, labname AS feature,
    avg(labresult) AS value FROM lab WHERE labresult IS NOT NULL AND labresultoffset >= 0
    AND labresultoffset < {_WIDE.max_hours * 60} GROUP BY 1, 2, 3, labresultoffset),
all_cells AS ({_vital_sql('vital_periodic', PERIODIC_VITALS)} UNION ALL {_vital_sql('vital_aperiodic', APERIODIC_VITALS)}
  UNION ALL SELECT stay_id, hour, feature, avg(value) FROM lab_instant GROUP BY 1, 2, 3),
cells AS (SELECT * FROM all_cells WHERE stay_id IN (SELECT stay_id FROM cohort)),
numeric_ AS (SELECT stay_id, 'age' AS feature, age AS value FROM cohort),
hot AS (SELECT stay_id, 'gender_' || gender AS feature FROM cohort WHERE gender IS NOT NULL
  UNION ALL SELECT stay_id, 'ethnicity_' || ethnicity FROM cohort WHERE ethnicity IS NOT NULL
  UNION ALL SELECT stay_id, 'unitstaytype_' || unitstaytype FROM cohort WHERE unitstaytype IS NOT NULL)"""


_VITALS = [*PERIODIC_VITALS, *APERIODIC_VITALS]
_OFFSET_BLOCK = f"coalesce(list_position({_VITALS!r}, feature), {len(_VITALS) + 1})"


@query(
    "offset_icu_dataset",
    _assembled_sql(OFFSET_RAW, _OFFSET_BODY, _WIDE, "rows", _OFFSET_BLOCK, ["age"], ["gender", "ethnicity", "unitstaytype"]),
)
def offset_icu_dataset(t: Tables):
    return _per_window(offset_icu.prepare(**_raw(t, OFFSET_RAW), params=_OFFSET))


# --- calendar ICU -----------------------------------------------------------------------------------------------------

_CALENDAR = Preparation(
    windows=_WIDE, presence_denominator="grid", presence_threshold=0.0005, codes=Codes(top_n=12), reports=Reports(dim=16)
)

_CALENDAR_COHORT = f"""
ranked AS (SELECT i.*, row_number() OVER (PARTITION BY subject_id ORDER BY intime, stay_id) AS rn FROM icustays i),
joined AS (
  SELECT r.*, gender, anchor_age, dod, admission_type, dischtime, deathtime,
    (epoch_us(coalesce(deathtime, dod)) - epoch_us(intime)) / 3.6e9 AS to_death, (epoch_us(dischtime) - epoch_us(intime)) / 3.6e9 AS to_end
  FROM ranked r LEFT JOIN patients p ON p.subject_id = r.subject_id
  LEFT JOIN admissions a ON a.subject_id = r.subject_id AND a.hadm_id = r.hadm_id WHERE rn = 1),
cohort AS (
  SELECT stay_id, subject_id, hadm_id, intime, gender, first_careunit, admission_type, anchor_age,
    CASE WHEN coalesce(to_death <= 240, false) THEN greatest(to_death, 0.0)
         WHEN to_end IS NULL THEN NULL ELSE greatest(least(to_end, 240.0), 0.0) END::DOUBLE AS duration,
    CAST(coalesce(to_death <= 240, false) AS INTEGER) AS event, {split_sql('subject_id')} AS split
  FROM joined WHERE anchor_age >= 18 AND (epoch_us(outtime) - epoch_us(intime)) / 3.6e9 >= 24)"""

_CALENDAR_BODY = f"""{_CALENDAR_COHORT},
measured AS (
  SELECT c.stay_id, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 AS h,
    CASE itemid WHEN 220045 THEN 'Heart_Rate' ELSE 'Systolic_BP' END AS feature, valuenum AS value
  FROM chartevents e JOIN cohort c ON c.stay_id = e.stay_id WHERE itemid IN (220045, 220179)
  UNION ALL
  SELECT c.stay_id, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9,
    CASE itemid WHEN 50912 THEN 'Creatinine' WHEN 50902 THEN 'Chloride' ELSE 'Bicarbonate' END, valuenum
  FROM labevents e JOIN cohort c ON c.subject_id = e.subject_id WHERE itemid IN (50912, 50902, 50882)),
cells AS (SELECT stay_id, CAST(floor(h) AS INTEGER) AS hour, feature, avg(value) AS value FROM measured
  WHERE value IS NOT NULL AND h >= 0 AND h < {_WIDE.max_hours} GROUP BY 1, 2, 3),
numeric_ AS (SELECT stay_id, 'anchor_age' AS feature, anchor_age::DOUBLE AS value FROM cohort),
hot AS (SELECT stay_id, 'gender_' || gender AS feature FROM cohort UNION ALL SELECT stay_id, 'first_careunit_' || first_careunit FROM cohort
  UNION ALL SELECT stay_id, 'admission_type_' || admission_type FROM cohort)"""


@query(
    "calendar_icu_dataset",
    _assembled_sql(CALENDAR_RAW, _CALENDAR_BODY, _WIDE, "grid", "0", ["anchor_age"], ["gender", "first_careunit", "admission_type"], least=0.0005),
)
def calendar_icu_dataset(t: Tables):
    raw = _raw(t, CALENDAR_RAW, "icustays", "patients", "admissions", "chartevents", "labevents")
    return _per_window(calendar_icu.prepare(**raw, params=_CALENDAR))


_VOCAB = """counted AS (SELECT code, count(*) AS n FROM {past} GROUP BY code),
vocab AS (SELECT code, row_number() OVER (ORDER BY n DESC, code) - 1 AS idx FROM counted
  QUALIFY row_number() OVER (ORDER BY n DESC, code) <= 12)"""


def _bits(name: str):
    return F.array_join(F.transform(name, lambda v: v.cast("int").cast("string")), ",")


@query(
    "calendar_icu_codes",
    f"""WITH {_ctes(CALENDAR_RAW)}, {_CALENDAR_COHORT},
    past AS (SELECT c.stay_id, c.split, d.icd_code AS code FROM cohort c JOIN diagnoses d ON d.subject_id = c.subject_id
      JOIN admissions a ON a.hadm_id = d.hadm_id WHERE a.admittime < c.intime),
    {_VOCAB.format(past="past WHERE split = 'train'")},
    has AS (SELECT DISTINCT stay_id, code FROM past)
    SELECT c.stay_id, string_agg(CASE WHEN h.code IS NULL THEN '0' ELSE '1' END, ',' ORDER BY v.idx) AS codes
    FROM cohort c CROSS JOIN vocab v LEFT JOIN has h ON h.stay_id = c.stay_id AND h.code = v.code GROUP BY 1""",
)
def calendar_icu_codes(t: Tables):
    raw = _raw(t, CALENDAR_RAW, "icustays", "patients", "admissions", "diagnoses")
    out = calendar_icu.prepare(**raw, params=_CALENDAR, static=False)
    return out["rows"].select("stay_id", _bits("icd").alias("codes"))


_TOKENS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def _reports_sql(texts: str) -> str:
    return f"""{_reports_ctes(texts)} {_REPORTS_SELECT}"""


def _reports_select(texts: str) -> str:
    return f"""WITH {_reports_ctes(texts)} {_REPORTS_SELECT}"""


def _reports_ctes(texts: str) -> str:
    return f"""texts AS (SELECT stay_id, {_TOKENS.format('text')} AS w FROM ({texts})),
    n AS (SELECT stay_id, count(*) AS n FROM texts GROUP BY 1),
    s AS (SELECT stay_id, 1.0::DOUBLE / len(w) AS share, unnest(w) AS tok FROM texts WHERE len(w) > 0),
    b AS (SELECT stay_id, ('0x' || substr(md5(tok), 1, 13))::BIGINT % 16 AS pos, sum(share) AS v FROM s GROUP BY 1, 2)"""


_REPORTS_SELECT = """SELECT c.stay_id, CAST(p.range AS INTEGER) AS pos, CAST(CASE WHEN n.n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS has_radiology,
      round(CAST(coalesce(v / n.n, 0.0) AS FLOAT)::DOUBLE, 5) AS value
    FROM cohort c CROSS JOIN range(16) p LEFT JOIN n ON n.stay_id = c.stay_id
    LEFT JOIN b ON b.stay_id = c.stay_id AND b.pos = p.range"""


@query(
    "calendar_icu_reports",
    f"""WITH {_ctes(CALENDAR_RAW)}, {_CALENDAR_COHORT}, """
    + _reports_sql(
        """SELECT c.stay_id, text FROM radiology r JOIN cohort c ON c.subject_id = r.subject_id AND c.hadm_id = r.hadm_id
      WHERE epoch_us(charttime) >= epoch_us(intime) AND (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 < 240 AND text IS NOT NULL"""
    ),
)
def calendar_icu_reports(t: Tables):
    raw = _raw(t, CALENDAR_RAW, "icustays", "patients", "admissions", "radiology")
    out = calendar_icu.prepare(**raw, params=_CALENDAR, static=False)
    rows = out["rows"].select("stay_id", "has_radiology", F.posexplode("radiology").alias("pos", "v"))
    return rows.select("stay_id", "pos", "has_radiology", F.round(F.col("v").cast("double"), 5).alias("value"))


# --- emergency department ---------------------------------------------------------------------------------------------

_EMERGENCY = Preparation(
    windows=Windows(6, 1), labels=emergency.DEFAULTS.labels, codes=Codes(12, "count", "all", prefix="icd_"),
    reports=Reports(dim=16), presence_denominator="grid_nonempty",
)

_ED_COHORT = f"""
valid AS (
  SELECT *, CASE ED_dispo WHEN 'Discharge' THEN 0 WHEN 'ICU' THEN 1 WHEN 'Inpatient' THEN 2 ELSE 3 END AS outcome FROM visits
  WHERE Race IS NOT NULL AND Ethnicity IS NOT NULL AND Triage_HR IS NOT NULL AND Triage_acuity IS NOT NULL AND ED_LOS IS NOT NULL
    AND ED_dispo IN ('Discharge', 'ICU', 'Inpatient', 'Observation') AND ED_LOS <= 24),
cohort AS (SELECT CSN AS stay_id, MRN AS subject_id, ED_LOS::DOUBLE AS duration, CAST(outcome AS INTEGER) AS event, v.* EXCLUDE (CSN, MRN),
    {split_sql('MRN')} AS split FROM valid v)"""


def _firsts_sql(name: str, table: str, time: str, feature: str, value: str) -> str:
    return f"""{name}_first AS (SELECT CSN AS stay_id, TRY_CAST({time} AS TIMESTAMP) AS instant, {feature} AS feature, arg_min({value}, seq) AS value
      FROM {table} WHERE {value} IS NOT NULL AND CSN IN (SELECT stay_id FROM cohort) GROUP BY 1, 2, 3),
    {name}_kept AS (SELECT feature FROM {name}_first GROUP BY feature
      HAVING 1 - count(*) / (SELECT count(*)::DOUBLE FROM (SELECT DISTINCT stay_id, instant FROM {name}_first)) < 0.95)"""


_ED_BODY = f"""{_ED_COHORT},
{_firsts_sql('lab', 'labs', 'Result_time', 'Component_name', 'Component_value')},
{_firsts_sql('vital', 'numerics', 'Time', 'Measure', 'Value')},
measured AS (
  SELECT stay_id, instant, feature, TRY_CAST(value AS DOUBLE) AS value FROM lab_first
  WHERE feature IN (SELECT feature FROM lab_kept) AND TRY_CAST(value AS DOUBLE) IS NOT NULL
  UNION ALL SELECT stay_id, instant, feature, value FROM vital_first WHERE feature IN (SELECT feature FROM vital_kept)),
timed AS (SELECT *, (epoch_us(instant) - epoch_us(min(instant) OVER (PARTITION BY stay_id))) / 3.6e9 AS h FROM measured),
cells AS (SELECT stay_id, CAST(ceil(h) AS INTEGER) AS hour, feature, avg(value) AS value FROM timed WHERE ceil(h) < 6 GROUP BY 1, 2, 3),
numeric_ AS (
  SELECT stay_id, unnest(['Age', 'Triage_Temp', 'Triage_HR', 'Triage_RR', 'Triage_SpO2', 'Triage_SBP', 'Triage_DBP', 'Triage_acuity_ordinal']) AS feature,
    unnest([Age, Triage_Temp, Triage_HR, Triage_RR, Triage_SpO2, Triage_SBP, Triage_DBP,
      CASE Triage_acuity WHEN '1-Resuscitation' THEN 5 WHEN '2-Emergent' THEN 4 WHEN '3-Urgent' THEN 3 ELSE -1 END]::DOUBLE[]) AS value
  FROM cohort),
hot AS (SELECT stay_id, 'Race_' || Race AS feature FROM cohort UNION ALL SELECT stay_id, 'Gender_' || Gender FROM cohort WHERE Gender IS NOT NULL
  UNION ALL SELECT stay_id, 'Ethnicity_' || Ethnicity FROM cohort)"""


_ED_BLOCK = "CASE WHEN feature IN (SELECT feature FROM lab_kept) THEN 0 ELSE 1 END"
_ED_CTES = _assembled_ctes(
    EMERGENCY_RAW, _ED_BODY, Windows(6, 1), "grid_nonempty", _ED_BLOCK, ED_NUMERIC, ED_CATEGORIES, ["Triage_acuity_ordinal"]
)


@query("emergency_dataset", f"{_ED_CTES} SELECT * FROM windows")
def emergency_dataset(t: Tables):
    return _per_window(emergency.prepare(**_raw(t, EMERGENCY_RAW, "visits", "labs", "numerics"), params=_EMERGENCY))


@query(
    "emergency_codes",
    f"""WITH {_ctes(EMERGENCY_RAW)}, {_ED_COHORT}, mine AS (SELECT MRN, Code AS code FROM pmh WHERE MRN IN (SELECT MRN FROM valid)),
    {_VOCAB.format(past="mine")}, n AS (SELECT MRN, code, count(*) AS k FROM mine GROUP BY 1, 2)
    SELECT c.stay_id, string_agg(CAST(coalesce(n.k, 0) AS VARCHAR), ',' ORDER BY v.idx) AS codes
    FROM cohort c CROSS JOIN vocab v LEFT JOIN n ON n.MRN = c.subject_id AND n.code = v.code GROUP BY 1""",
)
def emergency_codes(t: Tables):
    out = emergency.prepare(**_raw(t, EMERGENCY_RAW, "visits", "pmh"), params=_EMERGENCY, static=False)
    return out["rows"].select("stay_id", _bits("icd").alias("codes"))


@query(
    "emergency_reports",
    f"""WITH {_ctes(EMERGENCY_RAW)}, {_ED_COHORT}, """
    + _reports_sql(
        "SELECT CSN AS stay_id, Study || ' ' || Impression AS text FROM rads WHERE CSN IN (SELECT stay_id FROM cohort)"
    ),
)
def emergency_reports(t: Tables):
    out = emergency.prepare(**_raw(t, EMERGENCY_RAW, "visits", "rads"), params=_EMERGENCY, static=False)
    rows = out["rows"].select("stay_id", "has_radiology", F.posexplode("radiology").alias("pos", "v"))
    return rows.select("stay_id", "pos", "has_radiology", F.round(F.col("v").cast("double"), 5).alias("value"))


@query(
    "emergency_all_parts",
    f"""{_ED_CTES}, mine AS (SELECT MRN, Code AS code FROM pmh WHERE MRN IN (SELECT MRN FROM valid)),
    {_VOCAB.format(past="mine")}, per_code AS (SELECT MRN, code, count(*) AS k FROM mine GROUP BY 1, 2),
    coded AS (SELECT c.stay_id, string_agg(CAST(coalesce(n.k, 0) AS VARCHAR), ',' ORDER BY v.idx) AS codes
      FROM cohort c CROSS JOIN vocab v LEFT JOIN per_code n ON n.MRN = c.subject_id AND n.code = v.code GROUP BY 1),
    reported AS ({_reports_select("SELECT CSN AS stay_id, Study || ' ' || Impression AS text FROM rads WHERE CSN IN (SELECT stay_id FROM cohort)")}),
    vectors AS (SELECT stay_id, string_agg(CAST(CAST(round(value * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS radiology FROM reported GROUP BY 1)
    SELECT w.*, codes, radiology, CAST(3 AS INTEGER) AS n_events, CAST(12 AS INTEGER) AS n_codes,
      (SELECT count(*) FROM scaler) AS n_scaled, list_aggregate(['timeseries', 'static', 'icd', 'radiology'], 'string_agg', ',') AS parts
    FROM windows w JOIN coded USING (stay_id) JOIN vectors USING (stay_id)""",
)
def emergency_all_parts(t: Tables):
    """One data set with series, static columns, codes and reports, written and read back with its small tables."""
    path = session.fresh_path(t.spark, "dataset")
    tables.write_dataset(emergency.prepare(**_raw(t, EMERGENCY_RAW, "visits", "labs", "numerics", "pmh", "rads"), params=_EMERGENCY), path)
    out = tables.read_dataset(t.spark, path)
    info = out["run_info"].first()
    vector = F.transform("radiology", lambda v: F.round(F.round(v.cast("double"), 5) * 1000).cast("bigint").cast("string"))
    # Texts of a stay are made before it becomes a row per window.
    rows = out["rows"].withColumns({"codes": _bits("icd"), "radiology": F.array_join(vector, ",")})
    return _per_window(out | {"rows": rows}, "radiology", "codes").withColumns(
        {
            "n_events": F.lit(info.n_events), "n_codes": F.lit(info.n_codes), "n_scaled": F.lit(out["scaler_params"].count()).cast("bigint"),
            "parts": F.lit(",".join(info.active_modalities)),
        }
    )


# --- stand-alone reshapes ---------------------------------------------------------------------------------------------


@query(
    "item_series",
    f"""WITH {_ctes(CALENDAR_RAW)}, j AS (SELECT a.hadm_id, (epoch_us(charttime) - epoch_us(admittime)) / 3.6e9 AS h, itemid, valuenum
      FROM chartevents c JOIN admissions a ON a.hadm_id = c.stay_id)
    SELECT hadm_id, round(h, 6) AS time_hours, round(avg(valuenum) FILTER (WHERE itemid = 220045), 6) AS heart_rate,
      round(avg(valuenum) FILTER (WHERE itemid = 220179), 6) AS nibp
    FROM j WHERE itemid IN (220045, 220179) AND h >= 0 GROUP BY hadm_id, h""",
)
def item_series(t: Tables):
    """Chart events per admission and hour, one column per item."""
    raw = _raw(t, CALENDAR_RAW, "chartevents", "admissions")
    events = raw["chartevents"].withColumnRenamed("stay_id", "hadm_id")
    wide = prepare.item_series(events, raw["admissions"], {220045: "heart_rate", 220179: "nibp"})
    return wide.select("hadm_id", *[r6(c).alias(c) for c in ["time_hours", "heart_rate", "nibp"]])


@query(
    "vitals_and_labs_series",
    f"""WITH {_ctes(CALENDAR_RAW)}, both_ AS (
      SELECT i.stay_id, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 AS h, valuenum AS hr, NULL::DOUBLE AS lab
      FROM chartevents c JOIN icustays i ON i.stay_id = c.stay_id WHERE itemid = 220045
      UNION ALL SELECT i.stay_id, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9, NULL, valuenum
      FROM chartevents c JOIN icustays i ON i.stay_id = c.stay_id WHERE itemid = 220179)
    SELECT stay_id, round(h, 6) AS time_hours, round(avg(hr), 6) AS hr, round(avg(lab), 6) AS lab FROM both_ WHERE h >= 0
    GROUP BY stay_id, h""",
)
def vitals_and_labs_series(t: Tables):
    """Two wide tables of one item each on one time axis; readings of the same moment are averaged."""
    raw = _raw(t, CALENDAR_RAW, "chartevents", "icustays")

    # Written once: each of the two tables would join line items and orders anew.
    charted = session.barrier(raw["chartevents"].where(F.col("itemid").isin(220045, 220179)), "charted")

    def wide(item: int, name: str) -> DataFrame:
        kept = charted.where(F.col("itemid") == item)
        return kept.select("stay_id", "charttime", F.col("valuenum").alias(name))

    series = prepare.ed_series(wide(220045, "hr"), wide(220179, "lab"), raw["icustays"])
    return series.select("stay_id", *[r6(c).alias(c) for c in ["time_hours", "hr", "lab"]])
