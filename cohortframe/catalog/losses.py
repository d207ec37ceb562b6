"""What the plans leave out, by input and reason."""

from __future__ import annotations

from cohortframe.catalog.base import Tables, query
from cohortframe.catalog.datasets import (
    _CALENDAR, _CALENDAR_COHORT, _ED_BODY, _EMERGENCY, _OFFSET, _OFFSET_BODY, CALENDAR_RAW, EMERGENCY_RAW, OFFSET_RAW, _ctes, _raw,
)
from cohortframe.plans import calendar_icu, emergency, offset_icu


def _sql(raw: dict, body: str, inputs: dict[str, tuple[str, list[tuple[str, str]]]]) -> str:
    """From (relation, [(reason, condition), ...]) of each input: rows read, lost by the first reason that holds, kept."""
    coded, named = [], []
    for name, (relation, reasons) in inputs.items():
        case = " ".join(f"WHEN {c} THEN {i}" for i, (_, c) in enumerate(reasons, 1))
        coded.append(f"SELECT '{name}' AS input, CASE {case} ELSE {len(reasons) + 1} END AS step FROM {relation}")
        named += [f"('{name}', {i}, '{r}')" for i, r in enumerate(["read", *[r for r, _ in reasons], "kept"])]
    return f"""WITH {_ctes(raw)}, {body}, coded AS ({" UNION ALL ".join(coded)}),
    n AS (SELECT input, step, count(*) AS n FROM coded GROUP BY 1, 2 UNION ALL SELECT input, 0, count(*) FROM coded GROUP BY 1),
    r AS (SELECT * FROM (VALUES {", ".join(named)}) v(input, step, reason))
    SELECT r.input, CAST(r.step AS INTEGER) AS step, reason, CAST(coalesce(n, 0) AS BIGINT) AS "rows"
    FROM r LEFT JOIN n ON n.input = r.input AND n.step = r.step"""


def _vitals(offset: str) -> list[tuple[str, str]]:
    return [
        ("no time", f"{offset} IS NULL"), ("outside the window", f"NOT ({offset} / 60.0 >= 0 AND {offset} / 60.0 < 240)"),
        ("of no stay in the cohort", "patientunitstayid NOT IN (SELECT stay_id FROM cohort)"),
    ]


@query(
    "offset_icu_losses",
    _sql(OFFSET_RAW, _OFFSET_BODY, {
        "patient": ("patient", [
            ("age is no number", "TRY_CAST(age AS DOUBLE) IS NULL"), ("age below 18", "TRY_CAST(age AS DOUBLE) < 18"),
            ("stay too short or without end", "unitdischargeoffset IS NULL OR unitdischargeoffset / 60.0 < 24"),
        ]),
        "vital_periodic": ("vital_periodic", _vitals("observationoffset")), "vital_aperiodic": ("vital_aperiodic", _vitals("observationoffset")),
        "lab": ("lab", [("no value", "labresult IS NULL"), *_vitals("labresultoffset")]),
    }),
)
def offset_icu_losses(t: Tables):
    return offset_icu.prepare(**_raw(t, OFFSET_RAW), params=_OFFSET)["losses"]


def _listed(items: str) -> list[tuple[str, str]]:
    return [("item not listed", f"itemid NOT IN ({items})"), ("no value", "valuenum IS NULL"), ("no time", "charttime IS NULL")]


@query(
    "calendar_icu_losses",
    _sql(CALENDAR_RAW, f"""{_CALENDAR_COHORT},
      stays AS (SELECT r.*, anchor_age FROM ranked r LEFT JOIN patients p ON p.subject_id = r.subject_id),
      charted AS (SELECT e.*, c.stay_id AS own, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 AS h
        FROM chartevents e LEFT JOIN cohort c ON c.stay_id = e.stay_id),
      lab AS (SELECT e.*, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 AS h FROM labevents e LEFT JOIN cohort c ON c.subject_id = e.subject_id),
      report AS (SELECT r.*, c.stay_id AS own, (epoch_us(charttime) - epoch_us(intime)) / 3.6e9 AS h
        FROM radiology r LEFT JOIN cohort c ON c.subject_id = r.subject_id AND c.hadm_id = r.hadm_id)""", {
        "icustays": ("stays", [
            ("later stay of the patient or no start", "rn > 1"), ("age below 18 or unknown", "NOT coalesce(anchor_age >= 18, false)"),
            ("stay too short or without end", "NOT coalesce((epoch_us(outtime) - epoch_us(intime)) / 3.6e9 >= 24, false)"),
        ]),
        "chartevents": ("charted", [
            *_listed("220045, 220179"), ("of no stay in the cohort", "own IS NULL"), ("outside the window", "NOT (h >= 0 AND h < 240)"),
        ]),
        "labevents": ("lab", [
            *_listed("50912, 50902, 50882"), ("outside the window of a stay in the cohort", "NOT coalesce(h >= 0 AND h < 240, false)"),
        ]),
        "radiology": ("report", [
            ("no text", "text IS NULL"), ("no time", "charttime IS NULL"), ("of no stay in the cohort", "own IS NULL"),
            ("outside the window", "NOT (h >= 0 AND h < 240)"),
        ]),
    }),
)
def calendar_icu_losses(t: Tables):
    raw = _raw(t, CALENDAR_RAW, "icustays", "patients", "admissions", "chartevents", "labevents", "radiology")
    return calendar_icu.prepare(**raw, params=_CALENDAR)["losses"]


def _ranked(name: str, table: str, time: str, feature: str, value: str) -> str:
    return f"""{name}_rows AS (SELECT *, {time} AS t, TRY_CAST({time} AS TIMESTAMP) AS instant, {feature} AS f, {value} AS v,
      row_number() OVER (PARTITION BY CSN, TRY_CAST({time} AS TIMESTAMP), {feature}, {value} IS NULL ORDER BY seq) AS place FROM {table})"""


_SERIES = [
    ("no value", "v IS NULL"), ("no feature", "f IS NULL"), ("no time", "t IS NULL"), ("time unreadable", "instant IS NULL"),
    ("of no stay in the cohort", "CSN NOT IN (SELECT stay_id FROM cohort)"), ("later value of the same instant", "place > 1"),
]


@query(
    "emergency_losses",
    _sql(EMERGENCY_RAW, f"""{_ED_BODY},
      {_ranked('lab', 'labs', 'Result_time', 'Component_name', 'Component_value')},
      {_ranked('vital', 'numerics', 'Time', 'Measure', 'Value')},
      firsts AS (
        SELECT stay_id, instant, feature, TRY_CAST(value AS DOUBLE) AS value, feature IN (SELECT feature FROM lab_kept) AS filled FROM lab_first
        UNION ALL SELECT stay_id, instant, feature, value, feature IN (SELECT feature FROM vital_kept) FROM vital_first),
      placed AS (SELECT *, (epoch_us(instant) - epoch_us(min(instant) FILTER (filled AND value IS NOT NULL) OVER (PARTITION BY stay_id))) / 3.6e9 AS h
        FROM firsts)""", {
        "visits": ("visits", [
            ("a required column is empty", "Race IS NULL OR Ethnicity IS NULL OR Triage_HR IS NULL OR Triage_acuity IS NULL OR ED_LOS IS NULL OR ED_dispo IS NULL"),
            ("outcome not listed", "ED_dispo NOT IN ('Discharge', 'ICU', 'Inpatient', 'Observation')"), ("stay beyond the horizon", "ED_LOS > 24"),
            ("stay too short", "ED_LOS < 0"),
        ]),
        "labs": ("lab_rows", _SERIES), "numerics": ("vital_rows", _SERIES),
        "first values": ("placed", [
            ("no number", "value IS NULL"), ("feature nearly always empty", "NOT filled"), ("outside the window", "NOT (h >= 0 AND h <= 6)"),
        ]),
    }),
)
def emergency_losses(t: Tables):
    return emergency.prepare(**_raw(t, EMERGENCY_RAW, "visits", "labs", "numerics"), params=_EMERGENCY)["losses"]
