"""The plans with parts switched on and off, on small raw tables in the sources' own schemas."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.params import Codes, Labels, Preparation, Split, Windows
from cohortframe.plans import calendar_icu, emergency, offset_icu, prepare
from cohortframe.sources import schemas, tables

T0 = dt.datetime(2024, 1, 1)
N = 40
SMALL = Preparation(labels=Labels(n_time_bins=4), split=Split(exact=True))


@pytest.fixture(scope="module")
def offset(frame):
    patient = [
        (i, i, "F" if i % 2 else "M", "> 89" if i == 39 else str(17 + i % 50), "e" if i % 5 else None, "u",
         (20 + 10 * i) * 60, "Expired" if i % 3 == 0 else "Alive") for i in range(N)
    ]
    periodic = [(i, 60 * h + 5, 36.0 + i + h, None, 80.0, None, None, None) for i in range(N) for h in range(0, 30, 3) if i != 5]
    aperiodic = [(i, 90, 120.0, 70.0) for i in range(0, N, 2)]
    lab = [(i, 30 * k, "glucose" if k else "rare", 5.0 + k) for i in range(N) for k in range(3)]
    return dict(
        patient=frame(schemas.PATIENT, patient),
        vital_periodic=frame(schemas.VITAL_PERIODIC, periodic),
        vital_aperiodic=frame(schemas.VITAL_APERIODIC, aperiodic),
        lab=frame(schemas.LAB, lab),
    )


def test_offset_plan(offset):
    out = offset_icu.prepare(**offset, params=SMALL)
    rows = out["rows"].collect()
    ids = [r.stay_id for r in rows]
    assert len(ids) == len(set(ids)) and 39 not in ids and 0 not in ids and 5 in ids
    info = out["run_info"].first()
    assert all(len(r.x) == 6 and len(r.x[0]) == info.n_dynamic + info.n_static for r in rows)
    vocab = [r.feature for r in out["feature_vocab"].orderBy("idx").collect()]
    assert vocab[:6] == ["temperature", "heartrate", "noninvasivesystolic", "noninvasivediastolic", "glucose", "rare"]
    assert vocab[6:] == ["age", "gender_F", "gender_M", "ethnicity_e", "unitstaytype_u"]
    quiet = next(r for r in rows if r.stay_id == 5)
    fill = {r.feature: -r["mean"] / r.scale for r in out["scaler_params"].collect()}
    assert quiet.mask[5][:6] == [0.0] * 6
    assert quiet.x[5][0] == pytest.approx(fill["temperature"], rel=1e-6)
    train = [r for r in rows if r.split == "train"]
    for k in range(6):
        column = [w[k] for r in train for w in r.x]
        mean = sum(column) / len(column)
        std = (sum((v - mean) ** 2 for v in column) / len(column)) ** 0.5
        assert mean == pytest.approx(0, abs=1e-5) and (std == pytest.approx(1, abs=1e-4) or std == pytest.approx(0, abs=1e-6))
    assert {r.split for r in rows} == {"train", "val", "test"}
    cuts = [r.cut for r in out["cuts"].orderBy("cut_idx").collect()]
    assert cuts[0] == 0 and cuts == sorted(set(cuts))


def test_without_static_and_static_only(offset):
    series = offset_icu.prepare(**offset, params=SMALL, static=False)
    assert series["run_info"].first().n_static == 0
    assert len(series["rows"].first().x[0]) == series["run_info"].first().n_dynamic
    only = offset_icu.prepare(offset["patient"], None, None, None, params=SMALL)
    row = only["rows"].first()
    assert len(row.static) == len(row.static_mask) == 5 and "x" not in only["rows"].columns
    assert only["run_info"].first().active_modalities == ["static"]


def test_scaling_off_and_missing_left_at_zero(offset):
    out = offset_icu.prepare(**offset, params=dataclasses.replace(SMALL, scaling="none"))
    assert "scaler_params" not in out
    quiet = out["rows"].where("stay_id = 5").first()
    assert quiet.x[0][0] == 0.0


def test_write_and_read_back(spark, offset):
    out = offset_icu.prepare(**offset, params=SMALL)
    path = tables.write_dataset(out, session.fresh_path(spark, "test-dataset"))
    names = ["rows", "feature_vocab", "cuts", "scaler_params", "run_info"]
    back = tables.read_dataset(spark, path, names)
    assert back["rows"].count() == out["rows"].count()
    assert "PartitionFilters: [isnotnull(split" in back["rows"].where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert back["feature_vocab"].count() == out["feature_vocab"].count()


@pytest.fixture(scope="module")
def calendar(frame):
    h = dt.timedelta(hours=1)
    icustays = [(i // 2, 1000 + i, i, "MICU" if i % 3 else "SICU", T0 + 24 * i * h, T0 + (24 * i + 30) * h) for i in range(N)]
    patients = [(s, "F", 40 + s, None) for s in range(N // 2)]
    admissions = [(i // 2, 1000 + i, T0 + (24 * i - 2) * h, T0 + (24 * i + 90) * h, T0 + (24 * i + 50) * h if i % 4 == 0 else None,
                   "URGENT", None) for i in range(N)]
    chart = [(i, T0 + (24 * i + k) * h, 220045 if k % 2 else 1, float(60 + k)) for i in range(N) for k in range(26)]
    labs = [(i // 2, T0 + (24 * i + 3) * h, 50912, 1.0 + i) for i in range(N)]
    diagnoses = [(i // 2, 1000 + i, f"0{i % 4}") for i in range(N)]
    radiology = [(i // 2, 1000 + i, T0 + (24 * i + 1) * h, "clear lungs" if i % 3 else None) for i in range(N)]
    return dict(
        icustays=frame(schemas.ICUSTAYS, icustays), patients=frame(schemas.PATIENTS, patients),
        admissions=frame(schemas.ADMISSIONS, admissions), chartevents=frame(schemas.CHARTEVENTS, chart),
        labevents=frame(schemas.LABEVENTS, labs), diagnoses=frame(schemas.DIAGNOSES, diagnoses),
        radiology=frame(schemas.RADIOLOGY, radiology),
    )


def test_calendar_plan(calendar):
    params = dataclasses.replace(SMALL, presence_denominator="grid", codes=Codes(top_n=3))
    out = calendar_icu.prepare(**calendar, params=params, encoder=lambda b: [[1.0, 2.0, 3.0]] * len(b), encoder_dim=3)
    rows = {r.stay_id: r for r in out["rows"].collect()}
    assert sorted(rows) == list(range(0, N, 2))
    assert rows[2].event == 0 and rows[2].duration == 90.0 and rows[4].event == 1 and rows[4].duration == 50.0
    assert [r.feature for r in out["feature_vocab"].orderBy("idx").limit(2).collect()] == ["Creatinine", "Heart_Rate"]
    assert rows[2].radiology == [1.0, 2.0, 3.0] and rows[2].has_radiology == 1
    assert rows[0].radiology == [0.0, 0.0, 0.0] and rows[0].has_radiology == 0
    assert sum(rows[2].icd) == 1.0 and all(len(r.icd) == out["code_vocab"].count() for r in rows.values())
    names = {r.feature for r in out["code_vocab"].collect()}
    assert names <= {"ICD_00", "ICD_02"}
    current = calendar_icu.prepare(
        calendar["icustays"], calendar["patients"], calendar["admissions"], diagnoses=calendar["diagnoses"],
        params=dataclasses.replace(params, codes=Codes(top_n=3, mode="current")), static=False,
    )
    assert all(sum(r.icd) == 1.0 for r in current["rows"].collect())


def test_emergency_plan(frame):
    times = [T0 + dt.timedelta(minutes=m) for m in (0, 30, 60, 90, 400)]
    visits = [
        (i // 2, i, 50.0, 37.0, 80.0, 16.0, 98.0, 120.0, None if i == 3 else 80.0, "F", "r", "e", "2-Emergent" if i % 2 else "odd",
         30.0 if i == 5 else 4.0 + i / 10, ["Discharge", "ICU", "Inpatient", "Observation", "Left"][i % 5]) for i in range(N)
    ]
    labs = [(i, str(t), "GLU", "> 5" if k == 0 else str(k), k) for i in range(N) for k, t in enumerate(times) if i != 6]
    vitals = [(i, str(times[0] + dt.timedelta(minutes=10)), "HR", 80.0, 1) for i in range(N)] + [(1, "no time", "HR", 1.0, 2)]
    out = emergency.prepare(
        frame(schemas.VISITS, visits),
        frame(schemas.ED_LABS + ", seq bigint", labs),
        frame(schemas.ED_NUMERICS + ", seq bigint", vitals),
        frame(schemas.PMH, [(0, "z"), (0, "z"), (1, "y")]),
        frame(schemas.RADS, [(0, "ct", "fine"), (1, "ct", None)]),
        dataclasses.replace(emergency.DEFAULTS, split=Split(exact=True)),
    )
    rows = {r.stay_id: r for r in out["rows"].collect()}
    assert 3 not in rows and 5 not in rows and 4 not in rows and 0 in rows and rows[1].event == 1
    # The first lab is no number, so time starts at the vital sign of minute 10; 30 and 60 min fall in the first hour after.
    assert rows[1].mask[0][:2] == [0.0, 1.0] and rows[1].mask[1][:2] == [1.0, 0.0] and rows[1].mask[2][:2] == [1.0, 0.0]
    assert rows[6].mask[1][:2] == [0.0, 0.0]
    assert [r.feature for r in out["code_vocab"].orderBy("code_idx").collect()] == ["icd_z", "icd_y"]
    assert rows[0].icd == rows[1].icd == [2.0, 0.0] and rows[2].icd == [0.0, 1.0]
    assert rows[0].has_radiology == 1 and rows[1].has_radiology == 0
    last = out["feature_vocab"].orderBy(F.desc("idx")).first().feature
    assert last == "Triage_acuity_ordinal"
    info = out["run_info"].first()
    assert info.competing_risks and info.n_events == 3


def test_prepare_reshapes(frame):
    edstays = frame(schemas.EDSTAYS, [(1, 1, T0, T0 + dt.timedelta(hours=5)), (2, 1, T0, None), (3, 9, T0, T0)])
    outcomes = frame(schemas.DISPOSITIONS, [(1, "DIED"), (2, "ELSEWHERE")])
    labels = {r.stay_id: (r.ed_los_hours, r.outcome) for r in prepare.ed_labels(edstays, outcomes).collect()}
    assert labels == {1: (5.0, 1), 2: (None, 0), 3: (0.0, 0)}
    patients = frame(schemas.PREP_PATIENTS, [(1, "F", "a", "x", 30), (2, "M", "b", "y", 40)])
    static, _ = prepare.ed_static(patients, edstays)
    assert sorted((r.stay_id, r.feature, r.value) for r in static.collect()) == [(1, "age", 30.0), (2, "age", 30.0)]
    vitals = frame("stay_id bigint, charttime timestamp, hr double", [(1, T0 + dt.timedelta(hours=1), 80.0), (1, T0 - dt.timedelta(hours=1), 1.0), (8, T0, 5.0)])
    labs = frame("stay_id bigint, charttime timestamp, lac double", [(1, T0 + dt.timedelta(hours=1), 2.0)])
    series = prepare.ed_series(vitals, labs, edstays).collect()
    assert [(r.stay_id, r.time_hours, r.hr, r.lac) for r in series] == [(1, 1.0, 80.0, 2.0)]
    vocab, cells = prepare.ed_codes(frame(schemas.PREP_DIAGNOSES, [(1, "a"), (1, "a"), (2, "b"), (2, "c")]), 2)
    assert sorted((r.stay_id, r.pos) for r in cells.collect()) == [(1, 0), (2, 1)]


def test_inputs(spark, frame):
    df = frame("a int", [(1,)])
    report = tables.check_inputs(spark, {"x": df, "y": df.where("a > 1"), "z": None}, {"x": ["a", "b"], "y": [], "z": ["c"]})
    status = sorted((r.table, r.column or "", r.status) for r in report.collect())
    assert status == [("x", "", "found"), ("x", "a", "found"), ("x", "b", "missing column"), ("y", "", "empty table"), ("z", "", "missing table")]
    with pytest.raises(ValueError, match="x.b: missing column"):
        tables.require_inputs(report)


def test_csv_order_and_types(spark, frame):
    df = frame("CSN bigint, Component_name string, code string", [(i, "n", "0012") for i in range(10)])
    path = tables.write_csv(df.coalesce(1), session.fresh_path(spark, "csv"), compressed=True)
    scan = tables.with_file_order(tables.read_csv(spark, path, "CSN bigint, Component_name string, code string"))
    assert [r.CSN for r in scan.orderBy("seq").collect()] == list(range(10))
    assert scan.first().code == "0012"
    by_name = tables.read_csv_by_name(spark, path, "code string, CSN int")
    assert by_name.columns == ["code", "CSN"] and by_name.agg(F.sum("CSN")).first()[0] == 45
