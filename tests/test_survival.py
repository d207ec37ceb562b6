import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohortframe.operators import survival
from cohortframe.params import Labels

LABELS = "stay_id int, duration double, event int"


@pytest.fixture(scope="module")
def five(frame):
    return frame(LABELS, [(i, float(i), 1) for i in range(1, 6)])


def test_worked_curve_and_cuts(frame, five):
    curve = {r.time: r.survival for r in survival.km_curve(five).collect()}
    assert [round(curve[float(t)], 9) for t in range(1, 6)] == [0.8, 0.6, 0.4, 0.2, 0.0]
    cuts = survival.km_cuts(five, 3)
    assert [r.cut for r in cuts.orderBy("cut_idx").collect()] == [0.0, 2.0, 5.0]


def test_discretise_and_digitize(frame):
    cuts = frame("cut_idx int, cut double", [(0, 0.0), (1, 2.0), (2, 5.0)])
    times = [0.0, 1.0, 2.0, 4.0, 5.0]
    for event, expected in ((1, [0, 1, 1, 2, 2]), (0, [0, 0, 1, 1, 2])):
        df = frame(LABELS, [(i, t, event) for i, t in enumerate(times)])
        got = survival.discretise_labels(df, cuts).orderBy("stay_id").collect()
        assert [r.duration_idx for r in got] == expected
    binned = survival.digitize_durations(df, cuts).orderBy("stay_id").collect()
    assert [r.bin for r in binned] == [1, 1, 2, 2, 3]
    late = frame(LABELS, [(0, 9.0, 1), (1, 9.0, 0), (2, None, 0)])
    assert [r.duration_idx for r in survival.discretise_labels(late, cuts).orderBy("stay_id").collect()] == [2, 2, None]


def test_competing_codes_survive_discretising(frame):
    cuts = frame("cut_idx int, cut double", [(0, 0.0), (1, 5.0)])
    got = survival.discretise_labels(frame(LABELS, [(0, 1.0, 3)]), cuts).first()
    assert got.event == 3 and got.duration_idx == 1


def test_horizon_keeps_event_at_the_end(frame):
    df = survival.censor_at(frame(LABELS, [(1, 240.0, 2), (2, 240.1, 2), (3, 5.0, 1), (4, None, 0)]), 240)
    got = {r.stay_id: (r.duration, r.event) for r in df.collect()}
    assert got == {1: (240.0, 2), 2: (240.0, 0), 3: (5.0, 1), 4: (None, 0)}
    again = {r.stay_id: (r.duration, r.event) for r in survival.censor_at(df, 240).collect()}
    assert again == got


def test_offset_labels(frame):
    df = frame("id int, off bigint, status string", [(1, 60 * 240, "Expired"), (2, 60 * 241, "Expired"), (3, 90, None), (4, 90, "expired")])
    got = {r.id: (r.duration, r.event) for r in survival.labels_from_offsets(df, "off", "status", "Expired", 240).collect()}
    assert got == {1: (240.0, 1), 2: (240.0, 0), 3: (1.5, 0), 4: (1.5, 0)}


def test_calendar_labels(frame):
    t0 = dt.datetime(2024, 1, 1)

    def at(hours):
        return None if hours is None else t0 + dt.timedelta(hours=hours)

    rows = [
        (1, at(0), at(100), at(50), None),  # dies in hospital
        (2, at(0), at(100), None, at(200)),  # dies after discharge, within the horizon
        (3, at(0), at(100), None, at(300)),  # dies after the horizon
        (4, at(0), at(500), None, None),  # longer than the horizon
        (5, at(0), None, None, None),  # unknown discharge
        (6, at(0), None, at(240), None),  # exactly at the horizon
        (7, at(5), at(100), None, at(0)),  # date of death before the time of intake
    ]
    df = frame("id int, intime timestamp, dischtime timestamp, deathtime timestamp, dod timestamp", rows)
    got = {r.id: (r.duration, r.event) for r in survival.labels_from_calendar(df, 240).collect()}
    assert got == {
        1: (50.0, 1), 2: (200.0, 1), 3: (100.0, 0), 4: (240.0, 0), 5: (None, 0), 6: (240.0, 1), 7: (0.0, 1),
    }


@pytest.fixture(scope="module")
def mixed(frame):
    rows = [(i, float((i * 7) % 23), (i * 5) % 3) for i in range(200)]
    return frame(LABELS, rows)


def test_curve_properties(mixed):
    curve = survival.km_curve(mixed).orderBy("time").collect()
    values = [r.survival for r in curve]
    assert all(0 <= v <= 1 for v in values) and values == sorted(values, reverse=True)
    cif = survival.aj_cif(mixed, [1, 2]).groupBy("time").agg(F.sum("cif").alias("c")).collect()
    total = {r.time: r.c for r in cif}
    for r in curve:
        assert math.isclose(r.survival + total[r.time], 1.0, abs_tol=1e-12)


def test_cuts_are_increasing_and_span(mixed):
    cuts = [r.cut for r in survival.km_cuts(mixed, 6).orderBy("cut_idx").collect()]
    assert cuts[0] == 0 and cuts[-1] == 22.0 and all(a < b for a, b in zip(cuts, cuts[1:]))


def test_large_path_gives_the_same_curves(mixed, monkeypatch):
    from cohortframe.operators import running as module

    def rows():
        km = {r.time: (r.survival, r.greenwood) for r in survival.km_curve(mixed).collect()}
        aj = {(r.event, r.time): (r.cif, r.variance) for r in survival.aj_cif(mixed, [1, 2], variance=True).collect()}
        return km, aj, [r.cut for r in survival.km_cuts(mixed, 6).orderBy("cut_idx").collect()]

    small = rows()
    defaults = module.running.__kwdefaults__ or {}
    monkeypatch.setattr(module.running, "__defaults__", tuple(1 if d == module.TASK_ROWS else d for d in module.running.__defaults__))
    monkeypatch.setattr(survival, "TASK_ROWS", 1)
    assert defaults == {}
    large = rows()
    for a, b in zip(small[:2], large[:2]):
        assert a.keys() == b.keys()
        for k in a:
            assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12) for x, y in zip(a[k], b[k]))
    assert small[2] == large[2]


def test_band(frame, five):
    band = {r.time: (r.lower, r.upper) for r in survival.km_band(survival.km_curve(five)).collect()}
    low, high = band[1.0]
    assert 0 < low < 0.8 < high < 1
    assert band[5.0] == (None, None)
    none = survival.km_band(survival.km_curve(frame(LABELS, [(1, 1.0, 0), (2, 2.0, 1)]))).orderBy("time").first()
    assert (none.lower, none.upper) == (1.0, 1.0)


def test_event_count():
    assert Labels(outcomes={0: "a", 1: "b", 2: "c", 3: "d"}, competing=True).n_events == 3
    assert Labels(outcomes={0: "a", 1: "b"}).n_events == 1


def test_cuts_with_events_at_time_zero(frame):
    """The curve then has no point (0, 1): it falls from 0.8 to 0, and steps of 0.4 end at 0, 2 and 4."""
    zero = frame(LABELS, [(i, float(i), 1) for i in range(5)])
    assert [r.cut for r in survival.km_cuts(zero, 3).orderBy("cut_idx").collect()] == [0.0, 2.0, 4.0]


def test_events_after_the_grid_are_censored(frame):
    cuts = frame("cut_idx int, cut double", [(0, 0.0), (1, 5.0)])
    got = survival.discretise_labels(frame(LABELS, [(0, 9.0, 2), (1, 5.0, 2), (2, 9.0, 0)]), cuts).orderBy("stay_id").collect()
    assert [(r.event, r.event_idx, r.duration_idx) for r in got] == [(2, 0, 1), (2, 2, 1), (0, 0, 1)]
