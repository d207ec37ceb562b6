"""A data set of one's own, from functions alone."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from cohortframe.operators import events as E
from cohortframe.params import Reports
from cohortframe.plans import common, spec
from tests.test_plans import SMALL


def ward():
    """Ward stays with day counts, readings by hour and notes."""

    def stays(given, params, losses):
        named = losses.passed(given["ward"], "ward").selectExpr("bed AS stay_id", "person AS subject_id", "days * 24.0 AS duration", "died AS event", "age", "wing")
        return losses.passed(named.where("duration > 0"), "ward", "no time on the ward")

    def cells(given, cohort, params, losses):
        known = losses.keep(given["readings"], "readings", {"no value": F.col("value").isNull()})
        return E.with_split(known.selectExpr("bed AS stay_id", "hour", "name AS feature", "value"), cohort)

    def texts(given, cohort, params, losses):
        return E.members(given["notes"].withColumnRenamed("bed", "stay_id"), cohort).select("stay_id", "text")

    return spec.DataSet(
        stays, common.Static(["age"], ["wing"]), cells, ["readings"], texts=texts, reported="notes", required={"ward": ["bed", "person", "days"]}
    )


@pytest.fixture(scope="module")
def inputs(frame):
    return {
        "ward": frame(
            "bed bigint, person bigint, days double, died int, age double, wing string",
            [(i, i, i / 2, i % 2, 40.0 + i if i % 4 else None, "n" if i % 3 else "s") for i in range(30)],
        ),
        "readings": frame("bed bigint, hour int, name string, value double", [(i, h, "hr", 60.0 + h if h else None) for i in range(30) for h in range(8)]),
        "notes": frame("bed bigint, text string", [(i, "quiet night") for i in range(0, 30, 5)]),
    }


@pytest.mark.parametrize("layout", ["dense", "sparse"])
def test_made_up_data_set(inputs, layout):
    params = dataclasses.replace(SMALL, reports=Reports(dim=8), layout=layout)
    out = spec.prepare(ward(), inputs, params)
    rows = {r.stay_id: r for r in out["rows"].collect()}
    assert sorted(rows) == list(range(1, 30)) and rows[5].has_radiology == 1 and rows[6].has_radiology == 0
    assert [r.feature for r in out["feature_vocab"].orderBy("idx").collect()] == ["hr", "age", "wing_n", "wing_s"]
    assert out["run_info"].first().active_modalities == ["timeseries", "static", "radiology"]
    lost = {(r.input, r.reason): r.rows for r in out["losses"].collect()}
    assert lost["ward", "no time on the ward"] == 1 and lost["readings", "no value"] == 30 and lost["readings", "kept"] == 210


def test_tables_that_are_not_there(inputs):
    out = spec.prepare(ward(), {"ward": inputs["ward"], "readings": None}, SMALL)
    assert out["run_info"].first().active_modalities == ["static"]
    with pytest.raises(ValueError, match="ward lacks required columns: .'days'"):
        spec.prepare(ward(), {"ward": inputs["ward"].drop("days")}, SMALL)
    bad = dataclasses.replace(ward(), stays=lambda given, params, losses: given["ward"])
    with pytest.raises(ValueError, match="stays lacks required columns"):
        spec.prepare(bad, inputs, SMALL)
