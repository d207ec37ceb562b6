"""Loss accounting: the numbers add up, cost no scan and survive empty inputs."""

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.operators.losses import Losses
from cohortframe.plans import emergency, offset_icu
from cohortframe.sources import schemas
from tests.test_plans import SMALL, offset  # noqa: F401


def lost(table, name):
    return {r.reason: r.rows for r in table.where(F.col("input") == name).orderBy("step").collect()}


def test_first_reason_counts(frame):
    df = frame("a int, b string", [(1, "x"), (None, None), (3, None), (-4, "y"), (5, "z")])
    losses = Losses()
    kept = losses.keep(losses.passed(df, "t"), "t", {"no a": F.col("a").isNull(), "no b": F.col("b").isNull(), "negative": F.col("a") < 0})
    rest = losses.passed(kept.where("a > 1"), "t", "small")
    assert [tuple(r) for r in session.barrier(rest).collect()] == [(5, "z")]
    rows = losses.rows()
    assert rows == [("t", 0, "read", 5), ("t", 1, "no a", 1), ("t", 2, "no b", 1), ("t", 3, "negative", 1), ("t", 4, "small", 1), ("t", 5, "kept", 1)]


def test_what_never_ran_is_unknown(frame):
    losses = Losses()
    losses.keep(frame("a int", [(1,)]), "t", {"none": F.col("a").isNull()})
    assert losses.rows(wait_seconds=0.2) == [("t", 0, "read", None), ("t", 1, "none", None), ("t", 2, "kept", None)]


def test_counts_ride_on_the_plan(spark, offset):  # noqa: F811
    """Every raw row passes once, the table itself reads nothing, and each input adds up."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    lab = offset["lab"]
    raw = dict(offset, lab=lab.mapInArrow(count, lab.schema))
    out = offset_icu.prepare(**raw, params=SMALL)
    table = out["losses"]
    assert "Scan" not in table._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "")
    for name, df in offset.items():
        counts = lost(table, name)
        assert counts["read"] == df.count() == sum(n for k, n in counts.items() if k != "read")
    out["rows"].collect()
    assert seen.value == lab.count()
    assert lost(table, "patient")["age is no number"] == 1


def test_unreadable_times_and_numbers(frame):
    visits = [(1, i, 50.0, 37.0, 80.0, 16.0, 98.0, 120.0, 80.0, "F", "r", "e", "2-Emergent", 4.0 + i, "ICU") for i in range(1, 5)]
    labs = [
        (1, "2024-01-01 00:00:00", "GLU", "5", 1), (1, "2024-01-01 00:00:00", "GLU", "6", 2), (1, "soon", "GLU", "5", 3), (2, None, "GLU", "5", 4),
        (2, "01.02.2024 10:00", "GLU", "> 5", 5), (2, "2024-01-01 09:00:00", None, "5", 6), (9, "2024-01-01 00:00:00", "GLU", "5", 7),
        (3, "2024-01-01 00:00:00", "GLU", None, 8), (3, "2024-01-01 00:00:00", "GLU", "7", 9), (3, "2024-01-02 00:00:00", "GLU", "7", 10),
    ]
    out = emergency.prepare(
        frame(schemas.VISITS, visits), labs=frame(schemas.ED_LABS + ", seq bigint", labs), time_formats=["dd.MM.yyyy HH:mm"], static=False,
    )
    assert lost(out["losses"], "labs") == {
        "read": 10, "no value": 1, "no feature": 1, "no time": 1, "time unreadable": 1, "of no stay in the cohort": 1,
        "later value of the same instant": 1, "kept": 4,
    }
    assert lost(out["losses"], "first values") == {"read": 4, "no number": 1, "feature nearly always empty": 0, "outside the window": 1, "kept": 2}
