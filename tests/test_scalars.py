import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortframe.functions import scalars as S


def one(df, c):
    return df.select(c.alias("v")).first().v


def test_text_to_number(frame):
    df = frame("t string", [("12",), (" 3.5 ",), ("> 89",), ("1d",), ("nan",), (None,), ("-inf",), ("",)])
    got = [r.v for r in df.select(S.to_number("t").alias("v")).collect()]
    assert got == [12.0, 3.5, None, None, None, None, float("-inf"), None]


def test_hours_keep_fractions(frame):
    df = frame("a timestamp, b timestamp", [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1, 30, 0, 500000))])
    assert one(df, S.hours_between("a", "b")) == pytest.approx(1.5 + 0.5 / 3600, abs=1e-12)


def test_bins(frame):
    df = frame("h double", [(0.0,), (0.2,), (1.0,), (1.01,)])
    assert [r.v for r in df.select(S.hour_bin("h").alias("v")).collect()] == [0, 0, 1, 1]
    assert [r.v for r in df.select(S.ceil_bin("h").alias("v")).collect()] == [0, 1, 1, 2]


def test_strict_extremes_keep_null(frame):
    df = frame("a double, b double", [(1.0, None)])
    assert one(df, S.strict_least("a", "b")) is None and one(df, S.strict_greatest("a", "b")) is None
    assert one(df, F.least("a", "b")) == 1.0


def test_scatter(frame):
    schema = "id int, cells array<struct<pos:int,value:double>>"
    rows = [
        (1, [{"pos": 1, "value": 2.0}, {"pos": 4, "value": 5.0}]),
        (2, None),
        (3, []),
        (4, [{"pos": i, "value": float(i)} for i in range(6)]),
    ]
    got = {r.id: r.v for r in frame(schema, rows).select("id", S.scatter("cells", 6).alias("v")).collect()}
    assert got[1] == [None, 2.0, None, None, 5.0, None]
    assert got[2] == got[3] == [None] * 6
    assert got[4] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_percent_of_nothing(frame):
    assert one(frame("a int, b int", [(1, 0)]), S.percent("a", "b")) is None


def test_lookup_default(frame):
    df = frame("k string", [("x",), ("y",), (None,)])
    assert [r.v for r in df.select(S.lookup("k", {"x": 1}).alias("v")).collect()] == [1, None, None]
    assert [r.v for r in df.select(S.lookup("k", {"x": 1}, 0).alias("v")).collect()] == [1, 0, 0]
