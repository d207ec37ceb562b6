"""The single-window and the three-level way must agree with a plain loop."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cohortframe.operators.running import quantile_of_counts, running


def brute(rows):
    out, p = {}, {}
    for g, t, n, f, w in sorted(rows):
        s, prod, cum = p.get(g, (0.0, 1.0, 0.0))
        cum += prod * w
        out[(g, t)] = (s + n, prod * f, prod, cum)
        p[g] = (s + n, prod * f, cum)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    times = [rng.uniform(0, 2) for _ in range(60)] + [rng.uniform(0, 5e6) for _ in range(60)] + [0.0, 1e-9 * 400]
    return [(g, t, float(rng.randint(1, 5)), rng.uniform(0.9, 1.0), rng.uniform(0, 0.1)) for g in ("a", "b") for t in times]


@pytest.mark.parametrize("task_rows", [1, 1 << 20])
def test_running_matches_loop(frame, rows, task_rows):
    df = frame("g string, t double, n double, f double, w double", rows)
    got = running(df, "t", ["g"], sums=["n"], factor="f", weighted=["w"], task_rows=task_rows).collect()
    want = brute(rows)
    assert len(got) == len(want)
    for r in got:
        expected = want[(r.g, r.t)]
        for a, b in zip((r.run_n, r.run_product, r.product_before, r.run_w), expected):
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_running_without_groups(frame, rows):
    only = [r for r in rows if r[0] == "a"]
    df = frame("g string, t double, n double, f double, w double", only)
    got = {r.t: r.run_n for r in running(df, "t", sums=["n"], task_rows=1).collect()}
    assert got == {k[1]: v[0] for k, v in brute(only).items()}


def test_three_levels_bound_the_windows(spark, frame, rows):
    """No window of the large path is left without the digit columns that bound it, except over the totals."""
    df = frame("g string, t double, n double, f double, w double", rows)
    plan = running(df, "t", ["g"], sums=["n"], task_rows=1)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_hi" in w and "_mid" in w for w in windows)


def test_negative_and_tied_hash_order(frame):
    df = frame("h bigint, n double", [(-5, 1.0), (0, 2.0), (1 << 45, 3.0), ((1 << 45) + 1, 4.0)])
    for task_rows in (1, 100):
        got = {r.h: r.run_n for r in running(df, "h", sums=["n"], ticks=F.col("h"), task_rows=task_rows).collect()}
        assert got == {-5: 1.0, 0: 3.0, 1 << 45: 6.0, (1 << 45) + 1: 10.0}


def test_quantile_interpolates(frame):
    df = frame("g string, v double, n double", [("a", 1.0, 1.0), ("a", 4.0, 1.0), ("b", 2.0, 3.0), ("b", 9.0, 2.0)])
    got = {r.g: r.quantile for r in quantile_of_counts(df, "v", "n", ["g"]).collect()}
    assert got == {"a": 2.5, "b": 2.0}
