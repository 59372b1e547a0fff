"""Radix selection of exact order statistics."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsegrid.operators import datasets as DS
from pulsegrid.operators import ranks as R


def frame(spark, **cols):
    names = list(cols)
    n = max(len(x) for x in cols.values())
    rows = [tuple(cols[c][i] if i < len(cols[c]) else None for c in names) for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)


def every_rank(spark, **cols):
    real = {c: sorted(x for x in xs if x is not None and not math.isnan(x)) for c, xs in cols.items()}
    got = R.select_ranks(frame(spark, **cols), {c: (xs[0], xs[-1]) for c, xs in real.items() if xs}, {c: range(len(xs)) for c, xs in real.items()})
    assert got == {(c, i): x for c, xs in real.items() for i, x in enumerate(xs)}


def test_ranks_of_columns_of_every_scale(spark):
    rng = random.Random(2)
    tiny, huge = 5e-324, 1.7976931348623157e308
    every_rank(
        spark,
        plain=[rng.gauss(70, 20) for _ in range(60)],
        wide=[rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) * rng.random() for _ in range(60)],
        near=[1.0 + i * 2.0**-52 for i in range(40)] + [-1.0 - i * 2.0**-52 for i in range(40)],
        edge=[0.0, -0.0, tiny, -tiny, huge, -huge, math.inf, -math.inf, 1.0, -1.0],
        same=[3.5] * 30, one=[-7.25], some=[1.0, None, float("nan"), 2.0, None, float("nan")])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=30))
def test_ranks_of_any_doubles(spark, xs):
    every_rank(spark, x=xs)


@pytest.mark.parametrize("r", [R.Range("v", 1.0, 1.9, 0, (0,)), R.Range("v", -5.0, 7.0, 0, (0,)), R.Range("v", 1e-300, 1e300, 0, (0,)),
                               R.Range("v", -2.0, -1.5, 0, (0,)), R.Range("v", -math.inf, math.inf, 0, (0,))])
def test_digits_never_decrease_with_the_value(spark, r):
    rng = random.Random(3)
    lo, hi = max(r.lo, -1e308), min(r.hi, 1e308)
    xs = sorted([r.lo, r.hi] + [lo + (hi / 2 - lo / 2) * 2 * rng.random() for _ in range(300)]
                + [x for x in (rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(300)) if r.lo <= x <= r.hi])
    df = spark.createDataFrame([(x,) for x in xs], "v double").coalesce(1)
    d = [row[0] for row in df.select(R.digit(r, R._value("v"))).collect()]
    assert d == sorted(d) and d[0] == 0 and d[-1] == R.BUCKETS - 1


def test_only_digit_counts_are_shuffled_and_nothing_is_checkpointed(spark):
    df = spark.range(0, 1_000_000, 1, 4).selectExpr("id * 1.5D AS a", "rand(7) * 100 AS b")
    figures = R.column_figures(df, ["a", "b"])
    ranges = [R.Range(c, figures[c]["lo"], figures[c]["hi"], 0, (10,)) for c in ("a", "b")]
    counts = R.digit_counts(df, ranges)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(range") == plan.count("Exchange") == 1
    assert plan.index("partial_count") > plan.index("Exchange")  # printed from the top: below the exchange
    rows = counts.groupBy("range").count().collect()
    assert all(r["count"] <= R.BUCKETS for r in rows)
    assert "RDD" not in plan and "Python" not in plan


def test_passes_are_few(spark, monkeypatch):
    calls, real = [], R.digit_counts
    monkeypatch.setattr(R, "digit_counts", lambda df, ranges: calls.append(len(ranges)) or real(df, ranges))
    rng = np.random.default_rng(4)
    usual = frame(spark, hr=[round(x, 1) for x in rng.normal(80, 15, 4000).tolist()], steps=rng.integers(0, 25_000, 4000).astype(float).tolist())
    DS.quantiles(usual, ["hr", "steps"], [0.25, 0.5, 0.75]).collect()
    assert len(calls) <= 3
    calls.clear()
    hard = frame(spark, x=[10.0**e for e in range(-300, 300)] + [1 + i * 2.0**-52 for i in range(400)])
    DS.quantiles(hard, ["x"], [0.5, 0.6]).collect()
    assert len(calls) <= 5


def test_quantiles_and_describe_equal_numpy(spark):
    rng = np.random.default_rng(5)
    x, y = rng.lognormal(3, 4, 3001), np.round(rng.normal(0, 50, 1500), 1)
    df = frame(spark, x=x.tolist(), y=y.tolist(), none=[], one=[4.5])
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    q = {r.column_name: r.q for r in DS.quantiles(df, ["x", "y", "none", "one"], ps).collect()}
    assert np.allclose(q["x"], np.quantile(x, ps), rtol=1e-12) and np.allclose(q["y"], np.quantile(y, ps), rtol=0, atol=1e-9)
    assert q["one"] == [4.5] * 6 and "none" not in q
    d = {r.column_name: r for r in DS.describe_numeric(df).collect()}
    assert d["none"]["count"] == 0 and d["none"].p50 is None and d["one"].std is None
    assert np.isclose(d["y"]["std"], y.std(ddof=1)) and d["x"].min == x.min() and d["x"].max == x.max()
    assert [r.column_name for r in DS.describe_numeric(df).collect()] == ["x", "y", "none", "one"]


def test_nan_is_the_largest_value(spark):
    df = frame(spark, x=[1.0, 2.0, 3.0, float("nan")], only=[float("nan")] * 2)
    q = {r.column_name: r.q for r in DS.quantiles(df, ["x", "only"], [0.0, 0.5, 1.0]).collect()}
    assert q["x"][:2] == [1.0, 2.5] and math.isnan(q["x"][2]) and all(map(math.isnan, q["only"]))
    d = {r.column_name: r for r in DS.describe_numeric(df).collect()}
    assert d["x"].min == 1.0 and math.isnan(d["x"].max) and math.isnan(d["only"].min)
