"""Structural properties of the layers on the driver's data."""

from pyspark.sql import functions as F

from pulsegrid.operators.clean import route
from pulsegrid.plans.fixtures import fx_events
from pulsegrid.plans.layers import gold_m, gold_v, silver_m, silver_v

SF = "/root/testdata/sf0.001"


def test_routing_partitions_input(spark):
    ev = fx_events(spark, SF)
    v, m, o = route(ev)
    assert v.count() + m.count() + o.count() == ev.count()


def test_windows_contain_their_events(spark):
    sv = silver_v(spark, SF)
    w = sv.select("event_timestamp", F.window("event_timestamp", "10 minutes").alias("w"))
    bad = w.filter(~((F.col("w.start") <= F.col("event_timestamp")) & (F.col("event_timestamp") < F.col("w.end"))))
    assert bad.count() == 0


def test_fall_counts_bounded_by_rows(spark):
    sm = silver_m(spark, SF)
    gm = gold_m(spark, SF)
    assert gm.agg(F.sum("fall_events_detected")).first()[0] <= sm.count()
    assert gm.filter(F.col("peak_impact") < F.col("avg_activity")).count() == 0


def test_mews_is_sum_of_components(spark):
    gv = gold_v(spark, SF)
    assert gv.filter(F.col("mews_score") != F.col("mews_hr_score") + F.col("mews_spo2_score")).count() == 0
    assert gv.filter(~F.col("mews_score").between(0, 6)).count() == 0


def test_py_round_matches_python_round(spark):
    """The alert's impact rounding equals Python's round on the exact binary
    value, ties included (where Spark's bround and pandas-style rounding differ)."""
    import math

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from pulsegrid.functions.scalars import py_round

    ties = [2.675, 31.115, 26.675, 25.125, 135.705, 1.005, -2.675, 0.125, -0.0, 1e12 + 0.125]
    samples = []

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.floats(-1e6, 1e6, allow_nan=False),
                     st.integers(-10**7, 10**7).map(lambda k: k / 1000)))  # decimal ties
    def collect(x):
        samples.append(x)

    collect()
    vals = ties + samples
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(py_round("x", 2)).collect()]
    for v, g in zip(vals, got):
        want = round(v, 2)
        assert g == want and math.copysign(1, g) == math.copysign(1, want), (v, g, want)


def test_quantiles_are_exact_whatever_the_number_of_distinct_values(spark):
    """Against numpy, with ties, many distinct values and few."""
    import numpy as np

    from pulsegrid.operators import datasets as DS
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=30_011), np.full(9_000, 0.25)])
    df = spark.createDataFrame([(float(v), int(i % 5), None) for i, v in enumerate(x)], "many double, few int, none double")
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    q = {r.column_name: r.q for r in DS.quantiles(df.repartition(13), ["many", "few", "none"], ps).collect()}
    assert np.allclose(q["many"], np.quantile(x, ps), rtol=0, atol=1e-12)
    assert np.allclose(q["few"], np.quantile(np.arange(len(x)) % 5, ps)) and "none" not in q
    d = {r.column_name: r for r in DS.describe_numeric(df).collect()}
    assert np.allclose([d["many"].p25, d["many"].p50, d["many"].p75], np.quantile(x, [.25, .5, .75]), rtol=0, atol=1e-12)
    assert d["few"]["count"] == len(x) and abs(d["many"].std - x.std(ddof=1)) < 1e-9
    assert d["none"]["count"] == 0 and d["none"].mean is None and d["none"].p50 is None
    assert list(d) == ["many", "few", "none"]
    sketch = {r.column_name: r.q for r in DS.quantiles(df, ["many"], [0.5], exact=False).collect()}
    assert abs(sketch["many"][0] - np.median(x)) < 0.01


def test_describe_without_numeric_columns_is_empty(spark):
    from pulsegrid.operators import datasets as DS
    out = DS.describe_numeric(spark.createDataFrame([("a",)], "s string"))
    assert out.count() == 0 and out.columns[:2] == ["column_name", "count"]
