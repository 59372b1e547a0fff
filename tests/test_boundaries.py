"""Threshold edges, null/NaN/zero readings and text on literal rows."""

import math

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import scalars as fn
from pulsegrid.operators import alerts as AL
from pulsegrid.operators.clean import clean_movement, clean_vitals


def _col(spark, vals, typ="double"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in vals], f"v {typ}")


def test_mews_hr_bands(spark):
    hr = [29, 40, 41, 50, 51, 100, 101, 110, 111, 130, 130.1, 220, None]
    got = [r[0] for r in _col(spark, hr).select(fn.mews_hr("v")).collect()]
    assert got == [2, 2, 1, 1, 0, 0, 1, 1, 2, 2, 3, 3, None]


def test_mews_spo2_bands(spark):
    sp = [89.9, 90, 92.9, 93, 94.9, 95, 100, None]
    got = [r[0] for r in _col(spark, sp).select(fn.mews_spo2("v")).collect()]
    assert got == [3, 2, 2, 1, 1, 0, 0, None]


def test_mews_simple_first_match(spark):
    df = spark.createDataFrame([(131.0, 80.0), (111.0, 80.0), (40.0, 99.0), (70.0, 89.0), (70.0, 99.0)], "h double, s double")
    assert [r[0] for r in df.select(fn.mews_simple("h", "s")).collect()] == [3, 2, 2, 3, 0]


def test_silver_ranges_inclusive_and_nan(spark):
    rows = [("p", "vital_monitor", 1.0, hr, sp) for hr, sp in
            [(29.0, 95.0), (30.0, 95.0), (220.0, 95.0), (221.0, 95.0), (80.0, 89.9), (80.0, 90.0),
             (80.0, 100.0), (80.0, 100.1), (None, 95.0), (float("nan"), 95.0), (80.0, float("nan"))]]
    df = spark.createDataFrame(rows, "patient_id string, device_type string, timestamp double, heart_rate double, spo2 double")
    kept = sorted((r.heart_rate, r.spo2) for r in clean_vitals(df).collect())
    assert kept == [(30.0, 95.0), (80.0, 90.0), (80.0, 100.0), (220.0, 95.0)]


def test_event_time_keeps_subseconds_and_nulls_bad(spark):
    df = spark.createDataFrame([("1704067200.25",), ("abc",), (None,)], "t string")
    got = [r[0] for r in df.select(fn.utc_wall(fn.event_time("t"))).collect()]
    assert str(got[0]) == "2024-01-01 00:00:00.250000" and got[1] is None and got[2] is None


def test_to_number(spark):
    df = spark.createDataFrame([("1.5",), ("ERROR",), ("nan",), ("",), (" 7 ",), ("inf",)], "t string")
    got = [r[0] for r in df.select(fn.to_number("t")).collect()]
    assert got[0] == 1.5 and got[1] is None and got[2] is None and got[3] is None and got[5] == float("inf")


def test_np_round_matches_pandas(spark):
    import pandas as pd
    vals = [135.705, 2.675, 0.125, 45.125, 1.005, 100.115, 12345.5, 12344.5]
    got = [r[0] for r in _col(spark, vals).select(fn.np_round("v", 2)).collect()]
    assert got == list(pd.Series(vals).round(2))
    got0 = [r[0] for r in _col(spark, vals).select(fn.np_round("v", 0)).collect()]
    assert got0 == list(pd.Series(vals).round(0))


def _vitals(spark, rows):
    return spark.createDataFrame(rows, "patient_id string, device_type string, timestamp double, "
                                       "heart_rate double, spo2 double, stress_level double")


def test_alert_edges_standard(spark):
    rows = [("a", "vital_monitor", 1.0, 130.0, 95.0, 8.0), ("b", "vital_monitor", 2.0, 130.1, 89.9, 7.0),
            ("c", "vital_monitor", 3.0, 40.0, 90.0, None), ("d", "vital_monitor", 4.0, 39.9, None, 9.0),
            ("e", "vital_monitor", 5.0, 0.0, 0.0, 0.0), ("f", "vital_monitor", 6.0, None, float("nan"), None)]
    got = sorted((r.patient_id, r.alert_type) for r in AL.vitals_alerts(_vitals(spark, rows)).collect())
    assert got == [("b", "HYPOXIA"), ("b", "TACHYCARDIA"), ("d", "BRADYCARDIA")]


def test_alert_presets_and_stress_opt_in(spark):
    rows = [("a", "vital_monitor", 1.0, 126.0, 94.0, 9.0), ("b", "vital_monitor", 2.0, 44.0, 96.0, 8.0)]
    t = S.SENSITIVE.with_(emit_high_stress=True)
    got = sorted((r.patient_id, r.alert_type) for r in AL.vitals_alerts(_vitals(spark, rows), t).collect())
    assert got == [("a", "HIGH_STRESS"), ("a", "HYPOXIA"), ("a", "TACHYCARDIA"), ("b", "BRADYCARDIA")]
    std = sorted((r.patient_id, r.alert_type) for r in AL.vitals_alerts(_vitals(spark, rows)).collect())
    assert std == []


def test_fall_edge_and_payload(spark):
    df = spark.createDataFrame([("a", 1.0, 25.0, None), ("b", 2.0, 25.0001, "walking"), ("c", 3.0, None, None),
                                ("d", 4.0, 30.456, None)], "patient_id string, timestamp double, svm double, activity_name string")
    got = sorted((r.patient_id, r.impact_force, r.activity_at_time) for r in AL.movement_alerts(df).collect())
    assert got == [("b", 25.0, "walking"), ("d", 30.46, "unknown")]


def test_alert_json_omits_nulls(spark):
    rows = [("b", "vital_monitor", 2.0, 131.0, 95.0, 7.0)]
    rec = AL.encode_alerts(AL.vitals_alerts(_vitals(spark, rows))).collect()[0]
    assert rec.key == "b" and "spo2_level" not in rec.value and '"heart_rate":131.0' in rec.value


def test_svm_and_fall_flag(spark):
    df = spark.createDataFrame([("p", "imu_sensor", 1.0, 3.0, 4.0, 12.0), ("p", "imu_sensor", 1.0, None, 4.0, 12.0)],
                               "patient_id string, device_type string, timestamp double, x double, y double, z double")
    r = clean_movement(df).collect()
    assert len(r) == 1 and math.isclose(r[0].svm, 13.0)
    assert [x[0] for x in spark.createDataFrame([(25.0,), (25.0001,), (None,)], "s double")
            .select(fn.is_fall("s", 25.0)).collect()] == [0, 1, 0]


def test_activity_labels_order_of_fixes(spark):
    from pulsegrid.operators.clean import standardise_activity
    vals = ["Actve", "Seddentary", "Highly_Active", "nan", "  Highly Active ", " Actve", None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "a string")
           .select(standardise_activity(F.col("a"))).collect()]
    assert got == ["Active", "Sedentary", "Highly Active", None, "Highly Active", "Actve", None]
