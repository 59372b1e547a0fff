"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle (or none for non-SQL operators).

Every query reads the driver's tables through the fixture adapter, so its
work grows with the data. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import scalars as fn
from pulsegrid.operators import alerts as AL
from pulsegrid.operators import serving as SV
from pulsegrid.operators.clean import route, route_name
from pulsegrid.operators.gold import merge_vitals, vitals_state
from pulsegrid.plans.fixtures import event_log, fx_events
from pulsegrid.plans.layers import duck_with, gold, gold_m, gold_v, r6, silver_m, silver_v, wall

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn_: Query) -> Query:
        QUERIES[name] = fn_
        if sql is not None:
            ORACLES[name] = sql
        return fn_
    return deco


W = duck_with  # shorthand


# =============================================================================
# Layers: Silver and Gold
# =============================================================================
@register("p02_route_counts", W() + """
SELECT CASE WHEN device_type = 'vital_monitor' THEN 'vitals' WHEN device_type = 'imu_sensor' THEN 'movement'
            ELSE 'other' END AS route, count(*) AS n_rows, count(DISTINCT patient_id) AS n_patients
FROM fx_raw GROUP BY 1""")
def q_route(spark, d):
    # one scan: rows and patients per route, first per (route, patient)
    per = fx_events(spark, d).groupBy(route_name().alias("route"), "patient_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("route").agg(F.sum("n").alias("n_rows"), F.count("patient_id").alias("n_patients"))


@register("p09_silver_vitals", W() + """
SELECT patient_id, epoch_s AS timestamp, heart_rate, spo2, event_timestamp FROM fx_silver_v""")
def q_silver_v(spark, d):
    sv = silver_v(spark, d)
    return wall(sv.select("patient_id", "timestamp", "heart_rate", "spo2", "event_timestamp"), "event_timestamp")


@register("p12_silver_movement", W() + """
SELECT patient_id, epoch_s AS timestamp, x, y, z, svm, event_timestamp FROM fx_silver_m""")
def q_silver_m(spark, d):
    sm = silver_m(spark, d)
    return wall(sm.select("patient_id", "timestamp", "x", "y", "z", "svm", "event_timestamp"), "event_timestamp")


@register("p11_event_time_microseconds", """
SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE ts END AS event_timestamp
FROM events""")
def q_event_time(spark, d):
    """Event times of the log as text: exact to the micro-second; text that is no
    time, missing and out-of-range values become null."""
    e = F.col("event_id")
    text = (F.when(e % 13 == 0, "ERROR").when(e % 17 == 0, None).when(e % 19 == 0, "1e30")
            .otherwise(F.col("epoch_s").cast("string")))
    return event_log(spark, d).select("event_id", fn.utc_wall(fn.event_time(text)).alias("event_timestamp"))


@register("w02_gold_on_logged_time", """
SELECT event_type || '-' || (user_id % 20) AS patient_id, time_bucket(INTERVAL 60 MINUTE, ts) AS window_start,
  round(avg(40 + value), 6) AS avg_hr, max(40 + value) AS peak_hr,
  round(avg(90 + CAST(regexp_extract(props, '[0-9]+') AS INT) % 11), 6) AS avg_spo2, count(*) AS n_events
FROM events GROUP BY 1, 2""")
def q_logged_time(spark, d):
    """Hourly vitals windows over the log's own time, all its columns read."""
    silver = event_log(spark, d).select(
        F.concat_ws("-", "event_type", (F.col("user_id") % 20).cast("string")).alias("patient_id"),
        fn.event_time("epoch_s").alias("event_timestamp"), (F.col("value") + 40).alias("heart_rate"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 11 + 90).alias("spo2"))
    state = vitals_state(silver, minutes=60)
    g = merge_vitals(state).join(state.groupBy("patient_id", "window_start").agg(F.sum("hr_n").alias("n_events")),
                                 ["patient_id", "window_start"])
    return r6(wall(g, "window_start"), "avg_hr", "avg_spo2").select(
        "patient_id", "window_start", "avg_hr", "peak_hr", "avg_spo2", "n_events")


@register("a01_gold_vitals", W() + "SELECT * FROM fx_gold_v")
def q_gold_v(spark, d):
    gv = gold_v(spark, d)
    return wall(gv, "window_start", "window_end")


@register("a06_gold_movement", W() + """
SELECT patient_id, window_start, window_end, round(avg_activity, 6) AS avg_activity, peak_impact,
       fall_events_detected FROM fx_gold_m""")
def q_gold_m(spark, d):
    gm = gold_m(spark, d)
    return r6(wall(gm, "window_start", "window_end"), "avg_activity")


@register("a02_mews_simple", W() + """
SELECT patient_id, window_start, avg_hr, avg_spo2,
  CASE WHEN avg_hr > 130 THEN 3 WHEN avg_hr >= 111 THEN 2 WHEN avg_hr <= 40 THEN 2
       WHEN avg_spo2 < 90 THEN 3 ELSE 0 END AS mews_score
FROM fx_gold_v""")
def q_mews_simple(spark, d):
    from pulsegrid.operators.gold import gold_vitals
    sv = silver_v(spark, d)
    g = gold_vitals(sv, scoring="simple")
    return wall(g.select("patient_id", "window_start", "avg_hr", "avg_spo2", "mews_score"), "window_start")


@register("w02_gold_vitals_5min", W(minutes=5) + """
SELECT patient_id, window_start, window_end, avg_hr, peak_hr, mews_score FROM fx_gold_v""")
def q_gold_5(spark, d):
    gv = gold_v(spark, d, minutes=5)
    return wall(gv.select("patient_id", "window_start", "window_end", "avg_hr", "peak_hr", "mews_score"),
                "window_start", "window_end")


@register("w02_gold_movement_60min", W(minutes=60) + """
SELECT patient_id, window_start, window_end, round(avg_activity, 6) AS avg_activity, peak_impact,
       fall_events_detected FROM fx_gold_m""")
def q_gold_60(spark, d):
    gm = gold_m(spark, d, minutes=60)
    return r6(wall(gm, "window_start", "window_end"), "avg_activity")


# =============================================================================
# Serving analytics over Gold
# =============================================================================
@register("o01_critical_banners", W() + """
SELECT patient_id, window_start, mews_score, avg_hr, avg_spo2, mews_hr_score, mews_spo2_score,
       strftime(window_start, '%H:%M') AS clock
FROM fx_gold_v WHERE mews_score >= 2 ORDER BY mews_score DESC, patient_id, window_start LIMIT 5""")
def q_critical(spark, d):
    gv = gold_v(spark, d)
    return SV.critical_banners(wall(gv, "window_start"), mews_min=2, k=5)


@register("o02_fall_banners", W() + """
SELECT patient_id, window_start, fall_events_detected, peak_impact, strftime(window_start, '%H:%M') AS clock
FROM fx_gold_m WHERE fall_events_detected > 0 ORDER BY fall_events_detected DESC, patient_id, window_start LIMIT 3""")
def q_fall_banners(spark, d):
    gm = gold_m(spark, d)
    return SV.fall_banners(wall(gm, "window_start"), k=3)


@register("p17_filter_vitals", W() + """
SELECT * FROM fx_gold_v WHERE patient_id IN ('1600', '1601', '1603', '1607')
  AND avg_hr BETWEEN 60 AND 150 AND avg_spo2 >= 93""")
def q_filter_v(spark, d):
    gv = gold_v(spark, d)
    return wall(SV.filter_vitals(gv, ["1600", "1601", "1603", "1607"], (60, 150), 93), "window_start", "window_end")


@register("p18_filter_movement", W() + """
SELECT patient_id, window_start, window_end, round(avg_activity, 6) AS avg_activity, peak_impact, fall_events_detected
FROM fx_gold_m WHERE patient_id IN ('1600', '1602', '1606') AND fall_events_detected > 0""")
def q_filter_m(spark, d):
    gm = gold_m(spark, d)
    return r6(wall(SV.filter_movement(gm, ["1600", "1602", "1606"], only_falls=True), "window_start", "window_end"),
              "avg_activity")


@register("p16_reflag_falls", W() + """
SELECT patient_id, window_start, peak_impact, CASE WHEN peak_impact > 20.5 THEN 1 ELSE 0 END AS is_fall FROM fx_gold_m""")
def q_reflag(spark, d):
    gm = gold_m(spark, d)
    return wall(SV.reflag_falls(gm, 20.5).select("patient_id", "window_start", "peak_impact", "is_fall"), "window_start")


@register("p20_alert_windows", W() + "SELECT * FROM fx_gold_v WHERE mews_score > 0")
def q_alert_windows(spark, d):
    gv = gold_v(spark, d)
    return wall(SV.alert_windows(gv), "window_start", "window_end")


@register("p19_table_view_vitals", W() + """
SELECT * FROM fx_gold_v WHERE patient_id IN ('1600', '1601', '1602', '1603', '1604', '1605')
  AND mews_score IN (2, 3, 4) ORDER BY avg_hr DESC NULLS LAST, patient_id, window_start LIMIT 50""")
def q_table_v(spark, d):
    gv = gold_v(spark, d)
    return wall(SV.table_view(gv, "avg_hr", 50, patients=["1600", "1601", "1602", "1603", "1604", "1605"],
                              mews_levels=[2, 3, 4]), "window_start", "window_end")


@register("o04_table_view_movement", W() + """
SELECT patient_id, window_start, window_end, round(avg_activity, 6) AS avg_activity, peak_impact, fall_events_detected
FROM fx_gold_m WHERE fall_events_detected > 0
ORDER BY peak_impact DESC NULLS LAST, patient_id, window_start LIMIT 20""")
def q_table_m(spark, d):
    gm = gold_m(spark, d)
    return r6(wall(SV.table_view(gm, "peak_impact", 20, only_falls=True), "window_start", "window_end"),
              "avg_activity")


@register("a07_kpis", W() + """
SELECT round(avg_hr, 6) AS avg_hr, round(avg_spo2, 6) AS avg_spo2, max_mews, total_falls,
  round(avg_activity, 6) AS avg_activity, peak_impact,
  CASE WHEN max_mews >= 3 THEN 'alert' WHEN max_mews >= 2 THEN 'warn' ELSE 'good' END AS mews_class,
  CASE WHEN total_falls > 0 THEN 'alert' ELSE 'good' END AS falls_class
FROM (SELECT (SELECT avg(avg_hr) FROM fx_gold_v) AS avg_hr, (SELECT avg(avg_spo2) FROM fx_gold_v) AS avg_spo2,
        (SELECT coalesce(max(mews_score), 0) FROM fx_gold_v) AS max_mews,
        (SELECT CAST(coalesce(sum(fall_events_detected), 0) AS BIGINT) FROM fx_gold_m) AS total_falls,
        (SELECT avg(avg_activity) FROM fx_gold_m) AS avg_activity,
        (SELECT max(peak_impact) FROM fx_gold_m) AS peak_impact) k""")
def q_kpis(spark, d):
    gv, gm = gold(spark, d)
    return r6(SV.kpis(gv, gm), "avg_hr", "avg_spo2", "avg_activity")


@register("a07_kpis_empty_selection", W() + """
SELECT CAST(NULL AS DOUBLE) AS avg_hr, CAST(NULL AS DOUBLE) AS avg_spo2, 0 AS max_mews, CAST(0 AS BIGINT) AS total_falls,
  CAST(NULL AS DOUBLE) AS avg_activity, CAST(NULL AS DOUBLE) AS peak_impact, 'good' AS mews_class, 'good' AS falls_class
FROM (SELECT count(*) FROM fx_gold_v WHERE patient_id = 'none') t""")
def q_kpis_empty(spark, d):
    gv, gm = gold(spark, d)
    return SV.kpis(SV.filter_vitals(gv, ["none"]), SV.filter_movement(gm, ["none"]))


@register("a29_selection_counts", W() + """
SELECT (SELECT count(DISTINCT patient_id) FROM (SELECT patient_id FROM fx_gold_v UNION ALL SELECT patient_id FROM fx_gold_m) u) AS patients,
       (SELECT count(*) FROM fx_gold_v) AS vitals_windows, (SELECT count(*) FROM fx_gold_m) AS movement_windows""")
def q_selection(spark, d):
    gv, gm = gold(spark, d)
    return SV.selection_counts(gv, gm)


@register("u03_all_patients", W() + """
SELECT DISTINCT patient_id FROM (SELECT patient_id FROM fx_gold_v UNION ALL SELECT patient_id FROM fx_gold_m) u
WHERE patient_id IS NOT NULL ORDER BY patient_id""")
def q_patients(spark, d):
    gv, gm = gold(spark, d)
    return SV.all_patients(gv, gm)


_A09 = """SELECT patient_id, count(avg_hr) AS {w}, {r}avg(avg_hr){r2} AS avg_hr, {b}min(avg_hr){b2} AS min_hr,
  {b}max(peak_hr){b2} AS max_hr, {r}avg(avg_spo2){r2} AS avg_spo2, {b}min(avg_spo2){b2} AS min_spo2, max(mews_score) AS max_mews,
  {r}avg(mews_score){r2} AS avg_mews, count(CASE WHEN mews_score >= 2 THEN 1 END) AS alert_windows
FROM fx_gold_v GROUP BY patient_id"""


@register("a09_vitals_summary", W() + _A09.format(w="windows", r="round(", r2=", 6)", b="", b2=""))
def q_vsum(spark, d):
    gv = gold_v(spark, d)
    return r6(SV.vitals_summary(gv, 2), "avg_hr", "avg_spo2", "avg_mews")


@register("a10_fall_summary", W() + """
SELECT patient_id, CAST(sum(fall_events_detected) AS BIGINT) AS total_falls,
  count(CASE WHEN fall_events_detected > 0 THEN 1 END) AS fall_windows, round(avg(avg_activity), 6) AS avg_activity,
  max(peak_impact) AS peak_impact, count(avg_activity) AS windows,
  round_even(count(CASE WHEN fall_events_detected > 0 THEN 1 END) / count(avg_activity) * 100 * 10, 0) / 10 AS fall_rate
FROM fx_gold_m GROUP BY patient_id""")
def q_fsum(spark, d):
    gm = gold_m(spark, d)
    return r6(SV.fall_summary(gm), "avg_activity")


@register("a12_movement_summary", W() + """
SELECT patient_id, count(avg_activity) AS movement_windows, round(avg(avg_activity), 6) AS avg_activity,
  max(peak_impact) AS peak_impact, CAST(sum(fall_events_detected) AS BIGINT) AS total_falls
FROM fx_gold_m GROUP BY patient_id""")
def q_msum(spark, d):
    gm = gold_m(spark, d)
    return r6(SV.movement_summary(gm, detailed=True), "avg_activity")


@register("j01_patient_profile", W() + """
SELECT patient_id, round(avg_hr, 6) AS avg_hr, round(avg_spo2, 6) AS avg_spo2, max_mews, round(avg_mews, 6) AS avg_mews,
  windows, round(avg_act, 6) AS avg_act, falls,
  round((avg_hr - 30) / 190, 6) AS hr_norm, round((avg_spo2 - 90) / 10, 6) AS spo2_norm,
  round(1 - max_mews / 6, 6) AS mews_inv, round(least(avg_act / 50, 1.0), 6) AS act_norm,
  round(least(falls / 10, 1.0), 6) AS fall_risk
FROM (SELECT v.patient_id, v.avg_hr, v.avg_spo2, v.max_mews, v.avg_mews, v.windows,
        coalesce(m.avg_act, 0) AS avg_act, coalesce(m.falls, 0) AS falls
      FROM (SELECT patient_id, avg(avg_hr) AS avg_hr, avg(avg_spo2) AS avg_spo2, max(mews_score) AS max_mews,
              avg(mews_score) AS avg_mews, count(avg_hr) AS windows FROM fx_gold_v GROUP BY patient_id) v
      LEFT JOIN (SELECT patient_id, avg(avg_activity) AS avg_act, CAST(sum(fall_events_detected) AS BIGINT) AS falls
                 FROM fx_gold_m GROUP BY patient_id) m ON v.patient_id = m.patient_id) p""")
def q_profile(spark, d):
    gv, gm = gold(spark, d)
    return r6(SV.patient_profile(gv, gm), "avg_hr", "avg_spo2", "avg_mews", "avg_act",
              "hr_norm", "spo2_norm", "mews_inv", "act_norm", "fall_risk")


@register("j02_side_by_side", W() + """
SELECT v.*, coalesce(m.movement_windows, 0) AS movement_windows, coalesce(m.avg_activity, 0) AS avg_activity,
  coalesce(m.peak_impact, 0) AS peak_impact, coalesce(m.total_falls, 0) AS total_falls
FROM (""" + _A09.format(w="vitals_windows", r="round_even(100 * ", r2=", 0) / 100", b="round_even(100 * ", b2=", 0) / 100") + """) v
LEFT JOIN (SELECT patient_id, count(avg_activity) AS movement_windows, round_even(avg(avg_activity) * 100, 0) / 100 AS avg_activity,
             round_even(max(peak_impact) * 100, 0) / 100 AS peak_impact, CAST(sum(fall_events_detected) AS BIGINT) AS total_falls
           FROM fx_gold_m GROUP BY patient_id) m ON v.patient_id = m.patient_id""")
def q_side(spark, d):
    gv, gm = gold(spark, d)
    return SV.side_by_side(gv, gm, 2)


@register("a13_mews_distribution", W() + """
SELECT mews_score, count(*) AS windows FROM fx_gold_v GROUP BY mews_score ORDER BY mews_score""")
def q_mews_dist(spark, d):
    gv = gold_v(spark, d)
    return SV.mews_distribution(gv)


@register("a14_mews_mean", W() + "SELECT floor(avg(mews_score) * 10) / 10 AS mews_mean FROM fx_gold_v")
def q_mews_mean(spark, d):
    gv = gold_v(spark, d)
    return SV.mews_mean(gv)


@register("a15_activity_histogram", W("""r AS (SELECT min(avg_activity) AS lo, max(avg_activity) AS hi FROM fx_gold_m)""") + """
SELECT patient_id, bin, count(*) AS windows, round(lo + (bin - 1) * ((hi - lo) / 20), 6) AS bin_lo,
       round(lo + bin * ((hi - lo) / 20), 6) AS bin_hi
FROM (SELECT patient_id, lo, hi,
        CASE WHEN hi > lo THEN CAST(least(20, floor(20 * (avg_activity - lo) / (hi - lo)) + 1) AS BIGINT) ELSE 1 END AS bin
      FROM fx_gold_m, r WHERE avg_activity IS NOT NULL) b
GROUP BY patient_id, bin, lo, hi""")
def q_hist(spark, d):
    gm = gold_m(spark, d)
    return r6(SV.activity_histogram(gm, 20), "bin_lo", "bin_hi")


@register("o03_vitals_series", W() + """
SELECT patient_id, window_start, avg_hr, peak_hr, avg_spo2, peak_spo2, mews_score, least(mews_score, 5) AS mews_bucket
FROM fx_gold_v ORDER BY patient_id, window_start""")
def q_vseries(spark, d):
    gv = gold_v(spark, d)
    return SV.vitals_series(wall(gv, "window_start"))


@register("o03_movement_series", W() + """
SELECT patient_id, window_start, round(avg_activity, 6) AS avg_activity, peak_impact, fall_events_detected,
  CASE WHEN fall_events_detected > 0 THEN peak_impact END AS fall_marker
FROM fx_gold_m ORDER BY patient_id, window_start""")
def q_mseries(spark, d):
    gm = gold_m(spark, d)
    return r6(SV.movement_series(wall(gm, "window_start")), "avg_activity")


@register("o05_latest_alerts", W() + """
SELECT patient_id, window_start, avg_hr, peak_hr, mews_score FROM fx_gold_v WHERE mews_score > 0
ORDER BY window_start DESC, patient_id LIMIT 100""")
def q_latest_alerts(spark, d):
    gv = gold_v(spark, d)
    return SV.latest_alerts(wall(gv, "window_start"), 100)


@register("o06_latest_falls", W() + """
SELECT patient_id, window_start, fall_events_detected, peak_impact FROM fx_gold_m WHERE fall_events_detected > 0
ORDER BY window_start DESC, patient_id""")
def q_latest_falls(spark, d):
    gm = gold_m(spark, d)
    return SV.latest_falls(wall(gm, "window_start"))


@register("o09_gold_sample", W() + """
SELECT patient_id, avg_hr, peak_hr, avg_spo2, mews_score FROM fx_gold_v ORDER BY patient_id, window_start LIMIT 5""")
def q_sample(spark, d):
    gv = gold_v(spark, d)
    return SV.gold_sample(gv, ["patient_id", "avg_hr", "peak_hr", "avg_spo2", "mews_score", "window_start"]).drop("window_start")


@register("f04_window_text", W() + """
SELECT patient_id, window_start, strftime(window_start, '%Y-%m-%d %H:%M') AS window_start_text,
  strftime(window_start, '%H:%M') AS clock, CASE WHEN mews_score = 1 THEN 'Low' WHEN mews_score = 2 THEN 'Medium'
  WHEN mews_score = 3 THEN 'High' ELSE 'Critical' END AS severity, least(mews_score, 5) AS mews_bucket
FROM fx_gold_v""")
def q_text(spark, d):
    gv = gold_v(spark, d)
    g = SV.with_time_text(wall(gv, "window_start"))
    return g.select("patient_id", "window_start", "window_start_text", fn.fmt_clock("window_start").alias("clock"),
                    fn.severity_label("mews_score").alias("severity"), fn.mews_bucket("mews_score").alias("mews_bucket"))


# =============================================================================
# Alert rules
# =============================================================================
_ALERT_SQL = """
SELECT patient_id, epoch_s AS timestamp, 'TACHYCARDIA' AS alert_type, heart_rate, CAST(NULL AS DOUBLE) AS spo2_level,
  CAST(NULL AS INTEGER) AS stress_level, CAST(NULL AS DOUBLE) AS impact_force, CAST(NULL AS VARCHAR) AS activity_at_time
FROM fx_raw WHERE device_type = 'vital_monitor' AND heart_rate <> 0 AND heart_rate > {tachy}
UNION ALL
SELECT patient_id, epoch_s, 'BRADYCARDIA', heart_rate, NULL, NULL, NULL, NULL
FROM fx_raw WHERE device_type = 'vital_monitor' AND heart_rate <> 0 AND heart_rate < {brady}
UNION ALL
SELECT patient_id, epoch_s, 'HYPOXIA', NULL, spo2, NULL, NULL, NULL
FROM fx_raw WHERE device_type = 'vital_monitor' AND spo2 <> 0 AND spo2 < {hypo}
{stress}UNION ALL
SELECT patient_id, epoch_s, 'FALL_DETECTED', NULL, NULL, NULL, round_even(sqrt(x * x + y * y + z * z), 2),
  coalesce(CASE activity_code {names} END, 'unknown')
FROM fx_raw WHERE device_type = 'imu_sensor' AND sqrt(x * x + y * y + z * z) > {fall}"""

_NAMES_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ACTIVITY_NAMES.items())
_STRESS_SQL = """UNION ALL
SELECT patient_id, epoch_s, 'HIGH_STRESS', NULL, NULL, CAST(stress_level AS INTEGER), NULL, NULL
FROM fx_raw WHERE device_type = 'vital_monitor' AND stress_level <> 0 AND stress_level >= {stress}
"""


def _alert_rows(t: S.AlertThresholds) -> str:
    stress = _STRESS_SQL.format(stress=t.high_stress) if t.emit_high_stress else ""
    return _ALERT_SQL.format(tachy=t.tachycardia_hr, brady=t.bradycardia_hr, hypo=t.hypoxia_spo2, fall=t.fall_svm,
                             names=_NAMES_SQL, stress=stress)


def _alert_sql(t: S.AlertThresholds) -> str:
    return W() + _alert_rows(t)


ALERTS_STANDARD = _alert_rows(S.STANDARD)


def _alerts(spark, d, t):
    from pulsegrid.functions.scalars import svm
    ev = fx_events(spark, d).withColumn("svm", svm())
    return AL.all_alerts(ev, t)


@register("r06_alerts_standard", _alert_sql(S.STANDARD))
def q_alerts_std(spark, d):
    return _alerts(spark, d, S.STANDARD)


@register("r08_alerts_sensitive", _alert_sql(S.SENSITIVE))
def q_alerts_sens(spark, d):
    return _alerts(spark, d, S.SENSITIVE)


@register("r04_alerts_with_stress", _alert_sql(S.STANDARD.with_(emit_high_stress=True)))
def q_alerts_stress(spark, d):
    return _alerts(spark, d, S.STANDARD.with_(emit_high_stress=True))


@register("r06_alert_type_counts", W() + """
SELECT alert_type, count(*) AS alerts, count(DISTINCT patient_id) AS patients FROM ("""
          + _ALERT_SQL.format(tachy=130.0, brady=40.0, hypo=90.0, fall=25.0, names=_NAMES_SQL,
                              stress=_STRESS_SQL.format(stress=8.0)) + ") a GROUP BY alert_type")
def q_alert_counts(spark, d):
    a = _alerts(spark, d, S.STANDARD.with_(emit_high_stress=True))
    return a.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"), F.count_distinct("patient_id").alias("patients"))


@register("u01_union_alert_streams", W() + """
SELECT alert_type, count(*) AS alerts FROM (""" + _ALERT_SQL.format(
    tachy=130.0, brady=40.0, hypo=90.0, fall=25.0, names=_NAMES_SQL, stress="") + ") a GROUP BY alert_type")
def q_union_alerts(spark, d):
    from pulsegrid.functions.scalars import svm
    v, m, _ = route(fx_events(spark, d))
    u = AL.union_alerts(AL.vitals_alerts(v), AL.movement_alerts(m.withColumn("svm", svm())))
    return u.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))


@register("r07_encoded_alerts", W() + """
SELECT patient_id AS key, alert_type, heart_rate, spo2_level, impact_force, activity_at_time FROM ("""
          + _ALERT_SQL.format(tachy=130.0, brady=40.0, hypo=90.0, fall=25.0, names=_NAMES_SQL, stress="") + ") a")
def q_encoded(spark, d):
    rec = AL.encode_alerts(_alerts(spark, d, S.STANDARD))
    # decoded back from the JSON text: proves the wire format round-trips
    return rec.select("key", F.from_json("value", S.ALERT_SCHEMA).alias("a")).select(
        "key", "a.alert_type", "a.heart_rate", "a.spo2_level", "a.impact_force", "a.activity_at_time")


def queries() -> dict[str, Query]:
    from pulsegrid.plans import catalog_data  # noqa: F401  (registers dataset/storage queries)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from pulsegrid.plans import catalog_data  # noqa: F401
    return dict(ORACLES)
