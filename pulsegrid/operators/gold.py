"""Silver -> Gold: per patient x tumbling event-time window aggregates.

Aggregates are algebraic (avg, max, sum), so Spark runs them as partial
(map-side) + final hash aggregation: a hot patient costs one partial row per
map task, not a skewed reducer. The shuffle is keyed by (patient, window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.scalars import is_fall, mews_hr, mews_simple, mews_spo2
from pulsegrid.operators.clean import drop_unkeyed


def window_bounds(ts_col: str = "event_timestamp", minutes: int = S.WINDOW_MINUTES):
    """Tumbling window, epoch aligned, half open [start, end)."""
    return F.window(F.col(ts_col), f"{int(minutes)} minutes")


def _keys(df: DataFrame, minutes: int) -> list:
    keys = ["patient_id"]
    if "etl_batch_date" in df.columns:
        # a batch date is a processing date: the same window can appear in two
        # batches and then gives two Gold rows
        keys.append("etl_batch_date")
    return keys + [window_bounds("event_timestamp", minutes).alias("window")]


def _flatten(df: DataFrame, keys_out: list[str], rest: list[str]) -> DataFrame:
    return df.select(*keys_out, F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def vitals_state(silver: DataFrame, minutes: int = S.WINDOW_MINUTES) -> DataFrame:
    """Mergeable part of :func:`gold_vitals`: sums, counts and maxima per
    patient, window (and batch date and run, where Silver has them)."""
    return _state(silver, minutes, [
        F.sum("heart_rate").alias("hr_sum"), F.count("heart_rate").alias("hr_n"), F.max("heart_rate").alias("hr_max"),
        F.sum("spo2").alias("spo2_sum"), F.count("spo2").alias("spo2_n"), F.max("spo2").alias("spo2_max")])


def merge_vitals(state: DataFrame) -> DataFrame:
    """Gold vitals from the states of any number of runs."""
    g = _merge(state, [(F.sum("hr_sum") / F.sum("hr_n")).alias("avg_hr"), F.max("hr_max").alias("peak_hr"),
                       (F.sum("spo2_sum") / F.sum("spo2_n")).alias("avg_spo2"), F.max("spo2_max").alias("peak_spo2")])
    g = g.withColumns({"mews_hr_score": mews_hr("avg_hr"), "mews_spo2_score": mews_spo2("avg_spo2")})
    return g.withColumn("mews_score", F.col("mews_hr_score") + F.col("mews_spo2_score"))


def movement_state(silver: DataFrame, fall_threshold: float = S.FALL_SVM_THRESHOLD,
                   minutes: int = S.WINDOW_MINUTES) -> DataFrame:
    """Mergeable part of :func:`gold_movement`."""
    return _state(silver, minutes, [
        F.sum("svm").alias("svm_sum"), F.count("svm").alias("svm_n"), F.max("svm").alias("svm_max"),
        F.sum(is_fall("svm", fall_threshold)).cast("long").alias("falls")])


def merge_movement(state: DataFrame) -> DataFrame:
    """Gold movement from the states of any number of runs."""
    return _merge(state, [(F.sum("svm_sum") / F.sum("svm_n")).alias("avg_activity"), F.max("svm_max").alias("peak_impact"),
                          F.sum("falls").alias("fall_events_detected")])


def _state(silver: DataFrame, minutes: int, aggs: list) -> DataFrame:
    silver = drop_unkeyed(silver)
    names = [c for c in ("patient_id", "etl_batch_date", "etl_run_id") if c in silver.columns]
    g = silver.groupBy(*names, window_bounds("event_timestamp", minutes).alias("window")).agg(*aggs)
    return g.select(*names, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    *[c for c in g.columns if c not in (*names, "window")])


def _merge(state: DataFrame, aggs: list) -> DataFrame:
    names = [c for c in ("patient_id", "etl_batch_date") if c in state.columns]
    return state.groupBy(*names, "window_start", "window_end").agg(*aggs)


def gold_vitals(silver: DataFrame, minutes: int = S.WINDOW_MINUTES, scoring: str = "components") -> DataFrame:
    """Windowed vitals with early-warning score (A01, A03-A05; A02 with
    ``scoring='simple'``). Rows without event time or patient are dropped."""
    silver = drop_unkeyed(silver)
    keys = _keys(silver, minutes)
    g = silver.groupBy(*keys).agg(
        F.avg("heart_rate").alias("avg_hr"),
        F.max("heart_rate").alias("peak_hr"),
        F.avg("spo2").alias("avg_spo2"),
        F.max("spo2").alias("peak_spo2"),
    )
    key_names = [k for k in ("patient_id", "etl_batch_date") if k in silver.columns]
    aggs = ["avg_hr", "peak_hr", "avg_spo2", "peak_spo2"]
    if scoring == "simple":
        return _flatten(g.withColumn("mews_score", mews_simple("avg_hr", "avg_spo2")),
                        key_names, aggs + ["mews_score"])
    g = g.withColumns({"mews_hr_score": mews_hr("avg_hr"), "mews_spo2_score": mews_spo2("avg_spo2")})
    g = g.withColumn("mews_score", F.col("mews_hr_score") + F.col("mews_spo2_score"))
    return _flatten(g, key_names, aggs + ["mews_hr_score", "mews_spo2_score", "mews_score"])


def gold_movement(silver: DataFrame, fall_threshold: float = S.FALL_SVM_THRESHOLD,
                  minutes: int = S.WINDOW_MINUTES) -> DataFrame:
    """Windowed activity, peak impact and fall count."""
    silver = drop_unkeyed(silver)
    keys = _keys(silver, minutes)
    g = silver.groupBy(*keys).agg(
        F.avg("svm").alias("avg_activity"),
        F.max("svm").alias("peak_impact"),
        F.sum(is_fall("svm", fall_threshold)).cast("long").alias("fall_events_detected"),
    )
    key_names = [k for k in ("patient_id", "etl_batch_date") if k in silver.columns]
    return _flatten(g, key_names, ["avg_activity", "peak_impact", "fall_events_detected"])
