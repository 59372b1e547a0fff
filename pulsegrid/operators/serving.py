"""Serving analytics over Gold: the questions a monitoring dashboard asks.

Inputs are the Gold frames (`gold_vitals`, `gold_movement`), already
filtered by batch date through partition pruning. Per-patient summaries are
hash aggregations keyed by patient; joins between two such summaries reuse
that partitioning (no extra exchange), and global figures are one-pass
aggregates, never a driver loop.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import (
    fmt_clock, fmt_minute, is_fall, kpi_falls_class, kpi_mews_class, np_round, radar_norms,
)

DEFAULT_MEWS_MIN = 2


# --- filters (P16-P20) -------------------------------------------------------
def filter_vitals(v: DataFrame, patients: Iterable[str] | None = None,
                  hr_range: tuple[float, float] = (30, 220), spo2_min: float = 90) -> DataFrame:
    """Selected patients, window mean HR inside the range, mean SpO2 at least the minimum."""
    if patients is not None:
        v = v.filter(F.col("patient_id").isin(list(patients)))
    return v.filter(F.col("avg_hr").between(*hr_range) & (F.col("avg_spo2") >= spo2_min))


def filter_movement(m: DataFrame, patients: Iterable[str] | None = None, only_falls: bool = False) -> DataFrame:
    """Selected patients, optionally only windows with falls."""
    if patients is not None:
        m = m.filter(F.col("patient_id").isin(list(patients)))
    if only_falls:
        m = m.filter(F.col("fall_events_detected") > 0)
    return m


def reflag_falls(m: DataFrame, threshold: float) -> DataFrame:
    """Flag windows whose peak impact exceeds a caller threshold."""
    return m.withColumn("is_fall", is_fall("peak_impact", threshold))


def alert_windows(v: DataFrame) -> DataFrame:
    """Windows with any early-warning points (P20)."""
    return v.filter(F.col("mews_score") > 0)


def table_view(df: DataFrame, sort_col: str, n: int, patients: Iterable[str] | None = None,
               mews_levels: Iterable[int] | None = None, only_falls: bool = False,
               tiebreak: tuple[str, ...] = ("patient_id", "window_start")) -> DataFrame:
    """Table panel (P19/O04): filters, sort by a column descending, first n.
    Equal sort keys are broken by patient and window so the page is stable."""
    if patients is not None:
        df = df.filter(F.col("patient_id").isin(list(patients)))
    if mews_levels is not None:
        df = df.filter(F.col("mews_score").isin(list(mews_levels)))
    if only_falls:
        df = df.filter(F.col("fall_events_detected") > 0)
    order = [F.col(sort_col).desc_nulls_last()] + [F.col(c).asc() for c in tiebreak if c != sort_col]
    return df.orderBy(*order).limit(int(n))


# --- global figures ---------------------------------------------------------------
def _tagged_union(v: DataFrame, m: DataFrame, vcols: list[str], mcols: list[str]) -> DataFrame:
    """Both Gold tables as one frame; each side's columns are null on the other."""
    return v.select(*vcols).unionByName(m.select(*mcols), allowMissingColumns=True)


def kpis(v: DataFrame, m: DataFrame) -> DataFrame:
    """KPI row (A07/A08): one scan of each table, one global aggregate; always
    one row. Means are means of window means; max MEWS and falls are 0 when
    there is nothing selected."""
    u = _tagged_union(v, m, ["avg_hr", "avg_spo2", "mews_score"],
                      ["fall_events_detected", "avg_activity", "peak_impact"])
    k = u.agg(
        F.avg("avg_hr").alias("avg_hr"),
        F.avg("avg_spo2").alias("avg_spo2"),
        F.coalesce(F.max("mews_score"), F.lit(0)).alias("max_mews"),
        F.coalesce(F.sum("fall_events_detected"), F.lit(0)).cast("long").alias("total_falls"),
        F.avg("avg_activity").alias("avg_activity"),
        F.max("peak_impact").alias("peak_impact"),
    )
    return k.withColumns({"mews_class": kpi_mews_class("max_mews"),
                          "falls_class": kpi_falls_class("total_falls")})


def selection_counts(v: DataFrame, m: DataFrame) -> DataFrame:
    """Header figures (A29): distinct patients over both tables, window counts."""
    u = (v.select("patient_id", F.lit(1).alias("_v"))
         .unionByName(m.select("patient_id", F.lit(1).alias("_m")), allowMissingColumns=True))
    return u.agg(F.count_distinct("patient_id").alias("patients"),
                 F.count("_v").alias("vitals_windows"),
                 F.count("_m").alias("movement_windows"))


def all_patients(v: DataFrame, m: DataFrame) -> DataFrame:
    """Distinct, sorted patient ids over both Gold tables, nulls dropped."""
    return (v.select("patient_id").union(m.select("patient_id"))
            .dropna().distinct().orderBy("patient_id"))


# --- per-patient summaries ----------------------------------------------------------
def vitals_summary(v: DataFrame, mews_min: int = DEFAULT_MEWS_MIN, windows_name: str = "windows") -> DataFrame:
    """Per-patient vitals figures."""
    return v.groupBy("patient_id").agg(
        F.count("avg_hr").alias(windows_name),
        F.avg("avg_hr").alias("avg_hr"),
        F.min("avg_hr").alias("min_hr"),
        F.max("peak_hr").alias("max_hr"),
        F.avg("avg_spo2").alias("avg_spo2"),
        F.min("avg_spo2").alias("min_spo2"),
        F.max("mews_score").alias("max_mews"),
        F.avg("mews_score").alias("avg_mews"),
        F.count_if(F.col("mews_score") >= mews_min).alias("alert_windows"),
    )


def fall_summary(m: DataFrame) -> DataFrame:
    """Per-patient fall figures and fall rate in % to one place."""
    s = m.groupBy("patient_id").agg(
        F.sum("fall_events_detected").cast("long").alias("total_falls"),
        F.count_if(F.col("fall_events_detected") > 0).alias("fall_windows"),
        F.avg("avg_activity").alias("avg_activity"),
        F.max("peak_impact").alias("peak_impact"),
        F.count("avg_activity").alias("windows"),
    )
    return s.withColumn("fall_rate", np_round(F.col("fall_windows") / F.col("windows") * 100, 1))


def movement_summary(m: DataFrame, detailed: bool = True) -> DataFrame:
    """Per-patient movement figures (A12): the comparison set (detailed) or
    the radar set."""
    if detailed:
        return m.groupBy("patient_id").agg(
            F.count("avg_activity").alias("movement_windows"),
            F.avg("avg_activity").alias("avg_activity"),
            F.max("peak_impact").alias("peak_impact"),
            F.sum("fall_events_detected").cast("long").alias("total_falls"),
        )
    return m.groupBy("patient_id").agg(
        F.avg("avg_activity").alias("avg_act"),
        F.sum("fall_events_detected").cast("long").alias("falls"),
    )


def patient_profile(v: DataFrame, m: DataFrame) -> DataFrame:
    """Radar comparison (J01 + F01): vitals summary left-joined to movement
    summary; patients without movement get 0."""
    vs = v.groupBy("patient_id").agg(
        F.avg("avg_hr").alias("avg_hr"),
        F.avg("avg_spo2").alias("avg_spo2"),
        F.max("mews_score").alias("max_mews"),
        F.avg("mews_score").alias("avg_mews"),
        F.count("avg_hr").alias("windows"),
    )
    p = vs.join(movement_summary(m, detailed=False), "patient_id", "left").fillna(0, subset=["avg_act", "falls"])
    return p.withColumns(radar_norms("avg_hr", "avg_spo2", "max_mews", "avg_act", "falls"))


def side_by_side(v: DataFrame, m: DataFrame, mews_min: int = DEFAULT_MEWS_MIN) -> DataFrame:
    """Comparison table (J02): 9 vitals metrics left-joined to 4 movement
    metrics, missing -> 0, fractional figures rounded to 2 places as pandas does."""
    s = vitals_summary(v, mews_min, windows_name="vitals_windows").join(
        movement_summary(m, detailed=True), "patient_id", "left")
    s = s.fillna(0, subset=["movement_windows", "avg_activity", "peak_impact", "total_falls"])
    frac = ["avg_hr", "min_hr", "max_hr", "avg_spo2", "min_spo2", "avg_mews", "avg_activity", "peak_impact"]
    return s.withColumns({c: np_round(F.col(c), 2) for c in frac})


# --- distributions ----------------------------------------------------------------
def mews_distribution(v: DataFrame) -> DataFrame:
    """Windows per MEWS score, ascending score."""
    return v.groupBy("mews_score").agg(F.count(F.lit(1)).alias("windows")).orderBy("mews_score")


def mews_mean(v: DataFrame) -> DataFrame:
    """Mean MEWS truncated to one decimal."""
    return v.agg((F.floor(F.avg("mews_score") * 10) / 10).alias("mews_mean"))


def activity_histogram(m: DataFrame, bins: int = 20, col: str = "avg_activity") -> DataFrame:
    """Per-patient histogram of window activity over equal-width bins spanning
    the global range (A15). The range is two scalar subqueries (one small
    job), so rows are binned in place with no join; the maximum falls in the
    last bin and a zero-width range puts everything in bin 1."""
    lo = m.select(F.min(col)).scalar()
    hi = m.select(F.max(col)).scalar()
    x = F.col(col)
    b = F.when(hi > lo, F.least(F.lit(bins).cast("long"), F.width_bucket(x, lo, hi, F.lit(bins)))).otherwise(F.lit(1).cast("long"))
    width = (hi - lo) / bins
    return (m.filter(x.isNotNull()).withColumn("bin", b)
            .groupBy("patient_id", "bin").agg(F.count(F.lit(1)).alias("windows"))
            .withColumns({"bin_lo": lo + (F.col("bin") - 1) * width, "bin_hi": lo + F.col("bin") * width}))


# --- top-k and ordered series --------------------------------------------------------
def critical_banners(v: DataFrame, mews_min: int = DEFAULT_MEWS_MIN, k: int = 5) -> DataFrame:
    """Worst k windows with MEWS >= threshold (O01), tie-broken by patient and window."""
    return (v.filter(F.col("mews_score") >= mews_min)
            .orderBy(F.col("mews_score").desc(), "patient_id", "window_start").limit(k)
            .select("patient_id", "window_start", "mews_score", "avg_hr", "avg_spo2",
                    "mews_hr_score", "mews_spo2_score", fmt_clock("window_start").alias("clock")))


def fall_banners(m: DataFrame, k: int = 3) -> DataFrame:
    """The k windows with the most falls."""
    return (m.filter(F.col("fall_events_detected") > 0)
            .orderBy(F.col("fall_events_detected").desc(), "patient_id", "window_start").limit(k)
            .select("patient_id", "window_start", "fall_events_detected", "peak_impact",
                    fmt_clock("window_start").alias("clock")))


def vitals_series(v: DataFrame) -> DataFrame:
    """Per-patient time series of window means and peaks."""
    return (v.select("patient_id", "window_start", "avg_hr", "peak_hr", "avg_spo2", "peak_spo2",
                     "mews_score", F.least("mews_score", F.lit(5)).alias("mews_bucket"))
            .orderBy("patient_id", "window_start"))


def movement_series(m: DataFrame) -> DataFrame:
    """Per-patient activity series with fall markers at the peak."""
    return (m.select("patient_id", "window_start", "avg_activity", "peak_impact", "fall_events_detected",
                     F.when(F.col("fall_events_detected") > 0, F.col("peak_impact")).alias("fall_marker"))
            .orderBy("patient_id", "window_start"))


def latest_alerts(v: DataFrame, k: int = 100) -> DataFrame:
    """Newest k windows with MEWS > 0."""
    return (alert_windows(v).select("patient_id", "window_start", "avg_hr", "peak_hr", "mews_score")
            .orderBy(F.col("window_start").desc(), "patient_id").limit(k))


def latest_falls(m: DataFrame) -> DataFrame:
    """All fall windows, newest first."""
    return (m.filter(F.col("fall_events_detected") > 0)
            .select("patient_id", "window_start", "fall_events_detected", "peak_impact")
            .orderBy(F.col("window_start").desc(), "patient_id"))


def gold_sample(df: DataFrame, cols: list[str], k: int = 5,
                order: tuple[str, ...] = ("patient_id", "window_start")) -> DataFrame:
    """A few Gold rows in a defined order."""
    return df.select(*cols).orderBy(*order).limit(k)


def with_time_text(df: DataFrame, col: str = "window_start") -> DataFrame:
    """Add `yyyy-MM-dd HH:mm` text of a time column."""
    return df.withColumn(f"{col}_text", fmt_minute(col))


def avg_hr_by_patient(silver_or_bronze: DataFrame, date_filter: Column) -> DataFrame:
    """Average heart rate per patient inside a (partition) date filter."""
    return (silver_or_bronze.filter(date_filter).groupBy("patient_id")
            .agg(F.avg("heart_rate").alias("avg_hr")))
