"""Dataset preparation and profiling: smartwatch cleaning, cleaning report,
null/describe/value-count profiles, alert distribution, sensor statistics.

Everything is a narrow projection/filter or a global/grouped aggregate that
Spark runs partial + final. Exact quantiles are found by counting digits (ranks).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.scalars import np_round, percent, py_round, text_bar, to_number, value_range_text
from pulsegrid.operators.clean import standardise_activity
from pulsegrid.operators.ranks import column_figures, quantile_values

# --- fixed values: dataset column names and their canonical short names ------
SMARTWATCH_NAMES = {
    "User ID": "user_id",
    "Heart Rate (BPM)": "heart_rate",
    "Blood Oxygen Level (%)": "spo2",
    "Step Count": "step_count",
    "Sleep Duration (hours)": "sleep_duration",
    "Activity Level": "activity_level",
    "Stress Level": "stress_level",
}
NUMERIC = ["heart_rate", "spo2", "step_count", "sleep_duration", "stress_level"]

# --- fixed values: cleaning rules in the order the job applies them ----------
# (step, description, column, low, high) - inclusive ranges; null fails.
RANGE_STEPS = [
    (5, "heart rate not in 40..200", "heart_rate", 40, 200),
    (6, "oxygen not in 90..100", "spo2", 90, 100),
    (7, "steps not in 0..25000", "step_count", 0, 25000),
    (8, "sleep not in 0..12 h", "sleep_duration", 0, 12),
    (9, "stress not in 0..10", "stress_level", 0, 10),
]
STEP_MISSING_USER = (1, "no user")
STEP_MISSING_ACTIVITY = (10, "no activity label")


def to_canonical(df: DataFrame) -> DataFrame:
    """Dataset header names -> short names (columns already short are kept)."""
    return df.select(*[F.col(f"`{c}`").alias(SMARTWATCH_NAMES.get(c, c)) for c in df.columns])


def to_dataset_names(df: DataFrame) -> DataFrame:
    back = {v: k for k, v in SMARTWATCH_NAMES.items()}
    return df.select(*[F.col(c).alias(back.get(c, c)) for c in df.columns])


def typed_smartwatch(raw: DataFrame) -> DataFrame:
    """Steps 2-4: labels standardised, readings coerced to numbers
    (`ERROR`, `Very High`, empty -> null)."""
    df = to_canonical(raw)
    return df.select(
        to_number("user_id").alias("user_id"),
        *[to_number(c).alias(c) for c in NUMERIC],
        standardise_activity(F.col("activity_level")).alias("activity_level"),
    )


def _first_failed_step() -> Column:
    """Number of the first cleaning step a typed row fails, 0 if it survives."""
    expr = F.when(F.col("user_id").isNull(), F.lit(STEP_MISSING_USER[0]))
    for step, _, c, lo, hi in RANGE_STEPS:
        expr = expr.when(~F.coalesce(F.col(c).between(lo, hi), F.lit(False)), F.lit(step))
    expr = expr.when(F.col("activity_level").isNull(), F.lit(STEP_MISSING_ACTIVITY[0]))
    return expr.otherwise(F.lit(0))


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, v) for every non-null value of the given columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v"))
                      for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("v").isNotNull())


def quantiles(df: DataFrame, cols: list[str], ps: list[float], exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """(column_name, q): quantiles ``ps`` of each column, linear interpolation,
    exact at any size: a few passes that count digits of the values (see
    :mod:`pulsegrid.operators.ranks`), run when this is called. ``exact=False``
    asks for mergeable sketches over the raw values (rank error 1/accuracy)."""
    if not exact:
        return (_long(df, cols).groupBy("column_name")
                .agg(F.percentile_approx("v", ps, accuracy).cast("array<double>").alias("q")))
    found = quantile_values(df, column_figures(df, cols), ps)
    return df.sparkSession.createDataFrame(list(found.items()), "column_name string, q array<double>")


def impute_median(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """Nulls of each column -> that column's median (A23; see
    :func:`quantiles`), filled in place: no join, nothing is shuffled. A column
    without values stays null."""
    if not exact:
        med = quantiles(df, cols, [0.5], exact, accuracy)
        return df.withColumns({c: F.coalesce(F.col(c), med.filter(F.col("column_name") == c).select(F.col("q")[0]).scalar()) for c in cols})
    found = quantile_values(df, column_figures(df, cols), [0.5])
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c][0])) for c in cols if c in found})


def clean_smartwatch(raw: DataFrame, impute: bool = False) -> DataFrame:
    """The whole cleaning job (P22-P24), steps in the original order:
    drop unknown users, standardise labels, coerce numbers, range filters
    (nulls fail), drop missing labels, median-impute, then final typing.
    The range filters already drop every null of the five imputed columns,
    so imputation cannot change a row; it is skipped unless ``impute`` (it
    would cost one extra aggregation job). Final typing:
    readings rounded as pandas does (half-even on the scaled double) to 2 places, steps rounded to an integer,
    stress and user id truncated."""
    df = typed_smartwatch(raw).filter(_first_failed_step() == 0)
    if impute:
        df = impute_median(df, NUMERIC)
    return df.select(
        F.col("user_id").cast("long").cast("int").alias("user_id"),
        np_round("heart_rate", 2).alias("heart_rate"),
        np_round("spo2", 2).alias("spo2"),
        np_round("step_count", 0).cast("long").cast("int").alias("step_count"),
        np_round("sleep_duration", 2).alias("sleep_duration"),
        F.col("activity_level"),
        F.col("stress_level").cast("long").cast("int").alias("stress_level"),
    )


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Rows removed per step and kept, with % of the input (A26). One pass:
    each row is charged to its first failing step."""
    steps = [STEP_MISSING_USER] + [(s, d) for s, d, *_ in RANGE_STEPS] + [STEP_MISSING_ACTIVITY] + [(0, "kept")]
    t = typed_smartwatch(raw).select(_first_failed_step().alias("step"))
    counts = t.agg(F.count(F.lit(1)).alias("total"),
                   *[F.count_if(F.col("step") == s).alias(f"s{s}") for s, _ in steps])
    stack = "stack({n}, {items}) AS (step, check_name, n_rows)".format(
        n=len(steps), items=", ".join(f"{s}, '{d}', s{s}" for s, d in steps))
    return (counts.selectExpr("total", stack)
            .withColumn("pct_of_input", py_round(percent("n_rows", "total"), 1))
            .select("step", "check_name", "n_rows", "pct_of_input"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column (A22), one global aggregate then unpivot."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    items = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {items}) AS (column_name, nulls)")


def _describe_sketched(df: DataFrame, cols: list[str], accuracy: int) -> DataFrame:
    """Describe without a value histogram (continuous columns): one global
    aggregate of mergeable states - count, mean, Welford variance, min, max
    and a quantile sketch per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"),
                 F.max(x).alias(f"max{i}")]
    items = ", ".join(f"'{c}', n{i}, mean{i}, std{i}, min{i}, q{i}[0], q{i}[1], q{i}[2], max{i}"
                      for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(
        f"stack({len(cols)}, {items}) AS (column_name, count, mean, std, min, p25, p50, p75, max)")


DESCRIBE_SCHEMA = ("column_name string, count long, mean double, std double, min double, p25 double, "
                   "p50 double, p75 double, max double")


def describe_numeric(df: DataFrame, cols: list[str] | None = None, exact: bool = True,
                     accuracy: int = 100_000) -> DataFrame:
    """count, mean, std (sample), min, quartiles (linear interpolation), max
    per column (A24); one row per column. Without ``cols``, every numeric
    column in frame order, as a pandas describe does.

    One pass gives count, mean, standard deviation and range, a few more the
    quartiles, exact at any size (:mod:`pulsegrid.operators.ranks`); they run
    when this is called. With ``exact=False`` one aggregate of mergeable states
    and sketches."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not cols:
        return df.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    if not exact:
        return _describe_sketched(df, cols, accuracy)
    figures = column_figures(df, cols)
    q = quantile_values(df, figures, [0.25, 0.5, 0.75])
    rows = []
    for c, f in figures.items():
        largest = math.nan if f["nan"] else f["hi"]  # NaN is the largest value, and the smallest of none but itself
        smallest = math.nan if f["nan"] == f["count"] > 0 else f["lo"]
        rows.append((c, f["count"], f["mean"], f["std"], smallest, *q.get(c, [None] * 3), largest))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA).coalesce(1)


def value_counts(df: DataFrame, col: str, by_value: bool = False) -> DataFrame:
    """Rows per value (A25): by count descending (ties by value) or by value."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(col) if by_value else g.orderBy(F.col("count").desc(), F.col(col))


# --- fixed values: alert rules of the dataset profile ------------------------
def _dataset_alert_rules():
    return [
        ("HIGH_STRESS", F.col("stress_level") >= 8),
        ("TACHYCARDIA", F.col("heart_rate") > 130),
        ("BRADYCARDIA", F.col("heart_rate") < 40),
        ("HYPOXIA", F.col("spo2") < 90),
    ]


def alert_distribution(clean: DataFrame) -> DataFrame:
    """Rows matching each alert rule, % of all rows and a text bar, most
    frequent first (A16, O07, F06). One pass of count_if, then unpivot."""
    rules = _dataset_alert_rules()
    agg = clean.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(cond).alias(f"a{i}") for i, (_, cond) in enumerate(rules)])
    items = ", ".join(f"{i}, '{name}', a{i}" for i, (name, _) in enumerate(rules))
    d = agg.selectExpr("total", f"stack({len(rules)}, {items}) AS (rule_order, alert_type, alerts)")
    pct = percent("alerts", "total")
    return (d.select("alert_type", "alerts", py_round(pct, 1).alias("pct"),
                     text_bar(pct, 2).alias("bar"), "total", "rule_order")
            .orderBy(F.col("alerts").desc(), "rule_order"))


def stress_breakdown(clean: DataFrame, levels: tuple[int, ...] = (8, 9, 10)) -> DataFrame:
    """Rows per high stress level, zero counts kept."""
    agg = clean.agg(*[F.count_if(F.col("stress_level") == lv).alias(f"l{lv}") for lv in levels])
    items = ", ".join(f"{lv}, l{lv}" for lv in levels)
    return agg.selectExpr(f"stack({len(levels)}, {items}) AS (stress_level, records)")


def vital_ranges(df: DataFrame) -> DataFrame:
    """Min/max heart rate and SpO2."""
    return df.agg(F.min("heart_rate").alias("hr_min"), F.max("heart_rate").alias("hr_max"),
                  F.min("spo2").alias("spo2_min"), F.max("spo2").alias("spo2_max"))


# --- sensor dataset ------------------------------------------------------------
def sensor_statistics(raw: DataFrame) -> DataFrame:
    """Per device x sensor: readings, distinct subjects and activities,
    subject range text, axis means, files (A19, A21, F08).

    Two levels: rows are first aggregated by their distinct keys (subject,
    activity, file), map side, and the distinct counts run on that small
    frame, so no row is expanded for them."""
    keys = [c for c in ("subject_id", "activity_code", "source_file") if c in raw.columns]
    axes = ("x", "y", "z")
    per = raw.groupBy("device_type", "sensor_type", *keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(a).alias(f"{a}_s") for a in axes], *[F.count(a).alias(f"{a}_n") for a in axes])
    agg = [F.sum("n").alias("total_readings"),
           F.count_distinct("subject_id").alias("unique_subjects"),
           F.count_distinct("activity_code").alias("unique_activities"),
           value_range_text(F.min("subject_id"), F.max("subject_id")).alias("subject_range"),
           *[F.try_divide(F.sum(f"{a}_s"), F.sum(f"{a}_n")).alias(f"{a}_mean") for a in axes]]
    if "source_file" in keys:
        agg.append(F.count_distinct("source_file").alias("files"))
    return per.groupBy("device_type", "sensor_type").agg(*agg).withColumn(
        "dataset", F.concat_ws("_", "device_type", "sensor_type"))


def feature_statistics(features: DataFrame) -> DataFrame:
    """Per device x sensor: samples, distinct subjects (`class`), distinct
    activities (`ACTIVITY`) (A20); two levels as :func:`sensor_statistics`."""
    per = features.groupBy("device_type", "sensor_type", "class", "ACTIVITY").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy("device_type", "sensor_type")
            .agg(F.sum("n").alias("total_samples"),
                 F.count_distinct("class").alias("unique_subjects"),
                 F.count_distinct("ACTIVITY").alias("unique_activities"))
            .withColumn("dataset", F.concat_ws("_", "device_type", "sensor_type")))


def dataset_statistics(raw: DataFrame, features: DataFrame) -> DataFrame:
    """The statistics table of the sensor consolidation: one row per raw and
    per processed dataset, told apart by ``type``; figures that a kind does
    not have are null."""
    r = sensor_statistics(raw).select("dataset", F.lit("raw").alias("type"), "total_readings", "unique_subjects",
                                      "unique_activities", "subject_range", "x_mean", "y_mean", "z_mean")
    f = feature_statistics(features).select("dataset", F.lit("processed").alias("type"), "total_samples", "unique_subjects",
                                            "unique_activities")
    return r.unionByName(f, allowMissingColumns=True)


def head_records(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n records in a defined order."""
    return df.orderBy(*order).limit(int(n))
