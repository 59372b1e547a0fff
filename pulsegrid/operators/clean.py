"""Bronze -> Silver: lineage, routing, envelope handling, typing and cleaning.

All functions are DataFrame -> DataFrame, narrow (no shuffle), and work the
same on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.functions.scalars import (
    activity_name, event_time, py_round, strip_trailing_semicolons, svm, to_number,
)


# --- lineage, routing --------------------------------------------------------
def processing_date() -> Column:
    """Today's UTC date as text."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                        F.current_timestamp().cast("timestamp_ntz"))).cast("string")


def add_lineage(df: DataFrame, run_id: str | None = None, batch_date: str | Column | None = None,
                source_file: Column | str | None = None) -> DataFrame:
    """Processing time, source file, batch date and run id.

    The batch date is the UTC processing date unless given. The source file
    comes from the scan metadata when the frame is a file scan.
    """
    if source_file is None:
        source_file = F.col("_metadata.file_path") if "_metadata" in _hidden(df) else F.lit(None).cast("string")
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    if batch_date is None:
        bd = processing_date()
    elif isinstance(batch_date, str):
        bd = F.lit(batch_date)
    else:  # a row whose date cannot be told gets the processing date
        bd = F.coalesce(batch_date, processing_date())
    return df.withColumns({
        "etl_processed_time": F.current_timestamp(),
        "source_file": source_file,
        "etl_batch_date": bd,
        "etl_run_id": F.lit(run_id).cast("string"),
    })


def _hidden(df: DataFrame) -> set[str]:
    try:
        df.select("_metadata.file_path").schema
        return {"_metadata"}
    except AnalysisException:  # not a file scan
        return set()


def route_name() -> Column:
    """`vitals`, `movement` or `other`, from the device type."""
    d = F.col("device_type")
    return F.when(d == S.VITALS_DEVICE, "vitals").when(d == S.MOVEMENT_DEVICE, "movement").otherwise("other")


def route(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split by device type into (vitals, movement, other).

    Three filters over the same plan; to write or count all three, group or
    partition by :func:`route_name` instead (one pass).
    """
    return tuple(df.filter(route_name() == r) for r in ("vitals", "movement", "other"))


# --- Kafka envelope ------------------------------------------------------------
def unnest_envelope(top: Column, payload: Column) -> dict[str, Column]:
    """Fields of a landing line from its text maps (P03): the line's own fields
    (``top``) and, for `{offset, partition, timestamp, key, value{...}}`, those
    under `value` (``payload``, null for a bare event).

    Every field is coerced on its own (P06): text that is no number becomes
    null and nothing else of the row changes. Payload fields win name clashes
    (`timestamp`). ``extra_fields`` keeps, as received, what the schema has
    no place for: undeclared fields, and values that their type cannot hold.
    """
    has = payload.isNotNull()

    def typed(text: Column, kind: T.DataType) -> Column:
        return text if isinstance(kind, T.StringType) else to_number(text).try_cast(kind)

    declared = {f.name: f.dataType for f in S.EVENT_SCHEMA.fields}
    out = {n: typed(F.when(has, payload[n]).otherwise(top[n]), t) for n, t in declared.items()}
    out |= {f.name: typed(top[f.name], f.dataType) for f in S.LANDING_SCHEMA.fields
            if f.name not in out and f.name != "value"}
    numeric = [n for n, t in declared.items() if not isinstance(t, T.StringType)]
    known = [f.name for f in S.LANDING_SCHEMA.fields]

    def foreign(k: Column, v: Column) -> Column:
        return ~k.isin(known) | (k.isin(numeric) & v.isNotNull() & to_number(v).isNull())

    extra = F.map_filter(F.when(has, payload).otherwise(top), foreign)
    out["extra_fields"] = F.when(F.size(extra) > 0, extra)
    return out


def to_envelope(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Kafka record -> landing envelope (P04): offset, partition, timestamp in
    epoch ms, key text, and the JSON value as a struct (given ``schema``) or
    text; ``keep`` names further columns."""
    return df.select(
        F.col("offset"), F.col("partition"),
        F.unix_millis(F.col("timestamp")).alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value"), *keep,
    )


def parse_value(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """JSON text in `value` -> typed columns (P05). `patient_id` comes from the
    payload, falling back to the message key (no duplicate column)."""
    keep = keep or []
    parsed = df.select(*keep, F.col("key").cast("string").alias("_key"),
                       F.from_json(F.col("value").cast("string"), schema).alias("data"))
    out = parsed.select(*keep, "_key", "data.*")
    if "patient_id" in schema.fieldNames():
        out = out.withColumn("patient_id", F.coalesce("patient_id", "_key"))
    return out.drop("_key")


# --- typing and cleaning -----------------------------------------------------------
def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every field of ``schema`` that the frame lacks as a typed null."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def coerce_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Coerce columns to double; bad text -> null."""
    return df.withColumns({c: to_number(c) for c in cols})


def drop_unkeyed(df: DataFrame, cols: tuple[str, ...] = ("event_timestamp", "patient_id")) -> DataFrame:
    """Drop rows that cannot be keyed (P10)."""
    return df.dropna(subset=list(cols))


def clean_vitals(df: DataFrame, hr_range=S.SILVER_HR_RANGE, spo2_range=S.SILVER_SPO2_RANGE) -> DataFrame:
    """Silver vitals (P06-P09, P11): numbers coerced, both readings present and
    inside the inclusive plausibility ranges, event time from epoch seconds."""
    df = coerce_numbers(ensure_columns(df, S.VITALS_SCHEMA), ["heart_rate", "spo2"])
    hr, sp = F.col("heart_rate"), F.col("spo2")
    return (df.filter(hr.isNotNull() & hr.between(*hr_range)
                      & sp.isNotNull() & sp.between(*spo2_range))
            .withColumn("event_timestamp", event_time("timestamp")))


def clean_movement(df: DataFrame) -> DataFrame:
    """Silver movement (P06-P08, P11, P12): all three axes present, event time,
    signal vector magnitude."""
    df = coerce_numbers(ensure_columns(df, S.MOVEMENT_SCHEMA), ["x", "y", "z"])
    return (df.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
            .withColumn("event_timestamp", event_time("timestamp"))
            .withColumn("svm", svm()))


# --- device event shaping ------------------------------------------------------------
def vitals_event(df: DataFrame, timestamp=None) -> DataFrame:
    """Clean smartwatch row -> vitals event (P13): readings truncated to
    integers, sleep kept fractional, nulls kept; the event time is the send
    time (now) unless a column is given."""
    def num(c):
        return to_number(F.col(c))

    def as_int(c):
        return num(c).cast("long").cast("double")

    ts = timestamp if timestamp is not None else F.unix_micros(F.current_timestamp()) / 1e6
    return df.select(
        num("user_id").cast("long").cast("string").alias("patient_id"),
        F.lit(S.VITALS_DEVICE).alias("device_type"),
        ts.cast("double").alias("timestamp"),
        as_int("heart_rate").alias("heart_rate"),
        as_int("spo2").alias("spo2"),
        as_int("step_count").alias("step_count"),
        num("sleep_duration").alias("sleep_duration"),
        F.col("activity_level"),
        as_int("stress_level").alias("stress_level"),
    )


def movement_event(df: DataFrame, sensor_type: str | None = "accelerometer") -> DataFrame:
    """Sensor-file row -> movement event (P14): trailing `;` stripped from the
    axes, ns -> s, magnitude rounded to 4 places as Python `round` does. With ``sensor_type`` only
    rows of that sensor are used (the raw files mix gyroscope in)."""
    if sensor_type is not None and "sensor_type" in df.columns:
        df = df.filter(F.col("sensor_type") == sensor_type)
    x, y, z = (to_number(strip_trailing_semicolons(F.col(a).cast("string"))) for a in ("x", "y", "z"))
    return (df.select(
        F.col("subject_id").cast("string").alias("patient_id"),
        F.lit(S.MOVEMENT_DEVICE).alias("device_type"),
        F.lit("accelerometer").alias("sensor_type"),
        (to_number(F.col("timestamp").cast("string")) / 1e9).alias("timestamp"),
        F.col("activity_code"),
        activity_name("activity_code").alias("activity_name"),
        x.alias("x"), y.alias("y"), z.alias("z"))
        .withColumn("svm", py_round(svm(), 4)))


def standardise_activity(c: Column | str = "Activity Level") -> Column:
    """Exact-match label fixes, `nan` -> null, then trim (P21). A padded typo is
    therefore only trimmed, not corrected - the order of the original job."""
    c = F.col(f"`{c}`") if isinstance(c, str) else c
    expr = F.when(c.isin(*S.ACTIVITY_LABEL_NULLS), F.lit(None).cast("string"))
    for bad, good in S.ACTIVITY_LABEL_FIXES.items():
        expr = expr.when(c == bad, F.lit(good))
    return F.trim(expr.otherwise(c))
