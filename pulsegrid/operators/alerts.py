"""Rule engine: each reading yields zero or more alerts in a single pass.

The rules are evaluated as one array of optional alert structs per row,
nulls filtered out, then exploded (R06) - one scan, no union of per-rule
filters, no shuffle. The same functions run on batch frames and on
streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.scalars import py_round, valid_reading

_PAYLOAD = ["heart_rate", "spo2_level", "stress_level", "impact_force", "activity_at_time"]
_NULLS = {"heart_rate": "double", "spo2_level": "double", "stress_level": "int",
          "impact_force": "double", "activity_at_time": "string"}


def _alert(kind: str, **payload: Column) -> Column:
    fields = [F.lit(kind).alias("alert_type")]
    for name in _PAYLOAD:
        fields.append((payload[name] if name in payload else F.lit(None).cast(_NULLS[name])).alias(name))
    return F.struct(*fields)


def vitals_rules(t: S.AlertThresholds = S.STANDARD) -> list[Column]:
    """R01-R04 as conditional alert structs over vitals columns."""
    hr, sp, st = F.col("heart_rate"), F.col("spo2"), F.col("stress_level")
    rules = [
        # One heart-rate alert at most (tachycardia wins)
        F.when(valid_reading(hr) & (hr > t.tachycardia_hr), _alert("TACHYCARDIA", heart_rate=hr))
         .when(valid_reading(hr) & (hr < t.bradycardia_hr), _alert("BRADYCARDIA", heart_rate=hr)),
        # R03
        F.when(valid_reading(sp) & (sp < t.hypoxia_spo2), _alert("HYPOXIA", spo2_level=sp)),
    ]
    if t.emit_high_stress:  # R04, documented but off by default
        rules.append(F.when(valid_reading(st) & (st >= t.high_stress),
                            _alert("HIGH_STRESS", stress_level=st.cast("int"))))
    return rules


def movement_rules(t: S.AlertThresholds = S.STANDARD) -> list[Column]:
    """Fall when the magnitude exceeds the threshold; impact rounded to
    2 places as the consumer engine's Python `round` does."""
    s = F.col("svm")
    return [F.when(s.isNotNull() & ~F.isnan(s) & (s > t.fall_svm),
                   _alert("FALL_DETECTED", impact_force=py_round(s, 2),
                          activity_at_time=F.coalesce(F.col("activity_name"), F.lit("unknown"))))]


def _explode_rules(df: DataFrame, rules: list[Column], keep: Sequence[str] = ()) -> DataFrame:
    arr = F.filter(F.array(*rules), lambda a: a.isNotNull())
    return (df.select("patient_id", F.col("timestamp").cast("double").alias("timestamp"), *keep,
                      F.explode(arr).alias("a"))
            .select("patient_id", "timestamp", "a.*", *keep))


def vitals_alerts(vitals: DataFrame, t: S.AlertThresholds = S.STANDARD, keep: Sequence[str] = ()) -> DataFrame:
    """Alerts from vitals readings (ST01); ``keep`` names further columns."""
    for c in ("heart_rate", "spo2", "stress_level"):
        if c not in vitals.columns:
            vitals = vitals.withColumn(c, F.lit(None).cast("double"))
    return _explode_rules(vitals, vitals_rules(t), keep)


def movement_alerts(movement: DataFrame, t: S.AlertThresholds = S.STANDARD, keep: Sequence[str] = ()) -> DataFrame:
    """Fall alerts from movement readings (ST02); ``keep`` names further columns."""
    if "activity_name" not in movement.columns:
        movement = movement.withColumn("activity_name", F.lit(None).cast("string"))
    return _explode_rules(movement, movement_rules(t), keep)


def all_alerts(events: DataFrame, t: S.AlertThresholds = S.STANDARD) -> DataFrame:
    """Alerts of a mixed event frame in one pass (R06 + U01): vitals rules
    apply to vitals devices, the fall rule to movement devices."""
    d = F.col("device_type")
    for c, typ in (("heart_rate", "double"), ("spo2", "double"), ("stress_level", "double"),
                   ("svm", "double"), ("activity_name", "string")):
        if c not in events.columns:
            events = events.withColumn(c, F.lit(None).cast(typ))
    rules = [F.when(d == S.VITALS_DEVICE, r) for r in vitals_rules(t)]
    rules += [F.when(d == S.MOVEMENT_DEVICE, r) for r in movement_rules(t)]
    return _explode_rules(events, rules)


def union_alerts(*frames: DataFrame) -> DataFrame:
    """UNION ALL of alert frames by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def encode_alerts(alerts: DataFrame, *more: Column) -> DataFrame:
    """Kafka record of an alert (R07): key = patient id, value = JSON object
    without null fields; ``more`` are further columns of the record."""
    cols = [c for c in ["patient_id", "timestamp", "alert_type", *_PAYLOAD] if c in alerts.columns]
    return alerts.select(F.col("patient_id").cast("string").alias("key"),
                         F.to_json(F.struct(*cols)).alias("value"), *more)


def decode_alerts(records: DataFrame) -> DataFrame:
    """Inverse of :func:`encode_alerts` (for consumers and tests)."""
    return records.select(F.from_json(F.col("value").cast("string"), S.ALERT_SCHEMA).alias("a")).select("a.*")
