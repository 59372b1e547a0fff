"""Event, envelope, alert and layer schemas plus the domain constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: event layouts as the devices send them -------------------
VITALS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("heart_rate", T.DoubleType()),
    T.StructField("spo2", T.DoubleType()),
    T.StructField("step_count", T.DoubleType()),
    T.StructField("sleep_duration", T.DoubleType()),
    T.StructField("activity_level", T.StringType()),
    T.StructField("stress_level", T.DoubleType()),
])

MOVEMENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("activity_code", T.StringType()),
    T.StructField("activity_name", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("svm", T.DoubleType()),
])


def _merge(*schemas: T.StructType) -> T.StructType:
    seen, fields = set(), []
    for s in schemas:
        for f in s.fields:
            if f.name not in seen:
                seen.add(f.name)
                fields.append(f)
    return T.StructType(fields)


# Both event kinds in one frame (landing files mix them).
EVENT_SCHEMA = _merge(VITALS_SCHEMA, MOVEMENT_SCHEMA)

# Kafka envelope as written to the landing zone: the event sits under `value`.
ENVELOPE_FIELDS = ["offset", "partition", "timestamp", "key", "value"]
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", EVENT_SCHEMA),
])

# A landing line is either a bare event or an envelope; one schema reads both
# (envelope `timestamp` is ms as long, event `timestamp` is s as double, so the
# top-level field is read as double and only used when there is no envelope).
LANDING_SCHEMA = _merge(EVENT_SCHEMA, T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", EVENT_SCHEMA),
]))

ALERT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("heart_rate", T.DoubleType()),
    T.StructField("spo2_level", T.DoubleType()),
    T.StructField("stress_level", T.IntegerType()),
    T.StructField("impact_force", T.DoubleType()),
    T.StructField("activity_at_time", T.StringType()),
])

# Kafka record layout (what the kafka source yields / the sink takes).
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# --- fixed values: smartwatch dataset columns, all read as text --------------
SMARTWATCH_COLUMNS = [
    "User ID", "Heart Rate (BPM)", "Blood Oxygen Level (%)", "Step Count",
    "Sleep Duration (hours)", "Activity Level", "Stress Level",
]
SMARTWATCH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SMARTWATCH_COLUMNS])

SENSOR_RAW_COLUMNS = ["subject_id", "activity_code", "timestamp", "x", "y", "z"]

# --- fixed values: domain constants ----------------------------------------
VITALS_DEVICE = "vital_monitor"
MOVEMENT_DEVICE = "imu_sensor"
FALL_SVM_THRESHOLD = 25.0
WINDOW_MINUTES = 10
SILVER_HR_RANGE = (30, 220)
SILVER_SPO2_RANGE = (90, 100)
LINEAGE_COLUMNS = ["etl_processed_time", "source_file", "etl_batch_date", "etl_run_id"]

# --- fixed values: activity codes of the sensor dataset (A..S without N) ----
ACTIVITY_NAMES = {
    "A": "walking", "B": "jogging", "C": "stairs", "D": "sitting",
    "E": "standing", "F": "typing", "G": "teeth", "H": "soup",
    "I": "chips", "J": "pasta", "K": "drinking", "L": "sandwich",
    "M": "kicking", "O": "catch", "P": "dribbling", "Q": "writing",
    "R": "clapping", "S": "folding",
}

# --- fixed values: smartwatch label corrections (exact match) --------------
ACTIVITY_LABEL_FIXES = {"Actve": "Active", "Seddentary": "Sedentary", "Highly_Active": "Highly Active"}
ACTIVITY_LABEL_NULLS = ["nan"]


@dataclass(frozen=True)
class AlertThresholds:
    """Alert rule limits. HIGH_STRESS is documented but off unless asked."""
    tachycardia_hr: float = 130.0
    bradycardia_hr: float = 40.0
    hypoxia_spo2: float = 90.0
    high_stress: float = 8.0
    fall_svm: float = FALL_SVM_THRESHOLD
    emit_high_stress: bool = False

    def with_(self, **kw) -> "AlertThresholds":
        return AlertThresholds(**{**self.__dict__, **kw})


# --- fixed values: the two threshold presets -------------------------------
STANDARD = AlertThresholds(130.0, 40.0, 90.0, 8.0)
SENSITIVE = AlertThresholds(125.0, 45.0, 95.0, 9.0)
PRESETS = {"standard": STANDARD, "sensitive": SENSITIVE}
