"""Registered storage queries: each writes the fixture-derived data to a fresh
folder under the shared checkpoint dir, runs the real job/reader, reads the
result back, and removes the folder once the result is checkpointed."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import event_time, utc_wall
from pulsegrid.operators import datasets as DS
from pulsegrid.operators.datasets import feature_statistics
from pulsegrid.operators import serving as SV
from pulsegrid.operators.clean import route
from pulsegrid.plans.catalog import ALERTS_STANDARD, W
from pulsegrid.plans.catalog import register as register_query
from pulsegrid.plans.catalog_data import _WATCH, _na_sql, _names_case
from pulsegrid.plans.etl import run_etl
from pulsegrid.plans.fixtures import FX_SENSOR_SELECT, device_fields_only, fx_events, fx_watch
from pulsegrid.plans.layers import r6, wall
from pulsegrid.session import scratch_path as new_scratch, shared_dir
from pulsegrid.sinks.files import export_csv, land_batch, write_layer
from pulsegrid.sources.files import (
    MANIFEST, MANIFEST_SCHEMA, available_dates, batch_dates, child_files, delete_tree, partition_folder, read_landing,
    read_landing_partitions, read_layer, read_smartwatch_csv, unreadable_files, write_small,
)
from pulsegrid.sources.sensor import read_sensor_features, read_sensor_raw

_OPEN: list[list[str]] = []  # folders of the queries being built


def scratch_path(spark: SparkSession, name: str) -> str:
    path = new_scratch(spark, name)
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def register(name: str, sql: str | None = None):
    """Register a storage query: its result is checkpointed and the folders it
    wrote are deleted."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, d: str) -> DataFrame:
            shared_dir(spark)
            _OPEN.append([])
            try:
                return fn(spark, d).checkpoint()
            finally:
                for path in _OPEN.pop():
                    delete_tree(spark, path)
        register_query(name, sql)(run)
        return run
    return deco


_PAYLOAD = ["patient_id", "device_type", "timestamp", "heart_rate", "spo2", "stress_level",
            "sensor_type", "activity_code", "activity_name", "x", "y", "z"]
GLOB = "*.{json,jsonl,txt}"  # the fixture's landing files are Spark text files


def landing_events(spark: SparkSession, d: str) -> DataFrame:
    """Fixture events with the vitals fields that the other queries do not use."""
    vit = F.col("device_type") != F.lit("imu_sensor")
    e = F.col("event_id")
    return device_fields_only(fx_events(spark, d)).withColumns({
        "step_count": F.when(vit, (e % 900).cast("double")), "sleep_duration": F.when(vit, (e % 19) / 2),
        "activity_level": F.when(vit, F.element_at(F.array(F.lit("Active"), F.lit("Sedentary")), (e % 2 + 1).cast("int")))})


def write_landing(spark: SparkSession, d: str, bad_every: int = 0, rough: bool = False, root: str | None = None) -> str:
    """Fixture events as landing JSON-Lines: even events wrapped in a Kafka
    envelope (ms timestamp clashing with the payload's), odd ones bare; with
    ``bad_every`` every n-th line is cut short (malformed). ``rough`` lines
    carry what devices also send: an undeclared field, readings as text,
    readings that are no number, and no event time (each by event id)."""
    e = F.col("event_id")
    ev = landing_events(spark, d)
    cols = {c: F.col(c) for c in [*_PAYLOAD, "step_count", "sleep_duration", "activity_level"]}
    if rough:
        cols["heart_rate"] = F.when((e % 7 == 0) & F.col("heart_rate").isNotNull(), F.lit("ERROR")).when(
            (e % 5 == 0) & F.col("heart_rate").isNotNull(), F.format_string(" %.0f ", "heart_rate")).otherwise(F.col("heart_rate").cast("string"))
        cols["timestamp"] = F.when(e % 31 != 0, F.col("timestamp"))
        cols["firmware"] = F.struct(F.concat(F.lit("v"), (e % 3).cast("string")).alias("version"))
    payload = F.struct(*[c.alias(n) for n, c in cols.items()])
    env = F.to_json(F.struct(F.col("event_id").alias("offset"), (F.col("event_id") % 4).cast("int").alias("partition"),
                             (F.col("timestamp") * 1000).cast("long").alias("timestamp"),
                             F.col("patient_id").alias("key"), payload.alias("value")))
    line = F.when(F.col("event_id") % 2 == 0, env).otherwise(F.to_json(payload))
    if bad_every:
        line = F.when(F.col("event_id") % bad_every == 0,
                      F.concat(F.lit('{"patient_id": "'), F.col("patient_id"), F.lit('", "heart_rate": '))).otherwise(line)
    root = root or scratch_path(spark, "landing")
    ev.select(line.alias("value")).write.text(root)
    return root


def event_date(ts_col: str = "timestamp"):
    return F.date_format(utc_wall(event_time(ts_col)), "yyyy-MM-dd")


def etl_base(spark: SparkSession, d: str, landing: str | None = None, **kw) -> tuple[str, object]:
    landing = landing or write_landing(spark, d)
    base = scratch_path(spark, "lake")
    res = run_etl(spark, landing, base, batch_date=event_date(), glob=GLOB, **kw)
    return base, res


_LANDED = """SELECT patient_id, device_type, epoch_s AS timestamp,
  CASE WHEN device_type <> 'imu_sensor' THEN heart_rate END AS heart_rate,
  CASE WHEN device_type <> 'imu_sensor' THEN spo2 END AS spo2,
  CASE WHEN device_type <> 'vital_monitor' THEN x END AS x,
  CASE WHEN device_type <> 'vital_monitor' THEN activity_code END AS activity_code,
  CASE WHEN event_id % 2 = 0 THEN event_id END AS "offset",
  CASE WHEN event_id % 2 = 0 THEN patient_id END AS key
FROM fx_raw"""


@register("s01_landing_scan", W() + _LANDED)
def q_landing(spark, d):
    df = read_landing(spark, write_landing(spark, d), glob=GLOB)
    return df.select("patient_id", "device_type", "timestamp", "heart_rate", "spo2", "x", "activity_code",
                     "offset", "key")


@register("s02_landing_quarantine", W() + """
SELECT CASE WHEN event_id % 50 = 0 THEN 'bad' ELSE 'good' END AS status, count(*) AS n_rows FROM fx_raw GROUP BY 1""")
def q_quarantine(spark, d):
    good, bad = read_landing(spark, write_landing(spark, d, bad_every=50), quarantine=True, glob=GLOB)
    g = good.agg(F.lit("good").alias("status"), F.count(F.lit(1)).alias("n_rows"))
    b = bad.agg(F.lit("bad").alias("status"), F.count("raw_line").alias("n_rows"))
    return g.unionByName(b)


@register("s05_read_layer_silver", W() + """
SELECT patient_id, epoch_s AS timestamp, heart_rate, spo2, strftime(event_timestamp, '%Y-%m-%d') AS etl_batch_date
FROM fx_silver_v""")
def q_read_layer(spark, d):
    base, _ = etl_base(spark, d)
    return read_layer(spark, base, "silver", "vitals").select("patient_id", "timestamp", "heart_rate", "spo2",
                                                               "etl_batch_date")


_GOLD_V_DATED = """SELECT *, strftime(window_start, '%Y-%m-%d') AS etl_batch_date FROM fx_gold_v"""


@register("k02_gold_rerun_idempotent", W() + _GOLD_V_DATED)
def q_rerun(spark, d):
    landing = write_landing(spark, d)
    base = scratch_path(spark, "lake")
    for _ in range(2):  # the same batch twice: partitions are replaced, not appended
        run_etl(spark, landing, base, batch_date=event_date(), bronze_mode="overwrite", glob=GLOB)
    g = read_layer(spark, base, "gold", "vitals")
    return wall(g, "window_start", "window_end")


@register("s06_read_batch_date", W() + f"SELECT * FROM ({_GOLD_V_DATED}) g WHERE etl_batch_date = '2024-01-02'")
def q_batch_date(spark, d):
    base, _ = etl_base(spark, d)
    return wall(read_layer(spark, base, "gold", "vitals", batch_date="2024-01-02"), "window_start", "window_end")


@register("s06_missing_batch_date", W() + f"SELECT * FROM ({_GOLD_V_DATED}) g WHERE etl_batch_date = '1999-01-01'")
def q_missing_date(spark, d):
    base, _ = etl_base(spark, d)
    return wall(read_layer(spark, base, "gold", "vitals", batch_date="1999-01-01"), "window_start", "window_end")


@register("s07_available_dates", W() + """
SELECT DISTINCT strftime(window_start, '%Y-%m-%d') AS etl_batch_date FROM fx_gold_m ORDER BY 1 DESC""")
def q_dates(spark, d):
    base, _ = etl_base(spark, d)
    return available_dates(spark, base, "gold", "movement")


_LAYER_COUNTS = """SELECT 'bronze' AS layer, 'vitals' AS data_type, count(*) AS record_count FROM fx_raw WHERE device_type = 'vital_monitor'
UNION ALL SELECT 'bronze', 'movement', count(*) FROM fx_raw WHERE device_type = 'imu_sensor'
UNION ALL SELECT 'silver', 'vitals', count(*) FROM fx_silver_v
UNION ALL SELECT 'silver', 'movement', count(*) FROM fx_silver_m
UNION ALL SELECT 'gold', 'vitals', count(*) FROM fx_gold_v
UNION ALL SELECT 'gold', 'movement', count(*) FROM fx_gold_m"""


@register("k09_run_log", W() + _LAYER_COUNTS + """
UNION ALL SELECT 'landing', 'consumed', count(*) FROM fx_raw
UNION ALL SELECT 'landing', 'rejected', 0
UNION ALL SELECT 'landing', 'other_device', count(*) FROM fx_raw WHERE device_type NOT IN ('vital_monitor', 'imu_sensor')""")
def q_run_log(spark, d):
    base, _ = etl_base(spark, d)
    return spark.read.parquet(f"{base}/_run_log").select("layer", "data_type", "record_count")


@register("s05_file_manifest", W() + _LAYER_COUNTS.replace("record_count", "n_rows") + """
UNION ALL SELECT 'gold', 'broken', count(*) FROM fx_gold_v WHERE strftime(window_start, '%Y-%m-%d') =
  (SELECT min(strftime(window_start, '%Y-%m-%d')) FROM fx_gold_v)""")
def q_file_manifest(spark, d):
    """Rows by the manifest, and the rows lost with the Gold files of the oldest
    date after these are cut short; no other file is opened to find them."""
    base, res = etl_base(spark, d)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{base}/{MANIFEST}")
    out = None
    for layer in ("bronze", "silver", "gold"):
        for ent in ("vitals", "movement"):
            part = rows.where(F.col("path").contains(f"/{layer}/{ent}/")).agg(
                F.lit(layer).alias("layer"), F.lit(ent).alias("data_type"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
            out = part if out is None else out.unionByName(part)
    first = f"{base}/gold/vitals/{partition_folder('etl_batch_date', batch_dates(spark, f'{base}/gold/vitals')[0])}"
    for name in child_files(spark, first):
        write_small(spark, f"{first}/{name}", "PAR1 cut")
    return out.unionByName(unreadable_files(spark, base, "gold", "vitals").agg(
        F.lit("gold").alias("layer"), F.lit("broken").alias("data_type"), F.sum("recorded_rows").alias("n_rows")))


@register("a28_layer_counts", W() + _LAYER_COUNTS)
def q_layer_counts(spark, d):
    base, _ = etl_base(spark, d, run_log=False)
    parts = [read_layer(spark, base, layer, ent).agg(F.lit(layer).alias("layer"), F.lit(ent).alias("data_type"),
                                                     F.count(F.lit(1)).alias("record_count"))
             for layer in ("bronze", "silver", "gold") for ent in ("vitals", "movement")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("st05_min_record_threshold", W() + """
SELECT 'vitals' AS data_type, (SELECT count(*) FROM fx_silver_v) >= 4000 AS written,
  CASE WHEN (SELECT count(*) FROM fx_silver_v) >= 4000 THEN (SELECT count(*) FROM fx_silver_v) ELSE 0 END AS silver_rows
UNION ALL
SELECT 'movement', (SELECT count(*) FROM fx_silver_m) >= 4000,
  CASE WHEN (SELECT count(*) FROM fx_silver_m) >= 4000 THEN (SELECT count(*) FROM fx_silver_m) ELSE 0 END""")
def q_threshold(spark, d):
    base, res = etl_base(spark, d, min_records=4000)
    parts = []
    for ent in ("vitals", "movement"):
        t = read_layer(spark, base, "silver", ent)
        written = ("silver", ent) not in res.skipped and ("bronze", "all") not in res.skipped
        parts.append(t.agg(F.lit(ent).alias("data_type"), F.lit(written).alias("written"),
                           F.count(F.lit(1)).alias("silver_rows")))
    return parts[0].unionByName(parts[1])


@register("k07_csv_roundtrip_clean", W(_WATCH) + "SELECT * FROM w_clean")
def q_csv_clean(spark, d):
    path = scratch_path(spark, "smartwatch_csv")
    export_csv(DS.to_dataset_names(fx_watch(spark, d)), path)
    return DS.clean_smartwatch(read_smartwatch_csv(spark, path))


@register("s08_smartwatch_csv_raw", W() + "SELECT " + ", ".join(
    f"{_na_sql(c)} AS {c}" for c in ["user_id", "heart_rate", "spo2", "step_count", "sleep_duration",
                                     "activity_level", "stress_level"]) + " FROM fx_watch")
def q_csv_raw(spark, d):
    path = scratch_path(spark, "smartwatch_csv")
    export_csv(DS.to_dataset_names(fx_watch(spark, d)), path)
    return DS.to_canonical(read_smartwatch_csv(spark, path))


@register("s11_a27_partitioned_landing_avg_hr", W() + """
SELECT patient_id, avg(heart_rate) AS avg_hr FROM fx_raw
WHERE device_type = 'vital_monitor' AND strftime(make_timestamp(CAST(epoch_s * 1000000 AS BIGINT)), '%Y-%m-%d') = '2024-01-02'
GROUP BY patient_id""")
def q_partitioned(spark, d):
    v, _, _ = route(device_fields_only(fx_events(spark, d)))
    base = scratch_path(spark, "landing_tree")
    land_batch(v.drop("event_id"), base, "vitals", time_col=utc_wall(event_time("timestamp")))
    df = read_landing_partitions(spark, f"{base}/vitals", only={"year": "2024", "month": "01", "day": "02"})
    date = (F.col("year") == "2024") & (F.col("month") == "01") & (F.col("day") == "02")
    return SV.avg_hr_by_patient(df, date)


# the sensor lines with the file each one is stored in: files per subject and
# device/sensor as in the original dataset, cut every 25,000 events, so the
# number of files (and of tasks that write them) grows with the data
_SENSOR_FILE_COLS = ("CAST(1600 + user_id % 51 AS STRING) AS subject, "
                     "CAST(CAST(floor(event_id / 25000) AS BIGINT) AS STRING) AS part")


def _sensor_files(spark: SparkSession, d: str) -> str:
    """Sensor lines under `device_type=/sensor_type=/file=data_<subject>-<part>_
    <sensor>_<device>.txt/`; every line of a (subject, part) is in exactly one
    file."""
    from pulsegrid.plans.fixtures import FX_SENSOR_SELECT, events
    root = scratch_path(spark, "sensor_raw")
    lines = spark.sql(f"SELECT {FX_SENSOR_SELECT}, {_SENSOR_FILE_COLS} FROM {{events}}", events=events(spark, d))
    name = F.format_string("data_%s-%s_%s_%s.txt", "subject", "part", "sensor_type", "device_type")
    (lines.repartition("device_type", "sensor_type", "subject", "part")
     .select("device_type", "sensor_type", name.alias("file"), "line")
     .write.partitionBy("device_type", "sensor_type", "file").text(root))
    return root


def _read_all_sensor(spark, root) -> DataFrame:
    out = None
    for device in ("phone", "watch"):
        for sensor in ("accelerometer", "gyroscope"):
            df = read_sensor_raw(spark, f"{root}/device_type={device}/sensor_type={sensor}", sensor, device, glob="part-*")
            out = df if out is None else out.unionByName(df)
    return out


@register("s09_a19_sensor_files_statistics", W("""s_parsed AS (SELECT device_type, sensor_type,
    CAST(TRY_CAST(f[1] AS DOUBLE) AS BIGINT) AS subject_id, trim(f[2]) AS activity_code,
    TRY_CAST(f[4] AS DOUBLE) AS x, TRY_CAST(f[5] AS DOUBLE) AS y, TRY_CAST(f[6] AS DOUBLE) AS z
  FROM (SELECT device_type, sensor_type, string_split(rtrim(line, ';'), ',') AS f FROM fx_sensor WHERE trim(line) <> '')
  WHERE len(f) <= 6)""") + """
SELECT device_type, sensor_type, count(*) AS total_readings, count(DISTINCT subject_id) AS unique_subjects,
  count(DISTINCT activity_code) AS unique_activities,
  CAST(min(subject_id) AS VARCHAR) || ' - ' || CAST(max(subject_id) AS VARCHAR) AS subject_range,
  round(avg(x), 6) AS x_mean, round(avg(y), 6) AS y_mean, round(avg(z), 6) AS z_mean,
  device_type || '_' || sensor_type AS dataset
FROM s_parsed GROUP BY device_type, sensor_type""")
def q_sensor_files(spark, d):
    raw = _read_all_sensor(spark, _sensor_files(spark, d))
    return r6(DS.sensor_statistics(raw).drop("files"), "x_mean", "y_mean", "z_mean")


@register("a21_files_per_dataset", W() + f"""
SELECT device_type, sensor_type, count(DISTINCT subject || '-' || part) AS files, count(*) AS total_readings
FROM (SELECT device_type, sensor_type, subject, part, string_split(rtrim(line, ';'), ',') AS f
      FROM (SELECT {FX_SENSOR_SELECT}, {_SENSOR_FILE_COLS} FROM events) s WHERE trim(line) <> '') t
WHERE len(f) <= 6 GROUP BY device_type, sensor_type""")
def q_files(spark, d):
    raw = _read_all_sensor(spark, _sensor_files(spark, d))
    return raw.groupBy("device_type", "sensor_type").agg(F.count_distinct("source_file").alias("files"),
                                                         F.count(F.lit(1)).alias("total_readings"))


# --- ARFF feature files (S10, A20) ------------------------------------------------
# fixed values: header of the generated feature files
_ARFF_HEAD = ['@relation person_activities', '% generated from events', '@attribute "ACTIVITY" {A,B,C}',
              '@attribute "X0" numeric', '@attribute "X1" numeric', '@attribute "class" {1600,1601}', '', '@data']


def _feature_files(spark: SparkSession, d: str) -> str:
    """Events as ARFF files `data_<subject>-<part>_accel_<device>.arff` (one for
    every 25,000 events of a subject and device): per-file header, then one row
    per event; every 17th event is a comment line and every 13th row lacks a
    field."""
    from pulsegrid.plans.fixtures import events
    ev = events(spark, d)
    subject = (F.lit(1600) + F.col("user_id") % 5).cast("string")
    device = F.when(F.col("event_id") % 2 == 0, "phone").otherwise("watch")
    part = F.floor(F.col("event_id") / 25000).cast("string")
    fname = F.concat(F.lit("data_"), subject, F.lit("-"), part, F.lit("_accel_"), device, F.lit(".arff"))
    act = F.expr("substr('ABCDEFGHIJKLMOPQRSZ', CAST(1 + event_id % 19 AS INT), 1)")
    x0 = ((F.col("event_id") * 7) % 1000).cast("string")
    x1 = (F.col("event_id") % 100).cast("string")
    row = F.when(F.col("event_id") % 17 == 0, F.lit("% note"))\
        .when(F.col("event_id") % 13 == 0, F.concat_ws(",", act, x0, subject))\
        .otherwise(F.concat_ws(",", act, x0, x1, subject))
    data = ev.select(device.alias("device"), fname.alias("file"), (F.col("event_id") + 1000).alias("ord"), row.alias("line"))
    head = (data.select("device", "file").distinct()
            .select("device", "file", F.posexplode(F.array(*[F.lit(h) for h in _ARFF_HEAD])).alias("ord", "line"))
            .withColumn("ord", F.col("ord").cast("long")))
    root = scratch_path(spark, "features")
    (head.unionByName(data).repartition("file").sortWithinPartitions("device", "file", "ord").drop("ord")
     .write.partitionBy("device", "file").text(root))
    return root


_FEATURES_SQL = """SELECT substr('ABCDEFGHIJKLMOPQRSZ', CAST(1 + event_id % 19 AS INT), 1) AS "ACTIVITY",
  CAST((event_id * 7) % 1000 AS VARCHAR) AS "X0", CAST(event_id % 100 AS VARCHAR) AS "X1",
  CAST(1600 + user_id % 5 AS VARCHAR) AS "class", CAST(CAST(floor(event_id / 25000) AS BIGINT) AS VARCHAR) AS part,
  CASE WHEN event_id % 2 = 0 THEN 'phone' ELSE 'watch' END AS device_type
FROM events WHERE event_id % 17 <> 0 AND event_id % 13 <> 0"""


def _all_features(spark, d):
    root = _feature_files(spark, d)
    cols = ["ACTIVITY", "X0", "X1", "class"]
    return read_sensor_features(spark, f"{root}/device=phone", "accelerometer", "phone", cols, glob="part-*").unionByName(
        read_sensor_features(spark, f"{root}/device=watch", "accelerometer", "watch", cols, glob="part-*"))


@register("s10_sensor_features", W() + f"""
SELECT "ACTIVITY", "X0", "X1", "class", device_type, 'accelerometer' AS sensor_type,
  'data_' || "class" || '-' || part || '_accel_' || device_type || '.arff' AS source_file,
  {_names_case('"ACTIVITY"')} AS activity_name FROM ({_FEATURES_SQL}) f""")
def q_features(spark, d):
    return _all_features(spark, d)


@register("a20_feature_statistics", W() + f"""
SELECT device_type, 'accelerometer' AS sensor_type, count(*) AS total_samples, count(DISTINCT "class") AS unique_subjects,
  count(DISTINCT "ACTIVITY") AS unique_activities, device_type || '_accelerometer' AS dataset
FROM ({_FEATURES_SQL}) f GROUP BY device_type""")
def q_feature_stats(spark, d):
    return feature_statistics(_all_features(spark, d))


# --- heterogeneous concatenation (U02) ---------------------------------------------
@register("u02_concat_heterogeneous", W() + """
SELECT patient_id, device_type, epoch_s AS timestamp,
  CASE WHEN device_type = 'vital_monitor' THEN heart_rate END AS heart_rate,
  CASE WHEN device_type = 'vital_monitor' THEN spo2 END AS spo2,
  CASE WHEN device_type = 'imu_sensor' THEN x END AS x,
  CASE WHEN device_type = 'imu_sensor' THEN activity_code END AS activity_code
FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor')""")
def q_concat(spark, d):
    v, m, _ = route(fx_events(spark, d))
    return v.select("patient_id", "device_type", "timestamp", "heart_rate", "spo2").unionByName(
        m.select("patient_id", "device_type", "timestamp", "x", "activity_code"), allowMissingColumns=True)


# --- Kafka record layout: envelope, topic routing, lineage (P01, P04, P05, S04) ----
def kafka_layout(spark: SparkSession, d: str) -> DataFrame:
    """Fixture events as the Kafka source yields them: key, JSON value,
    topic per device kind, partition, offset, broker time."""
    ev = device_fields_only(fx_events(spark, d)).filter(F.col("device_type").isin("vital_monitor", "imu_sensor"))
    payload = F.to_json(F.struct(*[F.col(c) for c in _PAYLOAD]))
    topic = F.when(F.col("device_type") == "vital_monitor", "raw_vitals").otherwise("raw_movement")
    return ev.select(F.col("patient_id").cast("binary").alias("key"), payload.cast("binary").alias("value"),
                     topic.alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"), F.timestamp_seconds("timestamp").alias("timestamp"))


@register("p04_to_envelope", W() + """
SELECT event_id AS "offset", CAST(event_id % 4 AS INTEGER) AS "partition", CAST(epoch_s * 1000 AS BIGINT) AS timestamp,
  patient_id AS key, patient_id, CASE WHEN device_type = 'vital_monitor' THEN heart_rate END AS heart_rate,
  CASE WHEN device_type = 'imu_sensor' THEN x END AS x
FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor')""")
def q_envelope(spark, d):
    from pulsegrid.sources.files import parse_landing
    from pulsegrid.streaming.ingest import envelope_lines
    env = envelope_lines(kafka_layout(spark, d))
    sent = F.from_json("value", "offset bigint, partition int, timestamp bigint, key string")
    return parse_landing(env.select("value", sent["timestamp"].alias("sent")), ["sent"]).select(
        "offset", "partition", F.col("sent").alias("timestamp"), "key", "patient_id", "heart_rate", "x")


@register("s04_route_topics", W() + """
SELECT 'raw_vitals' AS topic, count(*) AS n_rows, count(DISTINCT patient_id) AS patients, avg(heart_rate) AS avg_hr,
  CAST(NULL AS DOUBLE) AS max_x
FROM fx_raw WHERE device_type = 'vital_monitor'
UNION ALL
SELECT 'raw_movement', count(*), count(DISTINCT patient_id), NULL, max(x) FROM fx_raw WHERE device_type = 'imu_sensor'""")
def q_topics(spark, d):
    from pulsegrid.schemas import MOVEMENT_SCHEMA, VITALS_SCHEMA
    from pulsegrid.streaming.alerts import route_topics
    t = route_topics(kafka_layout(spark, d), {"raw_vitals": VITALS_SCHEMA, "raw_movement": MOVEMENT_SCHEMA})
    v = t["raw_vitals"].agg(F.lit("raw_vitals").alias("topic"), F.count(F.lit(1)).alias("n_rows"),
                            F.count_distinct("patient_id").alias("patients"), F.avg("heart_rate").alias("avg_hr"),
                            F.lit(None).cast("double").alias("max_x"))
    m = t["raw_movement"].agg(F.lit("raw_movement").alias("topic"), F.count(F.lit(1)).alias("n_rows"),
                              F.count_distinct("patient_id").alias("patients"), F.lit(None).cast("double").alias("avg_hr"),
                              F.max("x").alias("max_x"))
    return v.unionByName(m)


@register("p01_lineage", W() + """
SELECT device_type, 'run-' || device_type AS etl_run_id, strftime(make_timestamp(CAST(epoch_s * 1000000 AS BIGINT)), '%Y-%m-%d')
  AS etl_batch_date, 'events.parquet' AS source_file, count(*) AS n_rows, count(DISTINCT patient_id) AS patients
FROM fx_raw GROUP BY 1, 2, 3""")
def q_lineage(spark, d):
    from pulsegrid.operators.clean import add_lineage
    df = None
    for (device,) in (("vital_monitor",), ("imu_sensor",), ("other",)):
        part = fx_events(spark, d).filter(F.col("device_type") == device)
        part = add_lineage(part, run_id=f"run-{device}", batch_date=event_date(), source_file=F.input_file_name())
        df = part if df is None else df.unionByName(part)
    return df.groupBy("device_type", "etl_run_id", "etl_batch_date", F.element_at(F.split("source_file", "/"), -1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("patient_id").alias("patients"))


# --- rough landing input: nothing is lost -------------------------------------------
_ROUGH = """rough AS (SELECT *, event_id % 50 = 0 AS broken,
    CASE WHEN device_type = 'imu_sensor' OR heart_rate IS NULL OR event_id % 7 = 0 THEN NULL ELSE heart_rate END AS hr,
    CASE WHEN event_id % 31 <> 0 THEN epoch_s END AS ts FROM fx_raw)"""


@register("s01_rough_landing_fields", W(_ROUGH) + """
SELECT event_id AS "offset", patient_id, hr AS heart_rate, ts AS timestamp,
  CASE WHEN device_type <> 'imu_sensor' THEN CAST(event_id % 900 AS DOUBLE) END AS step_count,
  CASE WHEN device_type <> 'imu_sensor' THEN CASE event_id % 2 WHEN 0 THEN 'Active' ELSE 'Sedentary' END END AS activity_level,
  '{"version":"v' || (event_id % 3) || '"}' AS firmware,
  CASE WHEN device_type <> 'imu_sensor' AND heart_rate IS NOT NULL AND event_id % 7 = 0 THEN 'ERROR' END AS bad_reading
FROM rough WHERE NOT broken AND event_id % 2 = 0""")
def q_rough_fields(spark, d):
    df = read_landing(spark, write_landing(spark, d, bad_every=50, rough=True), glob=GLOB)
    return df.filter("offset is not null").select(
        "offset", "patient_id", "heart_rate", "timestamp", "step_count", "activity_level",
        F.col("extra_fields")["firmware"].alias("firmware"), F.col("extra_fields")["heart_rate"].alias("bad_reading"))


@register("s02_etl_rough_landing", W(_ROUGH) + """
SELECT 'bronze' AS part, count(*) AS n_rows, count(hr) AS readings, count(*) AS with_extra FROM rough
  WHERE NOT broken AND device_type = 'vital_monitor'
UNION ALL SELECT 'silver', count(*), count(hr), count(*) FROM rough WHERE NOT broken AND device_type = 'vital_monitor'
  AND hr BETWEEN 30 AND 220 AND spo2 BETWEEN 90 AND 100
UNION ALL SELECT 'malformed', count(*), 0, 0 FROM rough WHERE broken
UNION ALL SELECT 'other device', count(*), 0, 0 FROM rough WHERE NOT broken AND device_type NOT IN ('vital_monitor', 'imu_sensor')
UNION ALL SELECT 'log rejected', count(*), 0, 0 FROM rough WHERE broken""")
def q_etl_rough(spark, d):
    base, _ = etl_base(spark, d, write_landing(spark, d, bad_every=50, rough=True))
    zero = F.lit(0).cast("long")
    out = None
    for layer in ("bronze", "silver"):
        t = read_layer(spark, base, layer, "vitals")
        part = t.agg(F.lit(layer).alias("part"), F.count(F.lit(1)).alias("n_rows"), F.count("heart_rate").alias("readings"),
                     F.count(F.col("extra_fields")["firmware"]).alias("with_extra"))
        out = part if out is None else out.unionByName(part)
    kept = spark.read.parquet(f"{base}/_quarantine").groupBy(F.col("reason").alias("part")).agg(
        F.count("raw_line").alias("n_rows"), zero.alias("readings"), zero.alias("with_extra"))
    log = spark.read.parquet(f"{base}/_run_log").filter("layer = 'landing' and data_type = 'rejected'").select(
        F.lit("log rejected").alias("part"), F.col("record_count").alias("n_rows"), zero.alias("readings"), zero.alias("with_extra"))
    return out.unionByName(kept).unionByName(log)


@register("k02_null_event_time_keeps_rows", W(_ROUGH) + """
SELECT ts IS NULL AS dateless, count(*) AS n_rows FROM rough WHERE NOT broken AND device_type = 'vital_monitor'
  AND hr BETWEEN 30 AND 220 AND spo2 BETWEEN 90 AND 100 GROUP BY 1""")
def q_null_date(spark, d):
    """A row without event time goes to the processing date, and reaches Silver."""
    base, _ = etl_base(spark, d, write_landing(spark, d, bad_every=50, rough=True))
    t = read_layer(spark, base, "silver", "vitals").filter("etl_batch_date is not null")
    return t.groupBy(F.col("event_timestamp").isNull().alias("dateless")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("k02_rerun_that_fails_cleaning", W() + """
SELECT 'bronze' AS layer, count(*) AS n_rows FROM fx_raw WHERE device_type = 'vital_monitor'
UNION ALL SELECT 'silver', 0 UNION ALL SELECT 'gold', 0""")
def q_rerun_fails(spark, d):
    """A back-fill whose readings are all implausible empties Silver and Gold."""
    base = scratch_path(spark, "lake")
    for factor in (1, 1000):
        ev = landing_events(spark, d).withColumn("heart_rate", F.col("heart_rate") * factor + (F.lit(0) if factor == 1 else 500))
        root = scratch_path(spark, "landing")
        ev.select(F.to_json(F.struct(*_PAYLOAD)).alias("value")).write.text(root)
        run_etl(spark, root, base, batch_date=event_date(), bronze_mode="overwrite", glob=GLOB)
    out = None
    for layer in ("bronze", "silver", "gold"):
        part = read_layer(spark, base, layer, "vitals").agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


@register("p10_unkeyed_rows", W() + """
SELECT patient_id, count(*) AS windows FROM (
  SELECT DISTINCT patient_id, time_bucket(INTERVAL 10 MINUTE, event_timestamp) AS w FROM fx_silver_v
  WHERE event_id % 3 <> 0 AND event_id % 5 <> 0) GROUP BY 1""")
def q_unkeyed(spark, d):
    """Rows without patient or event time give no Gold window."""
    from pulsegrid.operators.gold import gold_vitals
    from pulsegrid.plans.layers import silver_v
    e = F.col("event_id")
    df = silver_v(spark, d).withColumns({"patient_id": F.when(e % 3 != 0, F.col("patient_id")),
                                         "event_timestamp": F.when(e % 5 != 0, F.col("event_timestamp"))})
    return gold_vitals(df).groupBy("patient_id").agg(F.count(F.lit(1)).alias("windows"))


@register("k01_append_layer", W() + """
SELECT patient_id, 2 * count(*) AS n_rows FROM fx_silver_v GROUP BY 1""")
def q_append(spark, d):
    """Unpartitioned append, twice; an empty frame in between writes nothing."""
    from pulsegrid.plans.layers import silver_v
    base = scratch_path(spark, "lake")
    df = silver_v(spark, d).select("patient_id", "heart_rate")
    for part in (df, df.limit(0), df):
        write_layer(part, base, "silver", "vitals", partitioned=False)
    return read_layer(spark, base, "silver", "vitals").groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("k05_land_stream", W() + """
SELECT patient_id, count(*) AS n_rows, count(DISTINCT event_id) AS offsets,
  count(CASE WHEN device_type = 'vital_monitor' THEN heart_rate END) AS readings, 0 AS malformed
FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor') AND event_id % 10 <> 0 GROUP BY 1
UNION ALL SELECT NULL, 0, 0, 0, count(*) FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor') AND event_id % 10 = 0""")
def q_land_stream(spark, d):
    """Kafka layout -> landing tree by stream; every tenth message is broken and
    is landed as received, for the reader to report."""
    from pulsegrid import schemas as S
    from pulsegrid.streaming.ingest import land_stream
    src, base, check = (scratch_path(spark, n) for n in ("kafka", "landing_tree", "ckpt"))
    k = kafka_layout(spark, d).withColumn("value", F.when(F.col("offset") % 10 == 0, F.lit(b"not json {")).otherwise(F.col("value")))
    k.write.parquet(src)
    land_stream(spark.readStream.schema(S.KAFKA_SCHEMA).parquet(src), base, "all", check, available_now=True).awaitTermination()
    good, bad = read_landing_partitions(spark, f"{base}/all", quarantine=True)
    zero = F.lit(0).cast("long")
    return good.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("offset").alias("offsets"), F.count("heart_rate").alias("readings"),
        zero.alias("malformed")).unionByName(bad.agg(
            F.lit(None).cast("string").alias("patient_id"), zero.alias("n_rows"), zero.alias("offsets"), zero.alias("readings"),
            F.count("raw_line").alias("malformed")))


@register("st04_k08_incremental_ingest", W() + """
SELECT 'gold' AS part, count(*) AS n, sum(peak_hr) AS total FROM fx_gold_v
UNION ALL SELECT 'bronze', count(*), sum(heart_rate) FROM fx_raw WHERE device_type = 'vital_monitor'
UNION ALL SELECT 'runs', 2, NULL""")
def q_ingest(spark, d):
    """Two halves of the landing files in two runs of the stream equal one batch."""
    from pulsegrid.streaming.ingest import ingest_landing
    landing, base, check, archive = (scratch_path(spark, n) for n in ("landing", "lake", "ckpt", "archive"))
    ev = landing_events(spark, d)
    line = F.to_json(F.struct(*_PAYLOAD)).alias("value")
    for half in (0, 1):
        ev.filter(F.col("event_id") % 2 == half).select(line).write.text(f"{landing}/h{half}")
        ingest_landing(spark, landing, base, check, archive_dir=archive, batch_date=event_date(), glob=GLOB).awaitTermination()
    g = read_layer(spark, base, "gold", "vitals")
    b = read_layer(spark, base, "bronze", "vitals")
    none = F.lit(None).cast("double")
    return (g.agg(F.lit("gold").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("peak_hr").alias("total"))
            .unionByName(b.agg(F.lit("bronze").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("heart_rate").alias("total")))
            .unionByName(b.agg(F.lit("runs").alias("part"), F.count_distinct("etl_run_id").alias("n"), none.alias("total"))))


@register("s09_s10_consolidated_statistics", W("""s_parsed AS (SELECT device_type, sensor_type,
    CAST(TRY_CAST(f[1] AS DOUBLE) AS BIGINT) AS subject_id, trim(f[2]) AS activity_code,
    TRY_CAST(f[4] AS DOUBLE) AS x, TRY_CAST(f[5] AS DOUBLE) AS y, TRY_CAST(f[6] AS DOUBLE) AS z
  FROM (SELECT device_type, sensor_type, string_split(rtrim(line, ';'), ',') AS f FROM fx_sensor WHERE trim(line) <> '')
  WHERE len(f) <= 6)""") + f"""
SELECT device_type || '_' || sensor_type AS dataset, 'raw' AS type, count(*) AS total_readings, NULL AS total_samples,
  count(DISTINCT subject_id) AS unique_subjects, count(DISTINCT activity_code) AS unique_activities,
  CAST(min(subject_id) AS VARCHAR) || ' - ' || CAST(max(subject_id) AS VARCHAR) AS subject_range,
  round(avg(x), 6) AS x_mean, round(avg(y), 6) AS y_mean, round(avg(z), 6) AS z_mean
FROM s_parsed GROUP BY device_type, sensor_type
UNION ALL
SELECT device_type || '_accelerometer', 'processed', NULL, count(*), count(DISTINCT "class"), count(DISTINCT "ACTIVITY"),
  NULL, NULL, NULL, NULL FROM ({_FEATURES_SQL}) f GROUP BY device_type""")
def q_consolidated(spark, d):
    """The consolidation job: all raw and all processed files to combined CSV
    tables, and one statistics table over both."""
    root = scratch_path(spark, "consolidated")
    raw, features = _read_all_sensor(spark, _sensor_files(spark, d)), _all_features(spark, d)
    export_csv(raw, f"{root}/all_raw")
    export_csv(features, f"{root}/all_processed")
    read = lambda name, like: spark.read.option("header", "true").schema(like.schema).csv(f"{root}/{name}")
    return r6(DS.dataset_statistics(read("all_raw", raw), read("all_processed", features)), "x_mean", "y_mean", "z_mean")


@register("k02_compacted_layers", W() + """
SELECT 'silver' AS part, etl_batch_date, count(*) AS n, sum(heart_rate) AS total, 3 AS runs
FROM (SELECT *, strftime(event_timestamp, '%Y-%m-%d') AS etl_batch_date FROM fx_silver_v) s GROUP BY 2
UNION ALL
SELECT 'gold', strftime(window_start, '%Y-%m-%d'), count(*), sum(peak_hr), 0 FROM fx_gold_v GROUP BY 2""")
def q_compacted(spark, d):
    """Two runs, compaction of their dates, a third run of the same dates and
    another compaction: rows, runs and Gold are those of one batch."""
    from pulsegrid.plans.compaction import compact
    base = scratch_path(spark, "lake")
    ev, line = landing_events(spark, d), F.to_json(F.struct(*_PAYLOAD)).alias("value")
    for third in range(3):
        landing = scratch_path(spark, "landing")
        ev.filter(F.col("event_id") % 3 == third).select(line).write.text(landing)
        res = run_etl(spark, landing, base, batch_date=event_date(), glob=GLOB)
        if third:
            compact(spark, base, res.batch_dates, grace_seconds=0)
    s, g = read_layer(spark, base, "silver", "vitals"), read_layer(spark, base, "gold", "vitals")
    return s.groupBy(F.lit("silver").alias("part"), "etl_batch_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("heart_rate").alias("total"), F.count_distinct("etl_run_id").alias("runs")).unionByName(
        g.groupBy(F.lit("gold").alias("part"), "etl_batch_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("peak_hr").alias("total"), F.lit(0).cast("bigint").alias("runs")))


# --- the alert stream, stopped and started again (ST01-ST03, K03) --------------------
class _Stopped(RuntimeError):
    """Stands for the loss of the driver."""


def _stop_once():
    """A sink that is lost with its first micro-batch, after the sinks before it
    have written and before the query commits."""
    calls = []

    def sink(batch: DataFrame) -> None:
        calls.append(1)
        if len(calls) == 1:
            raise _Stopped("driver lost")
    return sink


def _run_stopped(spark: SparkSession, d: str, alerts_of, sinks: dict, outbox: str) -> DataFrame:
    """The alert stream over the Kafka layout in micro-batches of two files:
    stopped in the first one, started again, run to the end. Returns an empty
    frame in the layout of the alerts."""
    from pyspark.errors import StreamingQueryException

    from pulsegrid import schemas as S
    from pulsegrid.streaming.alerts import start_alert_query
    src, check = (scratch_path(spark, n) for n in ("kafka", "ckpt"))
    kafka_layout(spark, d).repartitionByRange(6, "offset").write.parquet(src)
    for _ in range(2):
        stream = alerts_of(spark.readStream.schema(S.KAFKA_SCHEMA).option("maxFilesPerTrigger", 2).parquet(src))
        try:
            start_alert_query(stream, check, sinks, {"availableNow": True}, outbox=outbox).awaitTermination()
        except StreamingQueryException as e:
            if "driver lost" not in str(e):
                raise
    return stream


_ALERT_COLS = ["patient_id", "timestamp", "alert_type", "heart_rate", "spo2_level", "stress_level", "impact_force", "activity_at_time"]


def _exactly_once(spark: SparkSession, d: str, alerts_of) -> DataFrame:
    from pulsegrid.streaming.alerts import published_alerts
    outbox = scratch_path(spark, "outbox")
    stream = _run_stopped(spark, d, alerts_of, {"mirror": lambda b: b.write.format("noop").mode("overwrite").save(), "lost": _stop_once()}, outbox)
    return published_alerts(spark, outbox, stream.schema).select(*_ALERT_COLS)


_VITALS_ALERTS = W() + "SELECT * FROM (" + ALERTS_STANDARD + ") a WHERE alert_type <> 'FALL_DETECTED'"
_FALL_ALERTS = W() + "SELECT * FROM (" + ALERTS_STANDARD + ") a WHERE alert_type = 'FALL_DETECTED'"


@register("st01_vitals_alert_stream", _VITALS_ALERTS)
def q_vitals_stream(spark, d):
    from pulsegrid.streaming.alerts import vitals_alert_stream
    return _exactly_once(spark, d, lambda k: vitals_alert_stream(k, origin=True))


@register("st02_movement_alert_stream", _FALL_ALERTS)
def q_movement_stream(spark, d):
    from pulsegrid.streaming.alerts import movement_alert_stream
    return _exactly_once(spark, d, lambda k: movement_alert_stream(k, origin=True))


@register("st03_combined_alert_stream", W() + ALERTS_STANDARD)
def q_combined_stream(spark, d):
    """One query, two tables as sinks: the second is lost in its first batch, so
    the first must not get that batch again."""
    from pulsegrid.streaming.alerts import alert_stream
    tables = scratch_path(spark, "alert_tables")
    sinks = {"first": lambda b: b.write.mode("append").parquet(f"{tables}/first"), "lost": _stop_once(),
             "second": lambda b: b.write.mode("append").parquet(f"{tables}/second")}
    stream = _run_stopped(spark, d, lambda k: alert_stream(k, origin=True), sinks, scratch_path(spark, "outbox"))
    first, second = (spark.read.schema(stream.schema).parquet(f"{tables}/{t}") for t in ("first", "second"))
    return first.select(*_ALERT_COLS).intersectAll(second.select(*_ALERT_COLS))


@register("k03_published_alerts", W() + "SELECT patient_id AS key, * FROM (" + ALERTS_STANDARD + ") a")
def q_published(spark, d):
    """Alerts in the topic's layout: the sink writes a batch and is lost before
    its mark, so the batch is published twice; consumers, by stream, keep each
    alert once."""
    from pulsegrid.streaming.alerts import alert_stream, kafka_records, received_alerts
    topic, out, check = (scratch_path(spark, n) for n in ("topic", "received", "ckpt"))
    lost = _stop_once()

    def publish(batch: DataFrame) -> None:
        kafka_records(batch).withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(topic)
        lost(batch)

    _run_stopped(spark, d, lambda k: alert_stream(k, origin=True), {"topic": publish}, scratch_path(spark, "outbox"))
    sent = spark.readStream.schema("key string, value string, headers array<struct<key string, value binary>>, timestamp timestamp")
    received = received_alerts(sent.parquet(topic))
    (received.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.schema(received.schema).parquet(out).select(F.col("patient_id").alias("key"), *_ALERT_COLS)


# --- the landing buffer: flush rule and counters (K06, K09) -----------------------------
FLUSH_RECORDS = 500


def _landed_by_buffer(spark: SparkSession, d: str) -> str:
    """The Kafka layout, every tenth message broken, landed by the flush rule in
    micro-batches of one file; the first flush of each topic fails once."""
    from pulsegrid import schemas as S
    from pulsegrid.streaming.landing import LandingBuffer, land_buffered
    src, root, base, check = (scratch_path(spark, n) for n in ("kafka", "buffer", "landing_tree", "ckpt"))
    k = kafka_layout(spark, d).withColumn("value", F.when(F.col("offset") % 10 == 0, F.lit(b"not json {")).otherwise(F.col("value")))
    k.repartitionByRange(6, "offset").write.parquet(src)
    buffer, write, failed = LandingBuffer(spark, root, base, FLUSH_RECORDS, interval=3600), LandingBuffer.write_files, set()

    def fails_once(topic: str, *rest) -> None:
        if topic not in failed:
            failed.add(topic)
            raise OSError("no space left")
        write(buffer, topic, *rest)

    buffer.write_files = fails_once
    stream = spark.readStream.schema(S.KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    land_buffered(stream, buffer, check, available_now=True).awaitTermination()
    for _ in range(2):  # a small topic's only flush may be the one that fails
        buffer.flush_due(everything=True)
    return base


_TOPIC_SQL = "CASE WHEN device_type = 'vital_monitor' THEN 'raw_vitals' ELSE 'raw_movement' END"


@register("k06_flush_rule", W() + f"""
SELECT {_TOPIC_SQL} AS topic, count(*) AS landed, count(DISTINCT CASE WHEN event_id % 10 <> 0 THEN event_id END) AS offsets,
  true AS bounded FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor') GROUP BY 1""")
def q_flush_rule(spark, d):
    from pulsegrid.sources.files import parse_landing
    base = _landed_by_buffer(spark, d)
    out = None
    for topic in ("raw_vitals", "raw_movement"):
        lines = (spark.read.option("recursiveFileLookup", "true").text(f"{base}/{topic}")
                 .select("value", F.col("_metadata.file_path").alias("file")))
        files = parse_landing(lines, ["file"]).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count("offset").alias("good"))
        # offsets are distinct over the files: counted again as a set
        offsets = parse_landing(lines, ["file"]).agg(F.count_distinct("offset")).first()[0]
        part = files.agg(F.lit(topic).alias("topic"), F.sum("n").alias("landed"), F.lit(offsets).cast("bigint").alias("offsets"),
                         ((F.max("n") <= FLUSH_RECORDS) & (F.sum("good") == offsets)).alias("bounded"))
        out = part if out is None else out.unionByName(part)
    return out


@register("k09_stream_counters", W() + f"""
SELECT {_TOPIC_SQL} AS topic, count(*) AS consumed, count(CASE WHEN event_id % 10 = 0 THEN 1 END) AS broken, count(*) AS landed,
  1 AS failed_flushes FROM fx_raw WHERE device_type IN ('vital_monitor', 'imu_sensor') GROUP BY 1""")
def q_stream_counters(spark, d):
    from pulsegrid.streaming.landing import stream_counters
    return stream_counters(spark, _landed_by_buffer(spark, d))


# --- Gold as a stream (W01, A01, A06) ----------------------------------------------------
def _streamed_gold(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Fixture events in files by event time; every 37th event comes in the next
    file but one, every 41st one twice, the second time in the last file."""
    from pulsegrid.operators.clean import clean_movement, clean_vitals
    from pulsegrid.streaming.gold import served_windows, state_schema
    e = F.col("event_id")
    clean = clean_vitals if kind == "vitals" else clean_movement
    src, base = scratch_path(spark, "events"), scratch_path(spark, "gold_stream")
    ev = fx_events(spark, d)
    step = F.greatest(F.floor((ev.agg(F.max("event_id")).scalar() + 1) / 3), F.lit(1))  # three files of event time
    place = F.least(F.floor(e / step), F.lit(2)) + F.when(e % 37 == 0, 2).otherwise(0)
    sent = ev.withColumn("place", place).unionAll(ev.where(e % 41 == 0).withColumn("place", F.lit(4).cast("bigint")))
    for i in range(5):  # one after the other: a file source reads by age
        sent.where(F.col("place") == i).drop("place").coalesce(1).write.parquet(f"{src}/f{i}")
    # the number of state stores of a query is that of the shuffle partitions when it first starts
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(partitions), max(4, spark.sparkContext.defaultParallelism))))
    try:
        _run_both(spark, kind, ev, src, base, clean)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    silver = clean(route(ev.limit(0))[0 if kind == "vitals" else 1])
    return wall(served_windows(spark, kind, base, state_schema(silver, kind)), "window_start", "window_end")


def _run_both(spark: SparkSession, kind: str, ev: DataFrame, src: str, base: str, clean) -> None:
    from pulsegrid.streaming.gold import late_stream, window_stream
    for start in (late_stream, window_stream):
        stream = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
                  .option("pathGlobFilter", "*.parquet").parquet(src))
        silver = clean(route(stream)[0 if kind == "vitals" else 1])
        start(silver, kind, base, scratch_path(spark, "ckpt"), ["event_id"], trigger={"availableNow": True}).awaitTermination()


@register("w01_stream_gold_vitals", W() + """
SELECT patient_id, window_start, window_end, round(avg_hr, 6) AS avg_hr, peak_hr, round(avg_spo2, 6) AS avg_spo2, peak_spo2,
  mews_hr_score, mews_spo2_score, mews_score FROM fx_gold_v""")
def q_stream_vitals(spark, d):
    return r6(_streamed_gold(spark, d, "vitals"), "avg_hr", "avg_spo2")


@register("a06_stream_gold_movement", W() + """
SELECT patient_id, window_start, window_end, round(avg_activity, 6) AS avg_activity, round(peak_impact, 6) AS peak_impact,
  fall_events_detected FROM fx_gold_m""")
def q_stream_movement(spark, d):
    return r6(_streamed_gold(spark, d, "movement"), "avg_activity", "peak_impact")
