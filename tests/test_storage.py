"""Layer storage edge cases."""

import json
import os

import pytest

from pulsegrid.session import local_path, scratch_path
from pulsegrid.sinks.files import write_layer, write_layer_metrics
from pulsegrid.sources.files import (
    available_dates, read_landing, read_layer, read_smartwatch_csv, unreadable_files,
)


def _junk(base, layer, entity, date, name):
    folder = os.path.join(local_path(base), layer, entity, f"etl_batch_date={date}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("not parquet")


def test_missing_layer_is_empty(spark):
    base = scratch_path(spark, "lake")
    assert read_layer(spark, base, "gold", "vitals").count() == 0
    assert available_dates(spark, base, "gold", "vitals").count() == 0
    os.makedirs(os.path.join(local_path(base), "gold", "vitals"))  # a folder without files
    assert read_layer(spark, base, "gold", "vitals").columns == []
    assert available_dates(spark, base, "gold", "vitals").count() == 0


@pytest.mark.parametrize("name", ["a_first.parquet", "z_last.parquet"])
@pytest.mark.parametrize("date", ["2024-01-01", "2024-01-02", "2024-01-03"])
def test_unreadable_file_fails_the_read_and_is_skipped_only_on_request(spark, name, date):
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", 1.0, "2024-01-01"), ("1601", 2.0, "2024-01-02")],
                               "patient_id string, avg_hr double, etl_batch_date string")
    assert write_layer(df, base, "gold", "vitals") == 2
    _junk(base, "gold", "vitals", date, name)
    with pytest.raises(Exception, match="(?i)parquet"):
        read_layer(spark, base, "gold", "vitals", schema=df.schema).collect()
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read_layer(spark, base, "gold", "vitals").collect()
    got = read_layer(spark, base, "gold", "vitals", skip_unreadable=True)
    assert sorted(r.patient_id for r in got.collect()) == ["1600", "1601"]
    assert [r.path.endswith(name) for r in unreadable_files(spark, base, "gold", "vitals").collect()] == [True]


def _spoil(path, text):
    """Replace a file and drop its local checksum, as a foreign writer would."""
    folder, name = os.path.split(path)
    crc = os.path.join(folder, f".{name}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(path, "wb") as f:
        f.write(text)


@pytest.mark.parametrize("date", ["2024-01-01", "a b%c:d"])
def test_manifest_tells_broken_from_empty_and_opens_no_sound_file(spark, date):
    from pulsegrid.plans.compaction import compact
    from pulsegrid.plans.etl import run_etl
    from pulsegrid.sources.files import suspect_files
    base = scratch_path(spark, "lake")
    for run in ("r1", "r2", "r3"):
        run_etl(spark, land(spark, VITAL, VITAL | {"heart_rate": 100}, MOVE), base, run_id=run, batch_date=date)
        if run == "r2":
            compact(spark, base, [date], grace_seconds=0)
    tables = [(la, e) for la in ("bronze", "silver", "gold") for e in ("vitals", "movement")]
    for la, e in tables:
        assert suspect_files(spark, base, la, e).count() == 0 and unreadable_files(spark, base, la, e).count() == 0
    files = [os.path.join(p, n) for p, _, names in os.walk(local_path(base)) for n in names
             if n.endswith(".parquet") and "/bronze/" in p and "vitals" in p]
    merged = [f for f in files if "_compacted" in f]
    own = [f for f in files if "etl_run_id=r3" in f]
    assert merged and own
    folder = os.path.dirname(own[0])
    with open(own[0], "rb") as f:
        sound = f.read()
    _spoil(merged[0], b"PAR1")
    _spoil(own[0], sound[:len(sound) // 2])
    _spoil(os.path.join(folder, "part-foreign.parquet"), sound)
    spark.createDataFrame([], "x int").coalesce(1).write.parquet(f"{base}/none")
    none = next(n for n in os.listdir(local_path(f"{base}/none")) if n.endswith(".parquet"))
    with open(os.path.join(local_path(f"{base}/none"), none), "rb") as f:
        _spoil(os.path.join(folder, "part-empty.parquet"), f.read())
    got = {os.path.basename(r.path): r.recorded_rows for r in unreadable_files(spark, base, "bronze", "vitals").collect()}
    assert got == {os.path.basename(merged[0]): 4, os.path.basename(own[0]): 2}
    assert suspect_files(spark, base, "bronze", "vitals").count() == 4
    assert unreadable_files(spark, base, "silver", "vitals").count() == 0
    assert unreadable_files(spark, base, "silver", "nothing").count() == 0


def test_rewriting_a_batch_replaces_only_its_partition(spark):
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", 1.0, "2024-01-01"), ("1601", 2.0, "2024-01-02")],
                               "patient_id string, avg_hr double, etl_batch_date string")
    write_layer(df, base, "gold", "vitals")
    assert [r[0] for r in available_dates(spark, base, "gold", "vitals").collect()] == ["2024-01-02", "2024-01-01"]
    write_layer(spark.createDataFrame([("1609", 3.0, "2024-01-02")], df.schema), base, "gold", "vitals")
    assert sorted(r.patient_id for r in read_layer(spark, base, "gold", "vitals").collect()) == ["1600", "1609"]


def test_partition_values_stay_text(spark):
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", "2024-01-01", "00012345"), ("1601", "2024-01-01", "1e5")],
                               "patient_id string, etl_batch_date string, etl_run_id string")
    write_layer_metrics(df, base, "bronze", "vitals", by=("etl_batch_date", "etl_run_id"))
    assert {r.etl_run_id for r in read_layer(spark, base, "bronze", "vitals").collect()} == {"00012345", "1e5"}


def test_empty_frame_writes_nothing(spark):
    base = scratch_path(spark, "lake")
    empty = spark.createDataFrame([], "patient_id string, etl_batch_date string")
    assert write_layer(empty, base, "silver", "vitals") == 0
    assert read_layer(spark, base, "silver", "vitals").count() == 0


def test_csv_missing_value_texts(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "d.csv"), "w") as f:
        f.write("User ID,Heart Rate (BPM),Blood Oxygen Level (%),Step Count,Sleep Duration (hours),Activity Level,Stress Level\n")
        f.write("1001,80,97,100,7,nan,NA\n1002,,98,200,ERROR,  Active ,5\n")
    rows = read_smartwatch_csv(spark, path).collect()
    assert rows[0]["Activity Level"] is None and rows[0]["Stress Level"] is None
    assert rows[1]["Heart Rate (BPM)"] is None and rows[1]["Activity Level"] == "  Active "


def test_write_metrics_observe_the_written_rows(spark):
    from pyspark.sql import functions as F
    from pulsegrid.sinks.files import write_layer_metrics
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", "2024-01-02"), ("1601", "2024-01-01"), ("1602", "2024-01-02")],
                               "patient_id string, etl_batch_date string")
    got = write_layer_metrics(df, base, "bronze", "vitals", extra={"dates": F.array_sort(F.collect_set("etl_batch_date"))})
    assert got == {"rows": 3, "dates": ["2024-01-01", "2024-01-02"]}
    empty = df.filter("patient_id IS NULL")
    got = write_layer_metrics(empty, base, "bronze", "movement", extra={"dates": F.collect_set("etl_batch_date")})
    assert got == {"rows": 0, "dates": []}
    assert read_layer(spark, base, "bronze", "movement").count() == 0  # no files were written


def test_gold_skipped_when_no_silver_row_has_event_time(spark):
    """Silver keeps rows without event time; Gold drops them, so its write is
    skipped by probing Gold's input instead of running the aggregate twice."""
    from pulsegrid.plans.etl import EtlResult, run_layers
    base = scratch_path(spark, "lake")
    bronze = spark.createDataFrame(
        [("1600", "vital_monitor", None, 80.0, 97.0, "2024-01-01"),
         ("1601", "vital_monitor", 1704067200.0, 85.0, 96.0, "2024-01-01")],
        "patient_id string, device_type string, timestamp double, heart_rate double, spo2 double, etl_batch_date string")
    res = run_layers(spark, bronze.filter("timestamp IS NULL"), base, EtlResult("r1"), run_log=False)
    assert res.batch_dates == ["2024-01-01"]
    assert res.counts[("silver", "vitals")] == 1 and res.counts[("gold", "vitals")] == 0
    assert ("silver", "movement") in res.skipped
    assert read_layer(spark, base, "gold", "vitals").count() == 0
    res = run_layers(spark, bronze, base, EtlResult("r2"), run_log=False)
    assert res.counts[("gold", "vitals")] == 1


def test_has_at_least(spark):
    from pulsegrid.plans import etl
    df = spark.range(50).repartition(5)
    assert etl.has_at_least(df, 0) and etl.has_at_least(df, 50) and not etl.has_at_least(df, 51)


def test_too_few_landing_records_write_no_layer(spark):
    """ST05 on the raw records of a batch run: below the threshold nothing is
    written (the landing files stay for a later run)."""
    from pulsegrid.plans.etl import run_etl
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    os.makedirs(local_path(landing))
    with open(os.path.join(local_path(landing), "a.jsonl"), "w") as f:
        f.write('{"patient_id": "1600", "device_type": "vital_monitor", "timestamp": 1704067200.0, '
                '"heart_rate": 80, "spo2": 97}\n')
    res = run_etl(spark, landing, base, batch_date="2024-01-01", min_records=2, run_log=False)
    assert res.skipped == [("bronze", "all")]
    assert res.counts == {("landing", "consumed"): 1, ("landing", "rejected"): 0, ("landing", "other_device"): 0}
    assert read_layer(spark, base, "bronze", "vitals").count() == 0
    res = run_etl(spark, landing, base, batch_date="2024-01-01", min_records=1, run_log=False)
    assert res.counts[("bronze", "vitals")] == 1 and res.counts[("gold", "vitals")] == 1


def test_cluster_session_without_checkpoint_dir_is_refused():
    """Outside local mode no machine-local scratch folder is made up."""
    import pytest

    from pulsegrid.session import shared_dir

    class _Unset:
        def isDefined(self):
            return False

    class _Ctx:
        master = "yarn"

        class _jsc:
            @staticmethod
            def sc():
                class _S:
                    def getCheckpointDir(self):
                        return _Unset()
                return _S()

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session())


VITAL = {"patient_id": "1600", "device_type": "vital_monitor", "timestamp": 1704067200.0, "heart_rate": 80, "spo2": 97}
MOVE = {"patient_id": "1600", "device_type": "imu_sensor", "timestamp": 1704067200.0, "x": 1.0, "y": 2.0, "z": 2.0}


def land(spark, *lines):
    path = scratch_path(spark, "landing")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "a.jsonl"), "w") as f:
        f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
    return path


def test_landing_coerces_each_field_and_keeps_the_rest(spark):
    rows = [VITAL | {"heart_rate": "81"}, VITAL | {"stress_level": "Very High", "firmware": {"v": 2}},
            {"offset": 5, "partition": 1, "timestamp": 9, "key": "k", "value": VITAL | {"spo2": "ERROR", "tag": "x"}}]
    good, bad = read_landing(spark, land(spark, *rows, '{"patient_id": "1', "[1, 2]", '{"offset": 1, "value": "broken"}', "  "), True)
    a, b, c = good.orderBy("offset", "heart_rate", ascending=[True, False]).collect()
    assert (a.heart_rate, a.extra_fields) == (81.0, None)
    assert (b.heart_rate, b.stress_level, b.extra_fields) == (80.0, None, {"stress_level": "Very High", "firmware": '{"v":2}'})
    assert (c.offset, c.key, c.timestamp, c.spo2, c.extra_fields) == (5, "k", 1704067200.0, None, {"spo2": "ERROR", "tag": "x"})
    assert sorted(r.raw_line for r in bad.collect()) == ["[1, 2]", '{"offset": 1, "value": "broken"}', '{"patient_id": "1']


def test_landed_message_is_the_one_received(spark):
    from pulsegrid import schemas as S
    from pulsegrid.streaming.ingest import envelope_lines
    messages = ['{"heart_rate": "ERROR", "extra": [1, {"a": null}], "x": 1.50}', '{"a":\n 1}', "not json", "", None, '"text"']
    df = spark.createDataFrame([(b"k", m.encode() if m is not None else None, "t", 0, i, None) for i, m in enumerate(messages)],
                               S.KAFKA_SCHEMA)
    got = {json.loads(r.value)["offset"]: r.value for r in envelope_lines(df).collect()}
    assert messages[0] in got[0]
    assert json.loads(got[1])["value"] == {"a": 1} and "\n" not in got[1]
    assert [json.loads(got[i])["value"] for i in (2, 3, 4, 5)] == ["not json", "", "", '"text"']


def test_rows_no_layer_takes_are_quarantined_and_counted(spark):
    from pulsegrid.plans.etl import run_etl
    base = scratch_path(spark, "lake")
    res = run_etl(spark, land(spark, VITAL, VITAL | {"device_type": "scale", "kg": 70}, '{"cut'), base, batch_date="2024-01-01")
    assert [res.counts[("landing", k)] for k in ("consumed", "rejected", "other_device")] == [3, 1, 1]
    q = {r.reason: r.raw_line for r in spark.read.parquet(f"{base}/_quarantine").collect()}
    assert q["malformed"] == '{"cut' and json.loads(q["other device"])["extra_fields"] == {"kg": "70"}


def test_landing_without_a_known_device_writes_no_layer(spark):
    from pulsegrid.plans.etl import run_etl
    base = scratch_path(spark, "lake")
    res = run_etl(spark, land(spark, VITAL | {"device_type": "scale"}), base, batch_date="2024-01-01")
    assert res.skipped == [("bronze", "all")] and not os.path.exists(os.path.join(local_path(base), "bronze"))


def test_rerun_without_valid_rows_empties_silver_and_gold(spark):
    from pulsegrid.plans.etl import run_etl
    for least in (0, 1, 2):
        base = scratch_path(spark, "lake")
        kw = dict(batch_date="2024-01-01", bronze_mode="overwrite")
        run_etl(spark, land(spark, VITAL, MOVE), base, **kw)
        assert read_layer(spark, base, "gold", "vitals").count() == read_layer(spark, base, "gold", "movement").count() == 1
        run_etl(spark, land(spark, VITAL | {"heart_rate": 999}, VITAL | {"heart_rate": 998}), base, min_records=least, **kw)
        assert sorted(r.heart_rate for r in read_layer(spark, base, "bronze", "vitals").collect()) == [998.0, 999.0]
        for layer in ("silver", "gold"):
            for entity in ("vitals", "movement"):
                assert read_layer(spark, base, layer, entity).count() == 0
                assert available_dates(spark, base, layer, entity).count() == 0


def test_second_run_of_a_date_reads_only_its_own_rows(spark):
    """The earlier run's Bronze and Silver files may be gone: Gold still merges."""
    import shutil

    from pulsegrid.plans.etl import run_etl
    base = scratch_path(spark, "lake")
    run_etl(spark, land(spark, VITAL), base, run_id="r1", batch_date="2024-01-01")
    for layer in ("bronze", "silver"):
        part = os.path.join(local_path(base), layer, "vitals", "etl_batch_date=2024-01-01", "etl_run_id=r1")
        for f in os.listdir(part):
            if f.endswith(".parquet"):
                with open(os.path.join(part, f), "w") as out:
                    out.write("unreadable: never opened again")
    run_etl(spark, land(spark, VITAL | {"heart_rate": 100}), base, run_id="r2", batch_date="2024-01-01")
    g = read_layer(spark, base, "gold", "vitals").collect()
    assert [(r.avg_hr, r.peak_hr) for r in g] == [(90.0, 100.0)]
    shutil.rmtree(local_path(base))


def test_rows_held_back_by_the_threshold_join_a_later_run(spark):
    from pulsegrid.plans.etl import run_etl, run_staged, EtlResult, stage_landing
    from pulsegrid.sources.files import landing_lines
    base = scratch_path(spark, "lake")

    def run(run_id, path):
        s = stage_landing(landing_lines(spark, path), run_id, "2024-01-01")
        return run_staged(s, base, EtlResult(run_id), min_records=2, batch_date="2024-01-01", defer=False)
    assert ("silver", "vitals") in run("r1", land(spark, VITAL)).skipped
    assert read_layer(spark, base, "silver", "vitals").count() == 0
    run("r2", land(spark, VITAL | {"heart_rate": 100}))
    assert sorted(r.heart_rate for r in read_layer(spark, base, "silver", "vitals").collect()) == [80.0, 100.0]
    assert read_layer(spark, base, "gold", "vitals").first().avg_hr == 90.0
    assert callable(run_etl)


def test_taking_a_run_back_deletes_only_its_partitions(spark):
    from pulsegrid.plans.etl import drop_run, run_etl
    base = scratch_path(spark, "lake")
    for run_id in ("r1", "r2"):
        run_etl(spark, land(spark, VITAL), base, run_id=run_id, batch_date="2024-01-01")
    _junk(base, "bronze", "vitals", "2024-01-01/etl_run_id=r1", "broken.parquet")
    assert drop_run(spark, base, "r2", ["2024-01-01", "2024-01-09"]) == ["2024-01-01"]
    left = os.listdir(os.path.join(local_path(base), "bronze", "vitals", "etl_batch_date=2024-01-01"))
    assert [f for f in left if f.startswith("etl_run")] == ["etl_run_id=r1"]
    assert "broken.parquet" in os.listdir(os.path.join(
        local_path(base), "bronze", "vitals", "etl_batch_date=2024-01-01", "etl_run_id=r1"))
    assert drop_run(spark, base, "r2", ["2024-01-01"]) == []  # a lake without movement, and nothing left


def test_run_ids_and_dates_with_odd_characters(spark):
    """Partition folders escape them; taking back and replacing still find them."""
    from pulsegrid.plans.etl import drop_run, run_etl
    from pulsegrid.sources.files import run_folders
    base = scratch_path(spark, "lake")
    run_id, date = "nightly: 50%/a=b", "2024-01-01 [x]"
    for _ in range(2):
        run_etl(spark, land(spark, VITAL), base, run_id=run_id, batch_date=date)
    assert read_layer(spark, base, "silver", "vitals").count() == 1  # the same run again replaces itself
    assert run_folders(spark, f"{base}/bronze/vitals", [date, "other"]) == {date: {run_id}, "other": set()}
    assert [r[0] for r in available_dates(spark, base, "gold", "vitals").collect()] == [date]
    assert drop_run(spark, base, run_id, [date]) == [date]
    assert read_layer(spark, base, "bronze", "vitals").count() == 0
