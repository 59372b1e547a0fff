"""Replays of the alert stream and of the buffered landing stream."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.plans.catalog_storage import kafka_layout
from pulsegrid.session import local_path, scratch_path
from pulsegrid.streaming.alerts import AlertOutbox, alert_stream, kafka_records, published_alerts, received_alerts, start_alert_query

SF = "/root/testdata/sf0.001"


def source(spark, files=4):
    src = scratch_path(spark, "kafka")
    k = kafka_layout(spark, SF)
    # some readings without a time of their own: stamped when processed
    value = F.when(F.col("offset") % 3 == 0, F.regexp_replace(F.col("value").cast("string"), '"timestamp":[0-9.E]+,', "")).otherwise(F.col("value").cast("string"))
    k.withColumn("value", value.cast("binary")).repartitionByRange(files, "offset").write.parquet(src)
    return src, k


def run(spark, src, check, sinks, outbox, **kw):
    stream = alert_stream(spark.readStream.schema(S.KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), origin=True)
    start_alert_query(stream, check, sinks, {"availableNow": True}, outbox=outbox, **kw).awaitTermination()
    return stream.schema


def uncommit(check):
    """Take back the newest commit, as if the query had stopped before it."""
    commits = os.path.join(local_path(check), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    return int(last)


def test_a_replayed_batch_reaches_no_sink_again_and_keeps_its_times(spark):
    src, k = source(spark)
    check, outbox = scratch_path(spark, "ckpt"), scratch_path(spark, "outbox")
    got = {"a": [], "b": []}
    sinks = {n: (lambda b, n=n: got[n].append(b.collect())) for n in got}
    schema = run(spark, src, check, sinks, outbox)
    before = sorted(map(tuple, published_alerts(spark, outbox, schema).collect()), key=str)
    assert uncommit(check) == 3
    run(spark, src, check, sinks, outbox)
    after = sorted(map(tuple, published_alerts(spark, outbox, schema).collect()), key=str)
    assert after == before and len(before) > 0
    for batches in got.values():
        assert len(batches) == 4 and sorted((tuple(r) for b in batches for r in b), key=str) == before
    ids = [r.alert_id for r in published_alerts(spark, outbox, schema).collect()]
    assert len(set(ids)) == len(ids)


def test_a_sink_lost_half_way_is_fed_again_alone(spark):
    src, _ = source(spark)
    check, outbox, calls = scratch_path(spark, "ckpt"), scratch_path(spark, "outbox"), {"first": 0, "second": 0}

    def first(batch):
        calls["first"] += 1

    def second(batch):
        calls["second"] += 1
        if calls["second"] == 2:
            raise RuntimeError("broker lost")

    with pytest.raises(StreamingQueryException):
        run(spark, src, check, {"first": first, "second": second}, outbox)
    run(spark, src, check, {"first": first, "second": second}, outbox)
    assert calls == {"first": 4, "second": 5}


def test_a_batch_half_written_is_not_read_and_is_written_again(spark):
    src, _ = source(spark)
    check, outbox = scratch_path(spark, "ckpt"), scratch_path(spark, "outbox")
    schema = run(spark, src, check, {}, outbox)
    box = AlertOutbox(spark, outbox)
    n = published_alerts(spark, outbox, schema).count()
    newest = max(box.batches())
    os.remove(os.path.join(local_path(newest), "_ready"))
    assert len(box.batches()) == 3 and published_alerts(spark, outbox, schema).count() < n
    uncommit(check)
    run(spark, src, check, {}, outbox)
    assert published_alerts(spark, outbox, schema).count() == n


def test_old_batches_are_removed_on_request(spark):
    src, _ = source(spark)
    outbox = scratch_path(spark, "outbox")
    run(spark, src, scratch_path(spark, "ckpt"), {}, outbox, keep_batches=2)
    assert sorted(f[-1] for f in AlertOutbox(spark, outbox).batches()) == ["2", "3"]
    assert published_alerts(spark, scratch_path(spark, "none"), "a int").count() == 0


def test_consumers_drop_alerts_they_have_seen(spark):
    _, k = source(spark, 1)
    sent = kafka_records(alert_stream(k, origin=True)).withColumn("timestamp", F.current_timestamp())
    twice = sent.unionAll(sent)
    got = received_alerts(twice)
    assert got.count() == sent.count() > 0 and got.columns[0] == "alert_id"
    assert "headers" not in kafka_records(alert_stream(k)).columns  # as before without an id


# --- buffered landing ------------------------------------------------------------

class Clock:
    def __init__(self):
        self.now = 1_700_000_000.0

    def __call__(self):
        return self.now


def records(spark, first, n, topic="raw_vitals"):
    return spark.range(first, first + n, 1, 3).select(
        F.lit(b"1600").alias("key"), F.format_string('{"patient_id": "1600", "n": %d}', "id").cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"))


def buffer_of(spark, **kw):
    from pulsegrid.streaming.landing import LandingBuffer
    return LandingBuffer(spark, scratch_path(spark, "buffer"), scratch_path(spark, "tree"), clock=Clock(), **kw)


def landed(b):
    """(topic, file, offset) of every landed line."""
    import json
    out = []
    for folder, _, files in os.walk(local_path(b.base)):
        for f in files:
            if f.endswith(".json") and "_stream_log" not in folder:
                with open(os.path.join(folder, f)) as lines:
                    out += [(folder.split(os.sep + "year=")[0].split(os.sep)[-1], f, json.loads(x)["offset"]) for x in lines]
    return out


def test_flush_by_number_and_by_age(spark):
    b = buffer_of(spark, max_records=100, interval=60)
    b.store(records(spark, 0, 70), 0)
    assert b.flush_due() == {}
    b.clock.now += 59
    assert b.flush_due() == {}
    b.clock.now += 1  # the oldest record has waited for the interval
    assert b.flush_due() == {"raw_vitals": 70}
    b.store(records(spark, 70, 60), 1)
    assert b.flush_due() == {}
    b.store(records(spark, 130, 190).unionAll(records(spark, 0, 5, "raw_movement")), 2)
    assert b.flush_due() == {"raw_vitals": 250}  # enough records, at once; the other topic waits
    per_file = {}
    for _, f, _ in landed(b):
        per_file[f] = per_file.get(f, 0) + 1
    assert max(per_file.values()) <= 100 and sorted(o for _, _, o in landed(b)) == list(range(320))
    assert b.waiting() == {"raw_movement": [(2, 5, b.clock.now)]}
    assert b.flush_due(everything=True) == {"raw_movement": 5} and b.flush_due(everything=True) == {}


def test_a_failed_flush_keeps_its_records_and_is_counted(spark):
    from pulsegrid.streaming.landing import LandingBuffer, stream_counters
    b = buffer_of(spark, max_records=10, max_failures=3)
    b.store(records(spark, 0, 30), 0)
    b.write_files = lambda *a: (_ for _ in ()).throw(OSError("no space left"))
    assert b.flush_due() == {} and b.flush_due() == {}
    with pytest.raises(OSError):
        b.flush_due()
    b.write_files = lambda *a: LandingBuffer.write_files(b, *a)
    b.store(records(spark, 30, 5), 1)
    b.flush_due()
    b.flush_due(everything=True)
    assert sorted(o for _, _, o in landed(b)) == list(range(35))
    assert [tuple(r) for r in stream_counters(spark, b.base).collect()] == [("raw_vitals", 35, 0, 35, 3)]


@pytest.mark.parametrize("step", ["intent", "files", "moved", "landed"])
def test_a_stop_inside_a_flush_lands_each_record_once(spark, monkeypatch, step):
    import pulsegrid.streaming.landing as L
    b = buffer_of(spark, max_records=10)
    b.store(records(spark, 0, 25), 0)
    calls = []

    def after(real, n):
        def f(*a):
            out = real(*a)
            calls.append(a)
            if len(calls) == n:
                raise KeyboardInterrupt  # not an error of the flush: the driver is gone
            return out
        return f

    name, n = {"intent": ("write_small", 1), "files": ("touch_path", 1), "moved": ("move_file", 2), "landed": ("write_small", 3)}[step]
    monkeypatch.setattr(L, name, after(getattr(L, name), n))
    with pytest.raises(KeyboardInterrupt):
        b.flush_due()
    monkeypatch.undo()
    again = L.LandingBuffer(spark, b.root, b.base, max_records=10, clock=b.clock)
    again.store(records(spark, 0, 25), 0)  # the micro-batch is handed in again
    again.store(records(spark, 25, 3), 1)
    again.flush_due(everything=True)
    assert sorted(o for _, _, o in landed(again)) == list(range(28))
    assert [tuple(r) for r in L.stream_counters(spark, b.base).collect()] == [("raw_vitals", 28, 0, 28, 0)]


def test_landed_micro_batches_leave_the_buffer(spark):
    b = buffer_of(spark, max_records=1)
    for i in range(3):
        b.store(records(spark, i * 5, 5), i)
        b.flush_due()
    assert os.listdir(os.path.join(local_path(b.root), "rows")) == ["batch=000000002"]
    b.store(records(spark, 999, 5), 2)  # a replay of the newest one stores nothing
    assert b.waiting() == {}


def test_empty_micro_batch_and_no_log(spark):
    from pulsegrid.streaming.landing import stream_counters
    b = buffer_of(spark)
    assert stream_counters(spark, b.base).count() == 0
    b.store(records(spark, 0, 0), 0)
    assert b.flush_due(everything=True) == {} and landed(b) == []
