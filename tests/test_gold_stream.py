"""Gold windows as a stream: late, repeated and replayed events."""

import datetime as dt
import os
import random


from pulsegrid.operators.gold import gold_movement, gold_vitals
from pulsegrid.session import local_path, scratch_path
from pulsegrid.streaming.gold import late_stream, served_windows, state_schema, window_stream

SCHEMA = "event_id long, patient_id string, event_timestamp timestamp, heart_rate double, spo2 double, svm double"
START = dt.datetime(2024, 1, 1, 23, 0)


def events(rng, n):
    """(file, row): in order over three hours, some far behind, some twice."""
    out = []
    for i in range(n):
        row = (i, f"{rng.randrange(3)}" if i % 29 else None, START + dt.timedelta(seconds=180 * 60 * i / n) if i % 31 else None,
               rng.uniform(40, 180), rng.uniform(88, 100), rng.uniform(0, 40))
        place = min(3 * i // n, 2)
        out.append((min(place + (2 if i % 7 == 0 else 0), 4), row))
        if i % 5 == 0:
            out.append((4, row))
    return out


def run(spark, rows, kind, checks=None, base=None):
    src, base = scratch_path(spark, "events"), base or scratch_path(spark, "gold_stream")
    for f in range(5):
        spark.createDataFrame([r for p, r in rows if p == f], SCHEMA).coalesce(1).write.parquet(f"{src}/f{f}")
    checks = checks or [scratch_path(spark, "ckpt") for _ in range(2)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        again(spark, src, base, kind, checks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    return src, base, checks


def again(spark, src, base, kind, checks):
    for start, check in zip((late_stream, window_stream), checks, strict=True):
        stream = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
                  .option("pathGlobFilter", "*.parquet").parquet(src))
        start(stream, kind, base, check, ["event_id"], trigger={"availableNow": True}).awaitTermination()


def rounded(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_stream_equals_batch_with_late_and_repeated_events(spark):
    rows = events(random.Random(1), 300)
    batch = spark.createDataFrame([r for _, r in rows], SCHEMA).dropDuplicates(["event_id"])
    for kind, gold in (("vitals", gold_vitals), ("movement", gold_movement)):
        _, base, _ = run(spark, rows, kind)
        schema = state_schema(batch, kind)
        want = rounded(gold(batch))
        assert rounded(served_windows(spark, kind, base, schema).select(gold(batch).columns)) == want and len(want) > 20
        # the state store alone has lost events, the late ones
        alone = scratch_path(spark, "alone")
        os.makedirs(local_path(alone))
        os.symlink(os.path.join(local_path(base), "windows"), os.path.join(local_path(alone), "windows"))
        assert rounded(served_windows(spark, kind, alone, schema).select(gold(batch).columns)) != want


def test_a_replayed_micro_batch_changes_nothing(spark):
    rows = events(random.Random(2), 150)
    src, base, checks = run(spark, rows, "vitals")
    batch = spark.createDataFrame([r for _, r in rows], SCHEMA).dropDuplicates(["event_id"])
    schema = state_schema(batch, "vitals")
    before = rounded(served_windows(spark, "vitals", base, schema))
    commits = os.path.join(local_path(checks[0]), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    again(spark, src, base, "vitals", checks)
    assert rounded(served_windows(spark, "vitals", base, schema)) == before == rounded(gold_vitals(batch))


def test_no_events(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = served_windows(spark, "vitals", scratch_path(spark, "none"), state_schema(empty, "vitals"))
    assert got.count() == 0 and "mews_score" in got.columns


def test_only_dates_of_late_windows_are_read(spark, monkeypatch):
    import pulsegrid.streaming.gold as G
    base, read = scratch_path(spark, "gold_stream"), []
    real = G._stored
    monkeypatch.setattr(G, "_stored", lambda s, k, b, dates, sch: read.append(sorted(dates)) or real(s, k, b, dates, sch))

    def batch(i, *minutes):
        rows = [(100 * i + j, "1", START + dt.timedelta(minutes=m), 80.0, 97.0, 1.0) for j, m in enumerate(minutes)]
        df = spark.createDataFrame(rows, SCHEMA)
        G.store_rows(df, "vitals", base, i)
        return G.recompute_late(df, "vitals", base, i, ["event_id"], 600, 10)

    assert batch(0, 0, 5) == [] and batch(1, 100) == []
    assert batch(2, 2) == ["2024-01-01"] and read == [["2024-01-01"]]
    late = spark.read.parquet(f"{base}/late/vitals").collect()
    assert [(r.window_start, r.hr_n, r.batch) for r in late] == [(START, 3, 2)]
    assert sorted(batch(3, 59.9)) == ["2024-01-01", "2024-01-02"]  # 23:50 to midnight
