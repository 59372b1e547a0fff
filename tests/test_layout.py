"""Date-scoped reads and compaction of run folders."""

import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import compaction, etl
from pulsegrid.plans.compaction import LAYERS, compact
from pulsegrid.plans.etl import ENTITIES, EtlResult, drop_run, run_layers
from pulsegrid.session import local_path, scratch_path
from pulsegrid.sinks.files import write_layer
from pulsegrid.sinks.manifest import file_rows
from pulsegrid.sources import files
from pulsegrid.sources.files import date_folders, read_layer, run_folders

BRONZE = "patient_id string, device_type string, timestamp double, heart_rate double, spo2 double, x double, y double, z double, etl_batch_date string"


def bronze(spark, run, n=20, dates=("2024-01-01", "2024-01-02")):
    rows = [(f"{1600 + i % 3}", "vital_monitor" if i % 2 else "imu_sensor", 1704067200.0 + 60 * i, 70.0 + run + i, 96.0, 1.0 * i, 2.0, 3.0, d)
            for i in range(n) for d in dates]
    return spark.createDataFrame(rows, BRONZE)


def lake(spark, runs=3, **kw):
    base = scratch_path(spark, "lake")
    for r in range(runs):
        run_layers(spark, bronze(spark, r, **kw), base, EtlResult(f"run{r}"))
    return base


def state(spark, base):
    """All rows of all tables; sums up to the order of adding."""
    def plain(r):
        return str(sorted((k, round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items() if k != "etl_processed_time"))
    return {(layer, e): sorted(plain(r) for r in read_layer(spark, base, layer, e).collect()) for layer in (*LAYERS, "gold") for e in ENTITIES}


def other_dates(base, layer, entity, n=2000):
    table = os.path.join(local_path(base), layer, entity)
    for i in range(n):
        folder = os.path.join(table, f"etl_batch_date=1990-{i:05d}", "etl_run_id=old")
        os.makedirs(folder)
        with open(os.path.join(folder, "part-0.parquet"), "w") as f:
            f.write("never opened")


def test_a_date_read_lists_only_its_own_folders(spark):
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", 1.0, "2024-01-01"), ("1601", 2.0, "2024-01-02")], "patient_id string, avg_hr double, etl_batch_date string")
    write_layer(df, base, "gold", "vitals")
    other_dates(base, "gold", "vitals")
    got = read_layer(spark, base, "gold", "vitals", "2024-01-02")  # schema from its own files too
    assert [r.patient_id for r in got.collect()] == ["1601"]
    assert all("etl_batch_date=2024-01-02" in f for f in got.inputFiles()) and len(got.inputFiles()) == 1
    two = read_layer(spark, base, "gold", "vitals", ["2024-01-01", "2024-01-02", "2024-01-03"], df.schema)
    assert sorted(r.patient_id for r in two.collect()) == ["1600", "1601"]
    assert read_layer(spark, base, "gold", "vitals", "2024-01-03", df.schema).count() == 0
    assert read_layer(spark, base, "gold", "vitals", [], df.schema).count() == 0


def test_a_run_lists_only_the_dates_it_touches(spark, monkeypatch):
    base = lake(spark, 1)
    for layer in LAYERS:
        for e in ENTITIES:
            other_dates(base, layer, e, 100)
    listed, scanned = [], []
    children, scan = files.child_folders, files.scan
    monkeypatch.setattr(files, "child_folders", lambda s, p: listed.append(p) or children(s, p))
    monkeypatch.setattr(files, "scan", lambda s, t, paths, *a: scanned.extend(paths) or scan(s, t, paths, *a))
    res = run_layers(spark, bronze(spark, 5, dates=("2024-01-02",)), base, EtlResult("again"), min_records=2)
    assert res.counts[("gold", "vitals")] > 0
    assert listed and all("2024-01-02" in p for p in listed)
    assert scanned and all("2024-01-02" in p for p in scanned)


def test_missing_date_has_the_columns_of_the_table(spark):
    base = lake(spark, 1)
    got = read_layer(spark, base, "silver", "vitals", "1999-01-01")
    assert got.count() == 0 and set(got.columns) == set(read_layer(spark, base, "silver", "vitals").columns)
    assert read_layer(spark, base, "silver", "nothing", "1999-01-01").columns == []


def test_runs_of_a_date(spark):
    base = lake(spark, 2)
    assert run_folders(spark, f"{base}/bronze/vitals", ["2024-01-01", "1999-01-01"]) == {"2024-01-01": {"run0", "run1"}, "1999-01-01": set()}
    some = read_layer(spark, base, "bronze", "vitals", ["2024-01-01", "2024-01-02"], runs={"run1"})
    assert {r.etl_run_id for r in some.collect()} == {"run1"}


# --- compaction ------------------------------------------------------------------

DATES = ["2024-01-01", "2024-01-02"]


def folders(base, layer="bronze", entity="vitals", date=DATES[0]):
    p = os.path.join(local_path(base), layer, entity, f"etl_batch_date={date}")
    return sorted(os.listdir(p)) if os.path.isdir(p) else []


def test_compaction_changes_no_row_and_later_runs_build_on_it(spark):
    base, plain = lake(spark), lake(spark)
    before = state(spark, base)
    done = compact(spark, base, DATES)
    assert set(done) == {(layer, e, d) for layer in LAYERS for e in ENTITIES for d in DATES}
    assert state(spark, base) == before
    assert len(folders(base)) == 3  # kept for readers that listed them before
    assert compact(spark, base, DATES, grace_seconds=0) == {}
    assert folders(base) == [] and state(spark, base) == before
    for b in (base, plain):
        run_layers(spark, bronze(spark, 9), b, EtlResult("run9"))
    assert state(spark, base) == state(spark, plain)
    assert compact(spark, base, DATES, min_folders=2, grace_seconds=0) == {}  # one new folder: not yet
    assert compact(spark, base, DATES, min_folders=1, grace_seconds=0)
    assert compact(spark, base, DATES, grace_seconds=0) == {}
    assert state(spark, base) == state(spark, plain)
    some = read_layer(spark, base, "silver", "vitals", DATES[0], runs={"run9"})
    assert {r.etl_run_id for r in some.collect()} == {"run9"}
    home = os.path.join(local_path(base), "bronze", "_compacted", "vitals", f"etl_batch_date={DATES[0]}")
    assert os.listdir(home) == ["v=000002"]


@pytest.mark.parametrize("step", ["data", "note", "sweep"])
def test_a_stop_at_any_step_leaves_all_rows_once(spark, monkeypatch, step):
    base = lake(spark)
    before = state(spark, base)
    real_write, real_delete = compaction.write_small, compaction.delete_path
    calls = []

    def stop(*a):
        calls.append(a)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return (real_write if step != "sweep" else real_delete)(*a)

    def after(*a):
        real_write(*a)
        calls.append(a)
        if len(calls) == 3:
            raise RuntimeError("driver lost")

    if step == "sweep":
        compact(spark, base, DATES)
    monkeypatch.setattr(compaction, *{"data": ("write_small", stop), "note": ("write_small", after), "sweep": ("delete_path", stop)}[step])
    with pytest.raises(RuntimeError):
        compact(spark, base, DATES, grace_seconds=0)
    assert state(spark, base) == before
    monkeypatch.undo()
    compact(spark, base, DATES, grace_seconds=0)
    compact(spark, base, DATES, grace_seconds=0)
    assert state(spark, base) == before and folders(base) == []


def test_a_reader_that_listed_before_the_swap_finishes(spark):
    base = lake(spark)
    early = read_layer(spark, base, "bronze", "vitals", DATES)
    n = early.count()
    compact(spark, base, DATES)
    assert early.count() == n == read_layer(spark, base, "bronze", "vitals", DATES).count()


def test_only_complete_runs_are_merged(spark):
    base = lake(spark)
    run_layers(spark, bronze(spark, 7), base, EtlResult("open"), run_log=False)
    before = state(spark, base)
    compact(spark, base, DATES, grace_seconds=0)
    f = date_folders(spark, f"{base}/silver/vitals", DATES[0])
    assert f.runs == ["open"] and f.merged == ["run0", "run1", "run2"]
    assert state(spark, base) == before
    drop_run(spark, base, "open", DATES)
    assert read_layer(spark, base, "bronze", "vitals").filter("etl_run_id = 'open'").count() == 0
    for call in (lambda: drop_run(spark, base, "run1", DATES), lambda: run_layers(spark, bronze(spark, 1), base, EtlResult("run1"))):
        with pytest.raises(ValueError, match="compacted"):
            call()


def test_a_back_fill_replaces_merged_rows(spark):
    base = lake(spark)
    compact(spark, base, DATES)
    run_layers(spark, bronze(spark, 4), base, EtlResult("fill"), bronze_mode="overwrite")
    for layer in LAYERS:
        for e in ENTITIES:
            assert {r.etl_run_id for r in read_layer(spark, base, layer, e).select("etl_run_id").collect()} == {"fill"}
    clean = scratch_path(spark, "lake")
    run_layers(spark, bronze(spark, 4), clean, EtlResult("fill"), bronze_mode="overwrite")
    assert state(spark, base)["gold", "vitals"] == state(spark, clean)["gold", "vitals"]


def test_merged_files_are_few(spark):
    base = lake(spark, 6)
    compact(spark, base, DATES, grace_seconds=0)
    merged = read_layer(spark, base, "bronze", "vitals", DATES[0])
    assert len(merged.inputFiles()) < 6 and merged.agg(F.count_distinct("etl_run_id")).first()[0] == 6
    assert etl.STATES in LAYERS


def test_many_dates_are_listed_together_as_one_by_one(spark, monkeypatch):
    base, dates = scratch_path(spark, "lake"), [f"2024-01-{d:02d}" for d in range(1, 6)] + ["odd {date},*", "1999-01-01"]
    table = f"{base}/bronze/vitals"
    home = f"{base}/bronze/_compacted/vitals"
    for d in dates[:-1]:
        os.makedirs(f"{local_path(table)}/{files.partition_folder('etl_batch_date', d)}")
        if d != dates[0]:  # rows of the first one lie in its own folder
            for run in ("a", "b=?"):
                os.makedirs(f"{local_path(table)}/{files.partition_folder('etl_batch_date', d)}/{files.partition_folder('etl_run_id', run)}")
    for v, note in (("v=000001", '["a"]'), ("v=000002", '["a", "c"]'), ("v=000003", None)):
        folder = f"{home}/{files.partition_folder('etl_batch_date', dates[1])}/{v}"
        os.makedirs(local_path(folder))
        if note:
            files.write_small(spark, f"{folder}/{files.LIVE}", note)
    one_by_one = sorted((f for d in dates if (f := date_folders(spark, table, d))), key=lambda f: f.date)
    assert [f.date for f in one_by_one] == sorted(dates[:-1])
    monkeypatch.setattr(files, "child_folders", None)  # not a call for each date
    assert sorted(files.folders_of(spark, table, dates), key=lambda f: f.date) == one_by_one


def test_many_dates_are_looked_up_and_not_searched_for(spark, monkeypatch):
    base, dates = scratch_path(spark, "lake"), [f"2024-01-{d:02d}" for d in range(1, 6)]
    table, asked, real = f"{base}/bronze/vitals", [], files.glob_paths
    for d in dates[:-1]:
        os.makedirs(local_path(f"{table}/etl_batch_date={d}/etl_run_id=a"))
    other_dates(base, "bronze", "vitals", 20)
    monkeypatch.setattr(files, "glob_paths", lambda s, p: asked.append(p) or real(s, p))
    assert [f.date for f in files.folders_of(spark, table, dates)] == dates[:-1]
    # an alternative with a slash is a path of its own; one without is compared with every folder of the table
    assert len(asked) == 2 and "{" in asked[0] and "{" in asked[1]
    assert all("/" in name for p in asked for name in p[p.index("{") + 1:p.rindex("}")].split(","))


def list_tasks(spark, group, read):
    """Tasks of each job that ``read`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        read()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    track = spark.sparkContext.statusTracker()
    return [track.getStageInfo(s).numTasks for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds]


def test_folders_are_listed_in_a_few_tasks(spark):
    base, limit = scratch_path(spark, "lake"), spark.conf.get(files._LIST_TASKS)
    df = spark.createDataFrame([("1600", f"2024-{i:03d}") for i in range(100)], "patient_id string, etl_batch_date string")
    write_layer(df, base, "gold", "vitals")
    dates, most = [f"2024-{i:03d}" for i in range(100)], 4 * spark.sparkContext.defaultParallelism
    assert most < 100
    for n, read in enumerate((lambda: read_layer(spark, base, "gold", "vitals", schema=df.schema),
                              lambda: read_layer(spark, base, "gold", "vitals", dates, df.schema),
                              lambda: file_rows(spark, [f"{base}/gold/vitals/etl_batch_date={d}" for d in dates]))):
        tasks = list_tasks(spark, f"listing {n}", read)
        assert tasks and max(tasks) <= most, (n, tasks)
    assert read_layer(spark, base, "gold", "vitals", dates, df.schema).count() == 100
    assert spark.conf.get(files._LIST_TASKS) == limit


def test_the_list_limit_is_put_back_by_the_last_thread(spark):
    limit = spark.conf.get(files._LIST_TASKS)
    with pytest.raises(OSError):
        with files.few_list_tasks(spark):
            with files.few_list_tasks(spark):
                pass
            assert int(spark.conf.get(files._LIST_TASKS)) <= 4 * spark.sparkContext.defaultParallelism
            raise OSError
    assert spark.conf.get(files._LIST_TASKS) == limit


def test_delete_tree_leaves_nothing(spark):
    root = scratch_path(spark, "tree")
    for name in ("a/b/c=1/x", "a/_h/{y}", ".z", "a/w,"):
        os.makedirs(os.path.dirname(local_path(f"{root}/{name}")), exist_ok=True)
        open(local_path(f"{root}/{name}"), "w").close()
    assert files.delete_tree(spark, root) and not os.path.exists(local_path(root))
    assert not files.delete_tree(spark, root)


def test_dates_are_compacted_in_one_job_per_table(spark, monkeypatch):
    base = scratch_path(spark, "lake")
    dates = [f"2024-01-{d:02d}" for d in range(1, 6)]
    for r in range(2):
        run_layers(spark, bronze(spark, r, 4, dates[:3 + 2 * r]), base, EtlResult(f"run{r}"))
    before, noted = state(spark, base), []
    record = compaction.record_files
    monkeypatch.setattr(compaction, "record_files", lambda s, b, folders: noted.append(len(folders)) or record(s, b, folders))
    done = compact(spark, base, dates, grace_seconds=0)
    assert set(done) == {(layer, e, d) for layer in LAYERS for e in ENTITIES for d in dates[:3]}  # the others have one run
    assert all(done["bronze", e, d] == 4 for e in ENTITIES for d in dates[:3])
    assert noted == [3] * 6 and state(spark, base) == before
