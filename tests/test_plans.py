"""Plan shapes that matter at scale: pruning, one shuffle per aggregation,
no joins where a one-pass aggregate suffices, no shuffle in the rule engine."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_and_shuffles_once(spark):
    p = _plan(E.entry(spark))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p
    assert p.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in p


def test_alert_engine_has_no_shuffle(spark):
    p = _plan(E.queries()["r06_alerts_standard"](spark, SF))
    assert "Exchange" not in p and "Generate explode" in p


def test_global_figures_use_no_joins(spark):
    for name in ("a07_kpis", "a29_selection_counts", "a15_activity_histogram", "a16_alert_distribution"):
        p = _plan(E.queries()[name](spark, SF))
        assert "Join" not in p and "CartesianProduct" not in p, name


def test_gold_aggregates_partially_before_the_shuffle(spark):
    p = _plan(E.queries()["a06_gold_movement"](spark, SF))
    assert "partial_avg" in p and "partial_max" in p and "partial_sum" in p


def test_summary_join_reuses_the_aggregates_partitioning(spark):
    """J02 joins two per-patient aggregates: without a broadcast (large
    estimates) the sort-merge join adds no exchange of its own."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(E.queries()["j02_side_by_side"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "CartesianProduct" not in p
    by_patient = [ln for ln in p.splitlines() if "Exchange hashpartitioning(patient_id" in ln and "window" not in ln]
    assert len(by_patient) == 2  # one per summary aggregate, none added for the join


def test_batch_date_read_prunes_partitions(spark):
    from pulsegrid.session import scratch_path
    from pulsegrid.sinks.files import write_layer
    from pulsegrid.sources.files import read_layer
    base = scratch_path(spark, "lake")
    df = spark.createDataFrame([("1600", 1.0, "2024-01-01"), ("1601", 2.0, "2024-01-02")],
                               "patient_id string, avg_hr double, etl_batch_date string")
    write_layer(df, base, "gold", "vitals")
    scan = [ln for ln in _plan(read_layer(spark, base, "gold", "vitals", batch_date="2024-01-02")).splitlines()
            if "FileScan parquet" in ln][0]
    assert "PartitionFilters: [isnotnull(etl_batch_date" in scan and "2024-01-02" in scan


def test_landing_partition_filters_prune_directories(spark):
    """Filters on the zero-padded time parts reach the scan as partition
    filters, so other folders are never listed into the read."""
    import os

    from pyspark.sql import functions as F

    from pulsegrid.session import local_path, scratch_path
    from pulsegrid.sources.files import read_landing_partitions
    base = scratch_path(spark, "landing")
    for day, hr in (("01", 80), ("02", 90)):
        d = os.path.join(local_path(base), "year=2024", "month=01", f"day={day}", "hour=00", "minute=00")
        os.makedirs(d)
        with open(os.path.join(d, "part.jsonl"), "w") as f:
            f.write('{"patient_id": "1600", "device_type": "vital_monitor", "timestamp": 1.0, "heart_rate": %d}\n' % hr)
    df = read_landing_partitions(spark, base).filter((F.col("year") == "2024") & (F.col("day") == "02"))
    scan = [ln for ln in _plan(df).splitlines() if "FileScan" in ln][0]
    assert "PartitionFilters: [" in scan and "(day" in scan
    assert [r.heart_rate for r in df.select("heart_rate").collect()] == [90.0]


def test_histogram_range_subqueries_reuse_the_gold_shuffle(spark):
    """A15's min/max scalar subqueries are merged into one and read the
    main plan's Gold exchange: the input is scanned once."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(E.queries()["a15_activity_histogram"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert p.count("FileScan") == 1 and "ReusedExchange" in p


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_route_counts_scan_the_input_once(spark):
    from pulsegrid.plans.catalog import QUERIES
    assert _plan(QUERIES["p02_route_counts"](spark, SF)).count("FileScan parquet") == 1


def test_available_dates_open_no_file(spark):
    from pulsegrid.session import scratch_path
    from pulsegrid.sinks.files import write_layer
    from pulsegrid.sources.files import available_dates
    base = scratch_path(spark, "lake")
    write_layer(spark.createDataFrame([("a", "2024-01-01")], "p string, etl_batch_date string"), base, "gold", "vitals")
    df = available_dates(spark, base, "gold", "vitals")
    assert "FileScan" not in _plan(df) and [r[0] for r in df.collect()] == ["2024-01-01"]


def test_sensor_statistics_expand_only_pre_aggregated_rows(spark):
    """The rows meet a map-side aggregate before any is repeated for a distinct count."""
    from pulsegrid.operators.datasets import sensor_statistics
    raw = spark.range(10).selectExpr("'phone' AS device_type", "'gyroscope' AS sensor_type", "id AS subject_id",
                                     "'A' AS activity_code", "1.0D AS x", "1.0D AS y", "1.0D AS z")
    plan = _plan(sensor_statistics(raw))
    assert "Expand" not in plan or plan.index("Expand") < plan.rindex("HashAggregate")


def test_landing_tree_read_of_a_day_lists_only_its_folders(spark, monkeypatch):
    import os

    from pulsegrid.session import local_path, scratch_path
    from pulsegrid.sources import files
    base = scratch_path(spark, "landing")
    for day, minute, hr in (("01", "00", 80), ("02", "00", 90), ("02", "59", 91)):
        d = os.path.join(local_path(base), "year=2024", "month=01", f"day={day}", "hour=00", f"minute={minute}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.json"), "w") as f:
            f.write(f'{{"patient_id": "1", "heart_rate": {hr}}}\n')
    listed, real = [], files.glob_paths
    monkeypatch.setattr(files, "glob_paths", lambda s, p: listed.extend(real(s, p)) or listed)
    day = files.read_landing_partitions(spark, base, only={"year": "2024", "month": "01", "day": "02"})
    assert sorted(r.heart_rate for r in day.collect()) == [90.0, 91.0] and len(listed) == 1
    assert len(day.inputFiles()) == 2
    assert files.read_landing_partitions(spark, base, only={"year": "2023"}).count() == 0
    assert files.read_landing_partitions(spark, base).count() == 3
