"""The folders of minutes that a landed batch is written to."""

import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import time_parts
from pulsegrid.session import local_path, scratch_path
from pulsegrid.sinks.files import land_batch
from pulsegrid.sinks.folders import append_json
from pulsegrid.sources import files
from pulsegrid.sources.files import PARTITION_COLS, read_landing_partitions


def minutes(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("patient_id"), (F.col("id") % 90 + 30.0).alias("heart_rate"),
                                 F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0)").alias("at"))


def tree(base):
    """Folder -> sorted lines, access modes of folders and files, names of checksum files."""
    root, lines, modes, sums = local_path(base), {}, set(), []
    for folder, _, names in os.walk(root):
        modes.add(("folder", os.stat(folder).st_mode & 0o777))
        for n in names:
            path = os.path.join(folder, n)
            modes.add(("file", os.stat(path).st_mode & 0o777))
            if n.endswith(".crc"):
                sums.append(os.path.exists(os.path.join(folder, n[1:-4])))
            elif n != "_SUCCESS":
                with open(path, "rb") as f:
                    lines.setdefault(os.path.relpath(folder, root), []).extend(f.read().split(b"\n")[:-1])
    return {k: sorted(v) for k, v in lines.items()}, modes, all(sums) and len(sums)


def test_a_minute_folder_starts_no_process(spark):
    """Spark's writer starts three chmod processes for each folder on the local file system."""
    def started():
        with open("/proc/stat") as f:
            return int(next(line for line in f if line.startswith("processes ")).split()[1])

    df, base = minutes(spark, 400), scratch_path(spark, "landing")
    land_batch(df, base, "warm", time_col="at")
    before = started()
    land_batch(df, base, "vitals", time_col="at")
    assert started() - before < 400
    assert read_landing_partitions(spark, f"{base}/vitals").count() == 400


def test_the_tree_is_that_of_sparks_writer(spark):
    t = "CASE WHEN id % 7 > 0 THEN TIMESTAMP_NTZ'2023-12-31 23:58:30' + make_dt_interval(0, 0, 0, id % 20 * 13.5) END"
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("é\"\n€ "), F.col("id"))).alias("a.b"), F.when(F.col("id") % 5 > 0, F.col("id") / 7).alias("x"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).alias("y"), F.repeat(F.lit("z"), (F.col("id") % 900).cast("int")).alias("long"),
        F.expr(t).alias("at"), F.array("id").alias("list"), F.struct(F.lit(None).cast("int").alias("n")).alias("inner")).repartition(3)
    df = df.withColumns(time_parts("at"))
    ours, spark_s = scratch_path(spark, "ours"), scratch_path(spark, "sparks")
    append_json(df, ours, PARTITION_COLS)
    df.write.mode("append").partitionBy(*PARTITION_COLS).json(spark_s)
    assert tree(ours) == tree(spark_s)
    assert len(tree(ours)[0]) == 6 and any("year=__HIVE_DEFAULT_PARTITION__" in k for k in tree(ours)[0])
    assert sorted(os.listdir(local_path(ours))) == sorted(os.listdir(local_path(spark_s)))
    # the checksums are those that Hadoop compares while it reads
    assert spark.read.text(ours).count() == 3000
    folder = max((f for f, _, n in os.walk(local_path(ours)) if "minute=" in f), key=lambda f: len(os.listdir(f)))
    name = next(n for n in os.listdir(folder) if n.startswith("part-"))
    with open(f"{folder}/{name}", "r+b") as f:
        f.seek(700)
        f.write(b"?")
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.text(ours).agg(F.max("value")).collect()


def test_an_append_adds_to_its_folders_and_a_failure_adds_nothing(spark):
    base = scratch_path(spark, "landing")
    land_batch(minutes(spark, 130), base, "vitals", time_col="at")
    land_batch(minutes(spark, 70), base, "vitals", time_col="at")
    land_batch(minutes(spark, 0), base, "vitals", time_col="at")
    got = read_landing_partitions(spark, f"{base}/vitals").groupBy("patient_id").count().collect()
    assert {r["patient_id"]: r["count"] for r in got} == {str(i): 2 if i < 70 else 1 for i in range(130)}
    before = tree(base)
    late = minutes(spark, 200).withColumn("heart_rate", F.when(F.col("patient_id") == "199", F.raise_error(F.lit("broken"))).otherwise(F.col("heart_rate")))
    with pytest.raises(Exception, match="broken"):
        land_batch(late, base, "vitals", time_col="at")
    assert tree(base) == before
    assert not os.path.exists(f"{local_path(base)}/vitals/_temporary")


def test_processing_time_and_no_rows(spark):
    base = scratch_path(spark, "landing")
    land_batch(minutes(spark, 0), base, "none")
    assert os.listdir(local_path(f"{base}/none")) and not tree(f"{base}/none")[0]
    land_batch(minutes(spark, 20), base, "vitals")
    assert read_landing_partitions(spark, f"{base}/vitals").count() == 20
    assert set(PARTITION_COLS) == {p.split("=")[0] for k in tree(f"{base}/vitals")[0] for p in k.split("/")}


def test_other_file_systems_get_sparks_writer(spark):
    root = scratch_path(spark, "mounted")
    os.makedirs(local_path(root))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.landing.link./in", f"file://{local_path(root)}")
    land_batch(minutes(spark, 5), "viewfs://landing/in", "vitals", time_col="at")
    assert read_landing_partitions(spark, f"{root}/vitals").count() == 5


def test_a_tree_of_one_top_folder_is_deleted_side_by_side(spark, monkeypatch):
    root = scratch_path(spark, "tree")
    for d in range(1, 4):
        for h in range(24):
            os.makedirs(local_path(f"{root}/vitals/year=2024/month=01/day=0{d}/hour={h:02d}/minute=00"))
    asked, real = [], files.delete_path
    monkeypatch.setattr(files, "delete_path", lambda s, p: asked.append(p) or real(s, p))
    assert files.delete_tree(spark, root) and not os.path.exists(local_path(root))
    assert len(asked) == 73 and sum("hour=" in p for p in asked) == 72
