"""Compaction of run folders (K02, ST06).

Every run leaves folders `etl_batch_date=/etl_run_id=` in Bronze, Silver and
the Gold states: 144 a day for ten-minute runs. ``compact`` rewrites those of a
batch date into one merged folder of sized files beside the table,
`{layer}/_compacted/{entity}/etl_batch_date=/v=<n>`, whose rows keep their run
id as a column.

The swap is one small file. A merged folder counts from the moment its note
`_runs.json` exists (written to another name and renamed, so it appears whole);
the note names the runs that the folder replaces, and readers leave their own
folders out from then on (``sources.files.date_folders``). So a stop

* before the note leaves a folder that nobody reads,
* after it leaves replaced run folders that nobody reads,

and both are removed by the next call. What a note replaced is removed only
``grace_seconds`` after it was written, by a later call: a reader that listed
the run folders before the swap finishes on them.

Only complete runs are merged: those of the run log (or ``runs``) that have no
pending note and are present in all three layers, so that a run held back by a
record threshold, stopped part-way or still writing stays as it is. A merged
run can no longer be replaced or taken back on its own (the ETL refuses);
a back-fill of the whole date (``bronze_mode='overwrite'``) removes the merged
folder too. One compaction of a table runs at a time; dates that no run writes
any more are the ones to compact, as each call rewrites the date.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pulsegrid.plans.etl import ENTITIES, STATES, merged_mark
from pulsegrid.sinks.files import RUN_LOG_SCHEMA
from pulsegrid.sinks.manifest import record_files
from pulsegrid.sources.files import (
    COMPACTED, LIVE, DateFolders, child_folders, compacted_folder, delete_path, file_system, folders_of, path_exists, scan,
    side_by_side, touch_path, write_small,
)

LAYERS = ("bronze", "silver", STATES)


def complete_runs(spark: SparkSession, base: str) -> set[str]:
    """Runs of the run log that have no pending note."""
    path = f"{base}/_run_log"
    if not path_exists(spark, path):
        return set()
    logged = spark.read.schema(RUN_LOG_SCHEMA).parquet(path).select("etl_run_id").distinct()
    return {r[0] for r in logged.collect()} - set(child_folders(spark, f"{base}/_pending"))


def compact(spark: SparkSession, base: str, dates: list[str], runs: set[str] | None = None, min_folders: int = 2,
            grace_seconds: float = 3600) -> dict[tuple[str, str, str], int]:
    """Merge the run folders of the given batch dates; returns the rows of each
    (layer, entity, date) that was rewritten. A table with fewer than
    ``min_folders`` folders to merge is left alone."""
    done = {}
    allowed = runs if runs is not None else complete_runs(spark, base)
    for entity in ENTITIES:
        found = {layer: {f.date: f for f in folders_of(spark, f"{base}/{layer}/{entity}", dates)} for layer in LAYERS}
        side_by_side(lambda f: sweep(spark, f, grace_seconds), [f for dated in found.values() for f in dated.values()])
        whole = {d: allowed.intersection(*({*found[layer][d].runs, *found[layer][d].merged} for layer in LAYERS))
                 for d in dict.fromkeys(dates) if all(d in dated for dated in found.values())}
        side_by_side(lambda run: touch_path(spark, merged_mark(base, run)), set().union(*whole.values()))
        for layer, dated in found.items():
            todo = [(dated[d], ready | set(dated[d].merged)) for d, ready in whole.items() if len(ready & set(dated[d].runs)) >= min_folders]
            if todo:
                done |= {(layer, entity, d): n for d, n in merge_folders(spark, base, layer, entity, todo).items()}
    return done


def merge_folders(spark: SparkSession, base: str, layer: str, entity: str, todo: list[tuple[DateFolders, set[str]]]) -> dict[str, int]:
    """Write the rows of the given runs of each date into a new merged folder,
    all dates in one job, then the notes that make readers use them; returns
    the rows of each date."""
    table, compacted = f"{base}/{layer}/{entity}", f"{base}/{layer}/{COMPACTED}/{entity}"
    number = {f.date: 1 + max([int(p.rsplit("/v=", 1)[1]) for p in [f.version, *f.dead] if p and "/v=" in p], default=0) for f, _ in todo}
    usual = Counter(number.values()).most_common(1)[0][0]
    v = F.lit(f"{usual:06d}")
    for n in set(number.values()) - {usual}:
        v = F.when(F.col("etl_batch_date").isin([d for d in number if number[d] == n]), f"{n:06d}").otherwise(v)
    rows = None
    for root, paths in ((table, [p for f, runs in todo for p in f.paths(runs)]), (compacted, [f.version for f, _ in todo if f.version])):
        if paths:  # the columns of all files: those of one date may have fewer
            schema = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths).schema
            part = scan(spark, root, paths, schema, False).drop("v")
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    (rows.withColumn("v", v).hint("rebalance", "etl_batch_date").write.partitionBy("etl_batch_date", "v")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(compacted))
    homes = {f.date: f"{compacted_folder(table, f.date)}/v={number[f.date]:06d}" for f, _ in todo}
    there = [h for h, yes in zip(homes.values(), side_by_side(lambda h: path_exists(spark, h), homes.values()), strict=True) if yes]
    record_files(spark, base, there)
    counts = {}
    if there:
        dated = spark.read.schema("etl_batch_date string, v string").option("basePath", compacted).parquet(*there)
        counts = {r[0]: r[1] for r in dated.groupBy("etl_batch_date").count().collect()}  # a row per date
    side_by_side(lambda x: write_small(spark, f"{homes[x[0].date]}/{LIVE}", json.dumps(sorted(x[1]))), todo)
    return {f.date: counts.get(f.date, 0) for f, _ in todo}


def sweep(spark: SparkSession, f: DateFolders, grace_seconds: float = 3600) -> list[str]:
    """Remove what the live note of a date replaced, and merged folders without
    a note, once they are ``grace_seconds`` old."""
    gone = []
    if f.dead:
        for path in f.dead:
            judged = f.version if path.startswith(f.table) else path  # a run folder died with the note
            if judged and _age(spark, f"{judged}/{LIVE}" if judged == f.version else judged) >= grace_seconds:
                delete_path(spark, path)
                gone.append(path)
    return gone


def _age(spark: SparkSession, path: str) -> float:
    """Seconds since a path was last written."""
    fs, p = file_system(spark, path)
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    return (now - fs.getFileStatus(p).getModificationTime()) / 1000
