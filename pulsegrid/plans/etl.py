"""Medallion job: landing -> Bronze -> Silver -> Gold.

Each run owns the partition `etl_batch_date=<date>/etl_run_id=<run>` of the
Bronze and Silver tables and of the Gold states, so writing a run twice
replaces it and taking it back deletes folders; nothing else is rewritten.
Silver cleans only the run's own Bronze rows. Gold of the touched dates is
merged from the runs' states (sums, counts, maxima per patient and window), so
a run reads its own rows and the dates' small states, not the dates' rows (ST06).
Row counts come from Observations on the writes (A28/K09), not extra passes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.clean import add_lineage, clean_movement, clean_vitals, route_name
from pulsegrid.operators.gold import merge_movement, merge_vitals, movement_state, vitals_state
from pulsegrid.session import scratch_path
from pulsegrid.sinks.files import append_run_log, write_layer_metrics
from pulsegrid.sinks.manifest import record_files
from pulsegrid.sources.files import (
    LANDING_GLOB, compacted_folder, delete_path, folders_of, landing_lines, parse_landing, partition_folder, path_exists,
    read_layer, run_folders, side_by_side,
)

ENTITIES = ("vitals", "movement")
RUN_PARTITIONS = ("etl_batch_date", "etl_run_id")
STATES = "_gold_state"


@dataclass
class EtlResult:
    run_id: str
    batch_dates: list[str] = field(default_factory=list)
    counts: dict[tuple[str, str], int] = field(default_factory=dict)
    skipped: list[tuple[str, str]] = field(default_factory=list)


def has_at_least(df: DataFrame, n: int) -> bool:
    """`len(df) >= n` (ST05), by one count for every threshold."""
    return n <= 0 or df.count() >= n


@dataclass
class Staged:
    """Landing lines of one run as a table in the shared folder, by route."""
    spark: SparkSession
    path: str
    frame: DataFrame
    seen: dict

    def part(self, *routes: str) -> DataFrame:
        return self.frame.filter(F.col("_route").isin(*routes)).drop("_route")

    def remove(self) -> None:
        delete_path(self.spark, self.path)


def stage_landing(lines: DataFrame, run_id: str, batch_date: str | Column | None) -> Staged:
    """Parse landing lines once into a staging table partitioned by route:
    `vitals`, `movement`, `other` devices and `rejected` lines. The counts of
    each and the batch dates are observed on the write."""
    spark = lines.sparkSession
    df = add_lineage(parse_landing(lines, ["source_file"]), run_id, batch_date, source_file=F.col("source_file"))
    df = df.withColumn("_route", F.when(F.col("bad_line").isNotNull(), "rejected").otherwise(route_name()))
    obs, r = Observation(f"landing_{run_id}"), F.col("_route")
    path = scratch_path(spark, "staging")
    (df.observe(obs, F.count(F.lit(1)).alias("consumed"), F.count_if(r == "rejected").alias("rejected"),
                F.count_if(r == "other").alias("other_device"),
                F.collect_set(F.when(r.isin(*ENTITIES), F.col("etl_batch_date"))).alias("dates"))
     .write.partitionBy("_route").parquet(path))
    return Staged(spark, path, spark.read.schema(df.schema).parquet(path), dict(obs.get))


def quarantine(staged: Staged, base: str) -> None:
    """Keep what no layer takes, as received: malformed lines and rows of other
    devices, with the reason, in `{base}/_quarantine` (per run, replaced by a
    replay)."""
    fields = [c for c in staged.frame.columns if c not in ("bad_line", "source_file", "_route", *S.LINEAGE_COLUMNS)]
    other = F.to_json(F.struct(*fields))
    rows = staged.part("rejected").select(F.col("bad_line").alias("raw_line"), "source_file", F.lit("malformed").alias("reason"),
                                          "etl_run_id")
    rows = rows.unionByName(staged.part("other").select(other.alias("raw_line"), "source_file",
                                                        F.lit("other device").alias("reason"), "etl_run_id"))
    (rows.write.partitionBy("etl_run_id").option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .parquet(f"{base}/_quarantine"))


def run_etl(spark: SparkSession, landing: str, base: str, run_id: str | None = None,
            batch_date: str | Column | None = None, min_records: int = 1,
            fall_threshold: float = S.FALL_SVM_THRESHOLD, minutes: int = S.WINDOW_MINUTES,
            run_log: bool = True, bronze_mode: str = "append", glob: str = LANDING_GLOB) -> EtlResult:
    """Run the three layers for the landing files under ``landing``.

    ``batch_date`` defaults to today's UTC date (the processing date); a
    column expression assigns dates per row instead (e.g. event date when
    back-filling history; a row without one gets the processing date).
    ``bronze_mode='append'`` adds a run to its dates (each file ingested
    once, see streaming.ingest); ``'overwrite'`` suits back-fills where the
    landing input holds whole batch dates: earlier runs of the touched dates
    go, which makes the whole job idempotent."""
    res = EtlResult(run_id or uuid.uuid4().hex[:8])
    staged = stage_landing(landing_lines(spark, landing, glob), res.run_id, batch_date)
    try:
        return run_staged(staged, base, res, min_records, fall_threshold, minutes, run_log, bronze_mode,
                          batch_date if isinstance(batch_date, str) else None)
    finally:
        staged.remove()


def run_staged(staged: Staged, base: str, res: EtlResult, min_records: int = 1,
               fall_threshold: float = S.FALL_SVM_THRESHOLD, minutes: int = S.WINDOW_MINUTES, run_log: bool = True,
               bronze_mode: str = "append", batch_date: str | None = None, defer: bool = True) -> EtlResult:
    """Layers of a staged run. With ``defer`` (the batch job, whose landing files
    stay where they are) a run of fewer than ``min_records`` readable records,
    or without a row of a known device, writes no layer, so that a later run
    can take the files (ST05)."""
    seen = staged.seen
    good = seen["consumed"] - seen["rejected"]
    if seen["rejected"] or seen["other_device"]:
        quarantine(staged, base)
    for k in ("consumed", "rejected", "other_device"):
        res.counts[("landing", k)] = int(seen[k])
    if defer and good < min_records or good == seen["other_device"]:
        res.skipped.append(("bronze", "all"))
        if not res.batch_dates:
            if run_log and good:
                append_run_log(staged.spark, base, res.run_id, res.counts)
            return res
    if batch_date is not None:
        res.batch_dates = sorted({batch_date, *res.batch_dates})
    bronze = staged.part(*ENTITIES).drop("bad_line")
    return run_layers(staged.spark, bronze, base, res, min_records, fall_threshold, minutes, run_log, bronze_mode)


def _each_entity(spark: SparkSession, fn) -> dict:
    """fn(entity) for vitals and movement side by side: their jobs are
    independent, and either alone rarely fills a cluster."""
    with ThreadPoolExecutor(len(ENTITIES)) as pool:
        return dict(zip(ENTITIES, pool.map(inheritable_thread_target(spark)(fn), ENTITIES), strict=True))


def run_layers(spark: SparkSession, bronze: DataFrame, base: str, res: EtlResult, min_records: int = 1,
               fall_threshold: float = S.FALL_SVM_THRESHOLD, minutes: int = S.WINDOW_MINUTES,
               run_log: bool = True, bronze_mode: str = "append") -> EtlResult:
    """Bronze rows (with lineage) -> the three layer tables. Shared by the
    batch job and the streaming ingestion (one call per micro-batch).

    ``res.batch_dates`` may hold dates to bring up to date besides those the
    rows have (after taking a run back). Whatever of the touched dates the new
    result does not contain is removed, so no layer keeps rows that its source
    no longer has."""
    if "etl_run_id" not in bronze.columns:
        bronze = bronze.withColumn("etl_run_id", F.lit(res.run_id))
    dates = set(res.batch_dates)
    refuse_merged(spark, base, res.run_id)

    def land(entity: str) -> dict:
        return write_layer_metrics(bronze.filter(route_name() == entity), base, "bronze", entity, by=RUN_PARTITIONS,
                                   extra={"dates": F.collect_set("etl_batch_date")})

    for entity, got in _each_entity(spark, land).items():
        res.counts[("bronze", entity)] = got["rows"]
        _drop_partitions(spark, f"{base}/bronze/{entity}", [(d, res.run_id) for d in dates - set(got["dates"])])
        dates.update(got["dates"])
    res.batch_dates = sorted(dates)
    if bronze_mode == "overwrite":
        for layer in ("bronze", "silver", STATES):
            for entity in ENTITIES:
                table = f"{base}/{layer}/{entity}"
                found = folders_of(spark, table, res.batch_dates)
                _drop_partitions(spark, table, [(f.date, run) for f in found for run in set(f.runs) - {res.run_id}])
                # before the note that keeps them from being read
                side_by_side(lambda path: delete_path(spark, path), [path for f in found for path in f.dead])
                side_by_side(lambda f, table=table: delete_path(spark, compacted_folder(table, f.date)),
                             [f for f in found if f.version or f.dead])

    steps = {"vitals": (clean_vitals, lambda df: vitals_state(df, minutes), merge_vitals),
             "movement": (clean_movement, lambda df: movement_state(df, fall_threshold, minutes), merge_movement)}
    _each_entity(spark, lambda entity: _refresh(spark, bronze.schema, base, entity, res, min_records, *steps[entity]))
    wrote = []
    for layer in ("bronze", "silver", STATES, "gold"):
        for entity in ENTITIES:
            for f in folders_of(spark, f"{base}/{layer}/{entity}", res.batch_dates):
                wrote += f.paths({res.run_id}) if layer != "gold" else f.paths()
    record_files(spark, base, wrote)
    if run_log:
        append_run_log(spark, base, res.run_id, res.counts)
    return res


def merged_mark(base: str, run_id: str) -> str:
    """File that exists once compaction may have merged a run's rows with others'."""
    return f"{base}/_merged_runs/{partition_folder('etl_run_id', run_id)}"


def refuse_merged(spark: SparkSession, base: str, run_id: str) -> None:
    """A run whose rows were merged is complete: its folders can no longer be
    replaced or taken back one by one."""
    if path_exists(spark, merged_mark(base, run_id)):
        raise ValueError(f"run {run_id} was compacted; use a new run id")


def _drop_partitions(spark: SparkSession, table: str, parts: Iterable[tuple[str, str]]) -> None:
    """Delete the folders of (batch date, run) pairs."""
    side_by_side(lambda x: delete_path(spark, f"{table}/{partition_folder('etl_batch_date', x[0])}/{partition_folder('etl_run_id', x[1])}"),
                 parts)


def _refresh(spark: SparkSession, schema, base: str, entity: str, res: EtlResult, min_records: int,
             to_silver, to_state, to_gold) -> None:
    """Silver and Gold of one entity for the touched dates: clean the Bronze
    runs that Silver lacks (this run, and runs that a record threshold held
    back), then merge the dates' states."""
    dates = res.batch_dates
    landed = run_folders(spark, f"{base}/bronze/{entity}", res.batch_dates)
    cleaned = run_folders(spark, f"{base}/silver/{entity}", res.batch_dates)
    owed = {res.run_id}.union(*(landed[d] - cleaned[d] for d in res.batch_dates))
    # layers are read with the schema they were written with: no footer-reading
    # schema job, and a table never written reads as empty; unreadable files fail.
    # Only the touched dates' folders are listed, whatever the table's history
    silver = to_silver(read_layer(spark, base, "bronze", entity, dates, schema, runs=owed))
    if min_records > 1 and not has_at_least(
            read_layer(spark, base, "silver", entity, dates, silver.schema, runs=set().union(*cleaned.values()) - owed)
            .select("etl_run_id").unionAll(silver.select("etl_run_id")), min_records):
        res.skipped.append(("silver", entity))
        written = set()
    else:
        got = write_layer_metrics(silver, base, "silver", entity, by=RUN_PARTITIONS, rebalance=False,
                                  extra={"own": F.collect_set(F.struct("etl_batch_date", "etl_run_id"))})
        written = {(r["etl_batch_date"], r["etl_run_id"]) for r in got["own"]}
        if got["rows"]:
            res.counts[("silver", entity)] = got["rows"]
        else:
            res.skipped.append(("silver", entity))
    # what an earlier attempt left of the owed runs and this one did not write
    for layer, ours in (("silver", written), (STATES, set())):
        left = run_folders(spark, f"{base}/{layer}/{entity}", res.batch_dates)
        _drop_partitions(spark, f"{base}/{layer}/{entity}",
                         [(d, run) for d, runs in left.items() for run in runs & owed if (d, run) not in ours])
    # listed after the write above, which changed the table's files
    state = to_state(read_layer(spark, base, "silver", entity, dates, silver.schema, runs=owed))
    if written:
        write_layer_metrics(state, base, STATES, entity, by=RUN_PARTITIONS)
    got = write_layer_metrics(to_gold(read_layer(spark, base, STATES, entity, dates, state.schema)), base, "gold", entity,
                              extra={"dates": F.collect_set("etl_batch_date")})
    side_by_side(lambda d: delete_path(spark, f"{base}/gold/{entity}/{partition_folder('etl_batch_date', d)}"),
                 set(res.batch_dates) - set(got["dates"]))
    if ("silver", entity) not in res.skipped:
        res.counts[("gold", entity)] = got["rows"]


def drop_run(spark: SparkSession, base: str, run_id: str, dates: list[str]) -> list[str]:
    """Take back what an unfinished run wrote: its own partitions of the dates
    are deleted, nothing is read or rewritten. Returns the dates in which it
    had any, whose Gold the caller brings up to date."""
    refuse_merged(spark, base, run_id)
    had = set()
    for layer in ("bronze", "silver", STATES):
        for entity in ENTITIES:
            table = f"{base}/{layer}/{entity}"
            own = [d for d, runs in run_folders(spark, table, dates).items() if run_id in runs]
            had.update(own)
            _drop_partitions(spark, table, [(d, run_id) for d in own])
    delete_path(spark, f"{base}/_quarantine/{partition_folder('etl_run_id', run_id)}")
    return sorted(had)
