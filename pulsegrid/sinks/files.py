"""File sinks: layer tables, CSV export, landing JSON, run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import time_parts
from pulsegrid.sinks.folders import append_json
from pulsegrid.sources.files import PARTITION_COLS


def write_layer(df: DataFrame, base: str, layer: str, entity: str, partitioned: bool = True,
                mode: str | None = None) -> int:
    """Write a layer table (K01/K02) and return its row count; see
    :func:`write_layer_metrics`."""
    return write_layer_metrics(df, base, layer, entity, partitioned=partitioned, mode=mode)["rows"]


def write_layer_metrics(df: DataFrame, base: str, layer: str, entity: str, extra: dict[str, Column] | None = None,
                        partitioned: bool = True, mode: str | None = None,
                        by: tuple[str, ...] = ("etl_batch_date",), rebalance: bool = True) -> dict:
    """Write a layer table; its row count and further aggregates of the
    written rows (``extra``: name -> aggregate column) are observed on the
    same write - no extra pass.

    Partitioned by ``by`` (columns the frame has) with dynamic partition
    overwrite: a rerun replaces exactly the partitions it produces, and a
    write without rows leaves no file. Rows are rebalanced by the partition
    columns first, so files have the session's advisory size instead of one
    small file for each task and date; a large date still spreads over many
    tasks (``rebalance=False`` for rows that come from such files in a narrow
    plan). ``partitioned=False`` appends instead, and skips an empty frame
    (K01)."""
    by = tuple(c for c in by if partitioned and c in df.columns)
    if not by and df.isEmpty():
        return {"rows": 0}
    obs = Observation(f"rows_{layer}_{entity}")
    aggs = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in (extra or {}).items()]
    # observed above the rebalance: an exchange that turns out empty is cut off
    # at run time, with all that stands below it
    df = (df.hint("rebalance", *by) if by and rebalance else df).observe(obs, *aggs)
    if by:
        w = df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode(mode or "overwrite")
    else:
        w = df.write.mode(mode or "append")
    w.parquet(f"{base}/{layer}/{entity}")
    got = dict(obs.get)
    got["rows"] = int(got["rows"])
    return got


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV export of any result (K07); text is written as is (no trimming)."""
    (df.write.mode("overwrite").option("header", str(header).lower())
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def land_batch(df: DataFrame, base: str, kind: str, time_col=None) -> None:
    """Events -> JSON-Lines landing files under `{base}/{kind}/year=/month=/
    day=/hour=/minute=` (K05 batch twin). Partitions come from processing
    time unless an event-time column is given (F05)."""
    t = F.current_timestamp() if time_col is None else (F.col(time_col) if isinstance(time_col, str) else time_col)
    out = df.withColumns(time_parts(t))
    if time_col is not None:
        # contiguous time ranges per task: each minute folder gets about one
        # file instead of one per task; a busy minute still spreads over
        # tasks because the boundaries are on the fine-grained time
        out = out.withColumn("_t", t).repartitionByRange("_t").drop("_t")
    append_json(out, f"{base}/{kind}", PARTITION_COLS)


RUN_LOG_SCHEMA = "etl_run_id string, layer string, data_type string, record_count long, logged_at timestamp_ntz"


def run_log_rows(spark: SparkSession, run_id: str, counts: dict[tuple[str, str], int]) -> DataFrame:
    """Batch metadata (K09): one row per written layer table, and the landing
    counters (lines consumed, rejected as malformed, of other devices)."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, layer, entity, int(n), now) for (layer, entity), n in counts.items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, base: str, run_id: str, counts: dict[tuple[str, str], int]) -> None:
    """Append the run's metadata; written last, so a logged run completed
    all of its layer writes."""
    run_log_rows(spark, run_id, counts).write.mode("append").parquet(f"{base}/_run_log")


def run_logged(spark: SparkSession, base: str, run_id: str) -> bool:
    """Whether a run completed (its metadata rows are in the run log)."""
    from pulsegrid.sources.files import path_exists
    path = f"{base}/_run_log"
    if not path_exists(spark, path):
        return False
    return not spark.read.schema(RUN_LOG_SCHEMA).parquet(path).filter(F.col("etl_run_id") == run_id).isEmpty()
