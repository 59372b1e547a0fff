"""Gold windows as a stream.

Two queries read the same events. ``window_stream`` keeps each open window in
the state store: event-time watermark, repeated events dropped within it,
sums, counts and maxima per patient and window, and with every micro-batch the
windows that changed. What Spark drops there, events behind the watermark, must
not be lost: ``late_stream`` stores all events by event date and, when a
micro-batch holds events that are ``delay`` or more behind the newest one, works
out their windows again from all stored events of these dates.

An event that the first query drops is always late for the second one: that one
measures against all events up to and including the event's own micro-batch,
Spark's watermark against earlier ones only. And once a window was worked out
again, each further event of it is late too. So a window's newest late result,
if it has one, is complete; else its newest result from the state store is
(``served_windows``). Both queries must read the files in the same order (one
source, by age). Micro-batches are written to folders of their own, named by
batch, so a replay replaces what it wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid import schemas as S
from pulsegrid.operators.clean import drop_unkeyed
from pulsegrid.operators.gold import merge_movement, merge_vitals, movement_state, vitals_state, window_bounds
from pulsegrid.sources.files import child_files, partition_folder, path_exists, read_small, scan, side_by_side, write_small

KINDS: dict[str, tuple[Callable, Callable]] = {"vitals": (vitals_state, merge_vitals), "movement": (movement_state, merge_movement)}
WINDOW_KEYS = ["patient_id", "window_start", "window_end"]


def window_stream(silver: DataFrame, kind: str, base: str, checkpoint: str, ids: Sequence[str], delay: str = "10 minutes",
                  minutes: int = S.WINDOW_MINUTES, trigger: dict | None = None) -> StreamingQuery:
    """Windows of a stream of Silver rows from the state store, into
    `{base}/windows/{kind}/batch=`; ``ids`` name what tells one event from all
    others."""
    state_of = KINDS[kind][0]
    rows = silver.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(list(ids))
    windows = state_of(rows, minutes=minutes)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/windows/{kind}/batch={batch_id:09d}")

    w = (windows.writeStream.queryName(f"windows_{kind}").outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(each))
    return (w.trigger(**trigger) if trigger else w).start()


def late_stream(silver: DataFrame, kind: str, base: str, checkpoint: str, ids: Sequence[str], delay_seconds: float = 600,
                minutes: int = S.WINDOW_MINUTES, trigger: dict | None = None) -> StreamingQuery:
    """Store all Silver rows by event date, and work out again the windows that
    late ones fall into, into `{base}/late/{kind}/batch=`."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = drop_unkeyed(batch)
        store_rows(rows, kind, base, batch_id)
        recompute_late(rows, kind, base, batch_id, ids, delay_seconds, minutes)

    w = silver.writeStream.queryName(f"late_{kind}").option("checkpointLocation", checkpoint).foreachBatch(each)
    return (w.trigger(**trigger) if trigger else w).start()


def store_rows(rows: DataFrame, kind: str, base: str, batch_id: int) -> None:
    dated = rows.withColumns({"event_date": F.date_format("event_timestamp", "yyyy-MM-dd"), "batch": F.lit(f"{batch_id:09d}")})
    (dated.hint("rebalance", "event_date").write.partitionBy("event_date", "batch").option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").parquet(f"{base}/rows/{kind}"))


def _stored(spark: SparkSession, kind: str, base: str, dates: Sequence[str], schema) -> DataFrame:
    """Rows of some event dates; no other date is listed."""
    table = f"{base}/rows/{kind}"
    folders = [f"{table}/{partition_folder('event_date', d)}" for d in dates]
    paths = [p for p, yes in zip(folders, side_by_side(lambda p: path_exists(spark, p), folders), strict=True) if yes]
    return scan(spark, table, paths, schema, False) if paths else spark.createDataFrame([], schema)


def recompute_late(mine: DataFrame, kind: str, base: str, batch_id: int, ids: Sequence[str], delay_seconds: float, minutes: int) -> list[str]:
    """Windows of the late rows of a micro-batch, from all stored rows; returns
    the event dates that were read."""
    spark, notes, own = mine.sparkSession, f"{base}/newest/{kind}", f"{batch_id:09d}"
    earlier = [n for n in child_files(spark, notes) if n < f"{own}.json"]
    before = json.loads(read_small(spark, f"{notes}/{earlier[-1]}"))["newest"] if earlier else None
    found = mine.agg(F.max(F.unix_micros("event_timestamp")).alias("newest")).first()["newest"]
    newest = max((x for x in (before, found) if x is not None), default=None)
    write_small(spark, f"{notes}/{own}.json", json.dumps({"newest": newest}))
    if found is None:
        return []
    late = mine.where(F.unix_micros("event_timestamp") <= F.lit(newest - int(delay_seconds * 1e6)))
    window = window_bounds("event_timestamp", minutes)
    keys = late.select("patient_id", window.alias("w")).distinct()
    # a window may reach into the day before or after the row's
    dates = [r[0] for r in keys.select(F.explode(F.array(*[F.date_format(F.col(f"w.{x}"), "yyyy-MM-dd") for x in ("start", "end")])))
             .distinct().collect()]
    if not dates:
        return []
    keys = keys.select(F.col("patient_id").alias("_p"), F.col("w.start").alias("_w"))
    rows = _stored(spark, kind, base, dates, mine.schema).dropDuplicates(list(ids)).withColumn("_start", window["start"])
    rows = rows.join(keys, (rows["patient_id"] == keys["_p"]) & (rows["_start"] == keys["_w"]), "left_semi").drop("_start")
    KINDS[kind][0](rows, minutes=minutes).write.mode("overwrite").parquet(f"{base}/late/{kind}/batch={own}")
    return dates


def served_windows(spark: SparkSession, kind: str, base: str, state_schema) -> DataFrame:
    """Gold of a kind: of each window the newest late result, else the newest
    one from the state store."""
    versions = None
    for rank, part in enumerate(("windows", "late")):
        path = f"{base}/{part}/{kind}"
        if path_exists(spark, path):
            df = spark.read.schema(state_schema).parquet(path).withColumn("_version", F.struct(F.lit(rank), F.col("batch").cast("long")))
            versions = df if versions is None else versions.unionByName(df)
    if versions is None:
        return KINDS[kind][1](spark.createDataFrame([], state_schema).drop("batch"))
    rest = [c for c in state_schema.names if c not in (*WINDOW_KEYS, "batch")]
    newest = versions.groupBy(*WINDOW_KEYS).agg(F.max_by(F.struct(*rest), "_version").alias("s"))
    return KINDS[kind][1](newest.select(*WINDOW_KEYS, "s.*"))


def state_schema(silver: DataFrame, kind: str, minutes: int = S.WINDOW_MINUTES):
    """Schema of the stored windows of Silver rows of a kind."""
    return KINDS[kind][0](silver, minutes=minutes).schema.add("batch", "string")
