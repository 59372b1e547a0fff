"""Incremental landing -> Bronze -> Silver -> Gold (ST04-ST06, K05, K06, K08).

The reference re-runs a batch script every N minutes and moves consumed
files aside. Here a file stream with a checkpoint does both: each landing
file is ingested exactly once (the checkpoint records it, `cleanSource`
archives it), `trigger(availableNow=True)` turns it into a scheduled batch
run, and every micro-batch recomputes only the batch dates it touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid import schemas as S
from pulsegrid.functions.scalars import time_parts
from pulsegrid.operators.clean import to_envelope
from pulsegrid.plans.etl import EtlResult, drop_run, run_staged, stage_landing
from pulsegrid.sinks.files import run_logged
from pulsegrid.sources.files import LANDING_GLOB, PARTITION_COLS, delete_path, path_exists, touch_path


# a micro-batch takes about this much of a backlog unless the caller says otherwise
MAX_BYTES_PER_TRIGGER = 64 << 30


def landing_stream(spark: SparkSession, landing: str, archive_dir: str | None = None,
                   max_files_per_trigger: int | None = None, glob: str = LANDING_GLOB,
                   max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> DataFrame:
    """New landing files as a stream of text lines with their file path. A
    micro-batch is bounded by bytes (at least one file), whatever the number
    and the sizes of the waiting files; with ``max_files_per_trigger`` by their
    number instead."""
    r = (spark.readStream.format("text").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob))
    if archive_dir:  # K08: consumed files are moved aside (after a later batch commits)
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.load(landing).withColumn("source_file", F.col("_metadata.file_path"))


def ingest_landing(spark: SparkSession, landing: str, base: str, checkpoint: str,
                   archive_dir: str | None = None, min_records: int = 1,
                   batch_date: str | Column | None = None, fall_threshold: float = S.FALL_SVM_THRESHOLD,
                   minutes: int = S.WINDOW_MINUTES, available_now: bool = True,
                   interval: str = "10 minutes", max_files_per_trigger: int | None = None,
                   glob: str = LANDING_GLOB, max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    """Start the incremental medallion job (ST04).

    With ``available_now`` it processes everything new and stops (the
    scheduled-run mode); otherwise it runs every ``interval``.
    ``max_bytes_per_trigger`` cuts a backlog into micro-batches of about that
    size (``max_files_per_trigger``: of that many files). A stream cannot leave files for later: lines that no layer takes
    are kept in `{base}/_quarantine`.
    """
    lines = landing_stream(spark, landing, archive_dir, max_files_per_trigger, glob, max_bytes_per_trigger)

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = micro_batch_run_id(spark, batch_id)
        done = f"{base}/_done/{run_id}"
        note = f"{base}/_pending/{run_id}"

        def finish() -> None:
            touch_path(spark, done)
            delete_path(spark, note)
            if batch_id >= KEEP_DONE_MARKERS:  # only the newest batch can be replayed
                delete_path(spark, f"{base}/_done/{micro_batch_run_id(spark, batch_id - KEEP_DONE_MARKERS)}")

        if path_exists(spark, done):
            # a replay: this micro-batch wrote every layer, but the query
            # stopped before committing it to the checkpoint
            return
        earlier = []
        if path_exists(spark, note):
            # an earlier attempt noted its dates; the run log (written last)
            # tells whether it completed or stopped part-way
            if run_logged(spark, base, run_id):
                finish()
                return
            earlier = drop_run(spark, base, run_id, [r[0] for r in spark.read.schema("d string").json(note).collect()])
        staged = stage_landing(batch, run_id, batch_date)
        try:
            # the dates this batch writes are noted before its first write
            dates = [batch_date] if isinstance(batch_date, str) else sorted(staged.seen["dates"])
            spark.createDataFrame([(d,) for d in sorted({*dates, *earlier})], "d string").coalesce(1).write.mode(
                "overwrite").json(note)
            res = EtlResult(run_id, sorted(earlier))
            run_staged(staged, base, res, min_records, fall_threshold, minutes, defer=False,
                       batch_date=batch_date if isinstance(batch_date, str) else None)
            finish()
        finally:
            staged.remove()

    w = lines.writeStream.queryName("landing_ingest").option("checkpointLocation", checkpoint).foreachBatch(each)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


# done markers of this many recent micro-batches are kept (a restart can only
# replay the newest one)
KEEP_DONE_MARKERS = 10


def micro_batch_run_id(spark: SparkSession, batch_id: int) -> str:
    """Run id of a micro-batch: stable when the batch is replayed after a
    restart (the query id is kept in the checkpoint), distinct between
    queries."""
    qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
    return f"{qid[:8]}-b{batch_id:06d}"


def land_stream(kafka: DataFrame, base: str, kind: str, checkpoint: str,
                interval: str = "10 minutes", available_now: bool = False) -> StreamingQuery:
    """Kafka records -> JSON-Lines landing files in processing-time Hive
    partitions (K05). A batch is flushed every ``interval``; for "N records or
    the interval, whichever first" and files of at most N records (K06) see
    ``streaming.landing``. Failed batches are retried from the
    checkpoint, so nothing is dropped or ingested twice. ``available_now``
    lands what is there and stops."""
    out = envelope_lines(kafka).withColumns(time_parts(F.current_timestamp()))
    w = (out.writeStream.format("text").outputMode("append")
         .partitionBy(*PARTITION_COLS)
         .option("path", f"{base}/{kind}").option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def envelope_lines(kafka: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Kafka records -> landing lines (P04), column `value`: an envelope object
    that holds the message as received. A JSON object is put in unchanged
    (only line breaks between its parts become spaces); anything else becomes
    a JSON string, which the landing readers report as malformed, so a broken
    message is neither lost nor taken for an empty event. ``keep`` names
    columns of the record to keep; `broken` says whether it is no object."""
    more = [c for c in keep if c != "broken"]
    env = to_envelope(kafka, more)
    text = F.col("value").cast("string")
    is_object = F.from_json(text, "map<string,string>").isNotNull()
    head = F.to_json(F.struct("offset", "partition", "timestamp", "key"), {"ignoreNullFields": "false"})
    broken = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("value")))
    body = F.when(is_object, F.concat(F.lit('"value":'), F.regexp_replace(text, r"[\r\n]+", " "), F.lit("}"))).otherwise(
        F.substr(broken, F.lit(2)))
    line = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(","), body).alias("value")
    return env.select(line, *[~is_object if c == "broken" else F.col(c) for c in keep]).toDF("value", *keep)
