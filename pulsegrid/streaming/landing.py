"""Buffered landing of Kafka topics.

``land_buffered`` keeps the flush rule "N records or the interval, whichever
comes first" for each topic, whatever the source's micro-batches look like, and
no landed file holds more than N records. Micro-batches are stored in a buffer
folder first. A topic is flushed once its waiting records number N or its oldest
one has waited for the interval: the waiting micro-batches become files under
`{base}/{topic}/year=/month=/day=/hour=/minute=` (the time the flush began). A
flush that fails leaves its records in the buffer for the next micro-batch.

Every step can be repeated: a stored micro-batch counts once its note exists
and is not stored again; a flush notes its range of micro-batches before it
writes, writes its files aside, then renames them one by one, and is taken up
again at the same range after a stop. So a restart neither loses nor repeats a
record. One query owns a buffer.

Counters per topic (``stream_counters``) come from small files named after the
micro-batch or flush they count, so repeating a step repeats none of them.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.sources.files import child_files, delete_path, move_file, path_exists, read_small, side_by_side, touch_path, write_small
from pulsegrid.streaming.ingest import envelope_lines

ROWS = "value string, broken boolean, topic string"
COUNTERS = "topic string, consumed long, broken long, landed long, failed_flushes long"


class LandingBuffer:
    """Records that wait to be landed, in `{root}`, and their landing tree `{base}`."""

    def __init__(self, spark: SparkSession, root: str, base: str, max_records: int = 1000, interval: float = 600,
                 max_failures: int = 3, clock: Callable[[], float] = time.time):
        if max_records < 1:
            raise ValueError("max_records must be at least 1")
        self.spark, self.root, self.base = spark, root, base
        self.max_records, self.interval, self.max_failures, self.clock = max_records, interval, max_failures, clock

    # --- storing -----------------------------------------------------------------
    def store(self, batch: DataFrame, batch_id: int) -> None:
        """Keep a micro-batch of Kafka records; its note, written last, holds
        the number of records of each topic."""
        note = f"{self.root}/notes/{batch_id:09d}.json"
        if read_small(self.spark, note) is not None:
            return
        folder = f"{self.root}/rows/batch={batch_id:09d}"
        envelope_lines(batch, ["broken", "topic"]).write.mode("overwrite").parquet(folder)
        found = self.spark.read.schema(ROWS).parquet(folder).groupBy("topic").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("broken")).collect()
        topics = {r["topic"]: {"n": r["n"], "broken": r["broken"]} for r in found}
        self._count(f"batch-{batch_id:09d}", [{"topic": t, "consumed": x["n"], "broken": x["broken"]} for t, x in topics.items()])
        write_small(self.spark, note, json.dumps({"at": self.clock(), "topics": {t: x["n"] for t, x in topics.items()}}))

    def waiting(self) -> dict[str, list[tuple[int, int, float]]]:
        """Per topic (micro-batch, records, time) of what is not landed yet."""
        out: dict[str, list[tuple[int, int, float]]] = {}
        for name in child_files(self.spark, f"{self.root}/notes"):
            batch_id = int(name.split(".")[0])
            note = json.loads(read_small(self.spark, f"{self.root}/notes/{name}"))
            for topic, n in note["topics"].items():
                if batch_id > self._through(topic):
                    out.setdefault(topic, []).append((batch_id, n, note["at"]))
        return {t: sorted(x) for t, x in out.items()}

    def _through(self, topic: str) -> int:
        """Newest micro-batch of a topic that is landed (-1: none)."""
        note = read_small(self.spark, f"{self.root}/landed/{_safe(topic)}.json")
        return json.loads(note)["through"] if note else -1

    # --- flushing ------------------------------------------------------------------
    def due(self, waiting: list[tuple[int, int, float]]) -> bool:
        return bool(waiting) and (sum(n for _, n, _ in waiting) >= self.max_records
                                  or self.clock() - min(at for _, _, at in waiting) >= self.interval)

    def flush_due(self, everything: bool = False) -> dict[str, int]:
        """Land the topics whose turn it is (all of them, to empty the buffer);
        returns the records landed per topic. A flush that fails is counted and
        left for later; after ``max_failures`` in a row its error is raised."""
        landed, failed = {}, set()
        for name in child_files(self.spark, f"{self.root}/flushing"):  # begun before, and not ended
            topic = json.loads(read_small(self.spark, f"{self.root}/flushing/{name}"))["topic"]
            n = self._attempt(topic)
            if n is None:
                failed.add(topic)
            else:
                landed[topic] = n
        for topic, waiting in self.waiting().items():
            if topic not in failed and (everything or self.due(waiting)):
                n = self._attempt(topic, waiting)
                if n is not None:
                    landed[topic] = landed.get(topic, 0) + n
        self._forget()
        return landed

    def _attempt(self, topic: str, waiting: list[tuple[int, int, float]] | None = None) -> int | None:
        try:
            n = self._flush(topic, waiting)
        except Exception:
            self._count(f"failed-{_safe(topic)}-{uuid.uuid4().hex}", [{"topic": topic, "failed_flushes": 1}])
            failures = f"{self.root}/failures/{_safe(topic)}"
            in_a_row = int(read_small(self.spark, failures) or 0) + 1
            write_small(self.spark, failures, str(in_a_row))
            if in_a_row >= self.max_failures:
                raise
            return None
        delete_path(self.spark, f"{self.root}/failures/{_safe(topic)}")
        return n

    def _flush(self, topic: str, waiting: list[tuple[int, int, float]] | None) -> int:
        name = _safe(topic)
        intent = f"{self.root}/flushing/{name}.json"
        begun = read_small(self.spark, intent)
        if begun is None:
            plan = {"topic": topic, "batches": [b for b, _, _ in waiting], "n": sum(n for _, n, _ in waiting), "at": self.clock()}
            write_small(self.spark, intent, json.dumps(plan))
        else:
            plan = json.loads(begun)
        first, last = plan["batches"][0], plan["batches"][-1]
        aside = f"{self.root}/aside/{name}"
        if self._through(topic) < last:
            if not path_exists(self.spark, f"{aside}/_ready"):
                self.write_files(topic, plan["batches"], plan["n"], aside)
                touch_path(self.spark, f"{aside}/_ready")
            when = dt.datetime.fromtimestamp(plan["at"], dt.timezone.utc)
            folder = f"{self.base}/{name}/" + when.strftime("year=%Y/month=%m/day=%d/hour=%H/minute=%M")
            side_by_side(lambda f: move_file(self.spark, f"{aside}/{f}", f"{folder}/{first:09d}-{last:09d}-{f.split('.')[0]}.json"),
                         child_files(self.spark, aside))
            self._count(f"flush-{name}-{last:09d}", [{"topic": topic, "landed": plan["n"]}])
            write_small(self.spark, f"{self.root}/landed/{name}.json", json.dumps({"through": last}))
        delete_path(self.spark, aside)
        delete_path(self.spark, intent)
        return plan["n"]

    def write_files(self, topic: str, batches: list[int], n: int, folder: str) -> None:
        """The waiting records of a topic as text files of at most
        ``max_records`` lines."""
        rows = self.spark.read.schema(ROWS).parquet(*[f"{self.root}/rows/batch={b:09d}" for b in batches])
        (rows.where(F.col("topic") == topic).select("value").coalesce(-(-n // self.max_records))
         .write.mode("overwrite").option("maxRecordsPerFile", self.max_records).text(folder))

    def _forget(self) -> None:
        """Remove micro-batches that are landed for all their topics, but the
        newest (a restart may hand it in again)."""
        notes = sorted(child_files(self.spark, f"{self.root}/notes"))
        through: dict[str, int] = {}
        for name in notes[:-1]:
            topics = json.loads(read_small(self.spark, f"{self.root}/notes/{name}"))["topics"]
            for t in topics:
                through.setdefault(t, self._through(t))
            batch_id = int(name.split(".")[0])
            if all(through[t] >= batch_id for t in topics):
                delete_path(self.spark, f"{self.root}/rows/batch={batch_id:09d}")
                delete_path(self.spark, f"{self.root}/notes/{name}")

    def _count(self, name: str, rows: list[dict]) -> None:
        write_small(self.spark, f"{self.base}/_stream_log/{name}.json", "".join(json.dumps(r) + "\n" for r in rows))


def _safe(topic: str) -> str:
    """A topic's name as a folder's."""
    return quote(topic, safe="")


def stream_counters(spark: SparkSession, base: str) -> DataFrame:
    """Per topic: records consumed, of these broken (no JSON object; landed as
    received), records landed, and flushes that failed (K09)."""
    if not path_exists(spark, f"{base}/_stream_log"):
        return spark.createDataFrame([], COUNTERS)
    log = spark.read.schema(COUNTERS).json(f"{base}/_stream_log")
    names = ("consumed", "broken", "landed", "failed_flushes")
    return log.groupBy("topic").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def land_buffered(kafka: DataFrame, buffer: LandingBuffer, checkpoint: str, poll: str = "10 seconds",
                  available_now: bool = False) -> StreamingQuery:
    """Kafka records (several topics) -> landing files by the buffer's flush
    rule. The rule is applied with every micro-batch; a source that has gone
    quiet gives none, so call ``buffer.flush_due()`` from the scheduler too, and
    ``buffer.flush_due(everything=True)`` when the stream is shut down."""
    def each(batch: DataFrame, batch_id: int) -> None:
        buffer.store(batch, batch_id)
        buffer.flush_due()

    w = kafka.writeStream.queryName("landing_buffer").option("checkpointLocation", checkpoint).foreachBatch(each)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=poll)).start()
