"""Real-time alerting with Structured Streaming (ST01-ST03, S03, S04, K03, K04).

The rule functions are the batch ones: a streaming frame goes through the
same single-pass explode, so there is no state, no shuffle and no watermark
to tune. One read of the source feeds all sinks through `foreachBatch`.

Replays. A query that stops after a sink's write and before its checkpoint
commit processes that micro-batch again. ``AlertOutbox`` makes this harmless:
each micro-batch is first written to a folder of its own, named by query and
batch, and never rewritten once whole; every sink is then fed from that folder
and marked, so a replay feeds only sinks without a mark. What remains is a stop
between a sink's write and its mark. For that, an alert has an id made of its
message's topic, partition and offset and of the alert type: it travels as a
Kafka header, and consumers drop what they have seen (``received_alerts``). The
outbox itself (``published_alerts``) holds every alert exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid import schemas as S
from pulsegrid.functions.scalars import svm
from pulsegrid.operators import alerts as AL
from pulsegrid.operators.clean import parse_value
from pulsegrid.sources.files import child_folders, delete_path, path_exists, touch_path


def read_kafka(spark: SparkSession, bootstrap: str, topics: list[str], starting_offsets: str = "latest",
               fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None,
               min_offsets_per_trigger: int | None = None, max_trigger_delay: str | None = None) -> DataFrame:
    """Kafka topics as one stream (S03/S04): key, value, topic, partition,
    offset, timestamp. There is no rate cap unless one is given (a source
    option; it has no effect as a session setting), and records that expired
    before they were read stop the query rather than go missing.

    ``min_offsets_per_trigger`` with ``max_trigger_delay`` gives the landing
    flush rule "N records or the interval, whichever comes first" (K06): with
    a short trigger, a batch runs once N records are waiting, or once the
    delay has passed with any data."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_offsets_per_trigger:
        r = r.option("minOffsetsPerTrigger", str(min_offsets_per_trigger))
        r = r.option("maxTriggerDelay", max_trigger_delay or "10m")
    return r.load()


ORIGIN = ["topic", "partition", "offset"]  # what tells one message from all others


def route_topics(kafka: DataFrame, schemas: dict[str, object], keep: list[str] | None = None) -> dict[str, DataFrame]:
    """One typed frame per topic from a multi-topic subscription."""
    return {t: parse_value(kafka.filter(F.col("topic") == t), sch, keep=keep or ["topic"])
            for t, sch in schemas.items()}


DEFAULT_TOPICS = {"raw_vitals": S.VITALS_SCHEMA, "raw_movement": S.MOVEMENT_SCHEMA}


def vitals_alert_stream(kafka: DataFrame, t: S.AlertThresholds = S.STANDARD, topic: str = "raw_vitals",
                        schema=S.VITALS_SCHEMA, origin: bool = False) -> DataFrame:
    """Alerts of the vitals topic (ST01); with ``origin`` also the alert's id
    and the message it comes from."""
    keep = ORIGIN if origin else []
    vit = route_topics(kafka, {topic: schema}, ORIGIN if origin else None)[topic]
    return _identified(AL.vitals_alerts(_stamped(vit), t, keep), origin)


def movement_alert_stream(kafka: DataFrame, t: S.AlertThresholds = S.STANDARD, topic: str = "raw_movement",
                          schema=S.MOVEMENT_SCHEMA, origin: bool = False) -> DataFrame:
    """Alerts of the movement topic (ST02). Events without a pre-computed
    magnitude get one from their axes."""
    keep = ORIGIN if origin else []
    mov = _stamped(route_topics(kafka, {topic: schema}, ORIGIN if origin else None)[topic])
    mov = mov.withColumn("svm", F.coalesce(F.col("svm"), svm()))
    return _identified(AL.movement_alerts(mov, t, keep), origin)


def alert_stream(kafka: DataFrame, t: S.AlertThresholds = S.STANDARD,
                 topics: dict[str, object] | None = None, origin: bool = False) -> DataFrame:
    """Alerts of both topics (ST01 + ST02 + U01)."""
    (v, v_schema), (m, m_schema) = (topics or DEFAULT_TOPICS).items()
    return AL.union_alerts(vitals_alert_stream(kafka, t, v, v_schema, origin), movement_alert_stream(kafka, t, m, m_schema, origin))


def _stamped(df: DataFrame) -> DataFrame:
    """A reading without its own time is stamped with the processing time."""
    return df.withColumn("timestamp", F.coalesce("timestamp", F.unix_micros(F.current_timestamp()) / 1e6))


def _identified(alerts: DataFrame, origin: bool) -> DataFrame:
    return alerts.withColumn("alert_id", F.concat_ws("-", *ORIGIN, "alert_type")) if origin else alerts


def kafka_records(alerts: DataFrame) -> DataFrame:
    """Alerts in the Kafka sink layout: key = patient, value = JSON (R07), and
    the alert's id as a header where it has one."""
    if "alert_id" not in alerts.columns:
        return AL.encode_alerts(alerts)
    head = F.array(F.struct(F.lit(ID_HEADER).alias("key"), F.col("alert_id").cast("binary").alias("value")))
    return AL.encode_alerts(alerts, head.alias("headers"))


ID_HEADER = "alert_id"


def received_alerts(records: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Alerts read from the topic (records with headers), each id once: a
    streaming frame remembers the ids of the last ``delay`` of broker time
    (state that the watermark clears), a batch frame drops all repeats."""
    ident = F.element_at(F.filter("headers", lambda h: h["key"] == ID_HEADER), 1)["value"].cast("string")
    df = records.select(F.col("timestamp").alias("sent_at"), ident.alias("alert_id"),
                        F.from_json(F.col("value").cast("string"), S.ALERT_SCHEMA).alias("a"))
    if df.isStreaming:
        df = df.withWatermark("sent_at", delay).dropDuplicatesWithinWatermark(["alert_id"])
    else:
        df = df.dropDuplicates(["alert_id"])
    return df.select("alert_id", "a.*")


class AlertOutbox:
    """Micro-batches of alerts in `{root}/query=<id>/batch=<n>`, each written
    whole once, and the marks of the sinks that have had them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def save(self, batch: DataFrame, query: str, batch_id: int) -> DataFrame:
        """The micro-batch as stored: written now, or by the attempt before a
        restart (whose rows then stand, with their processing times)."""
        folder = self.folder(query, batch_id)
        if not path_exists(self.spark, f"{folder}/{READY}"):
            batch.write.mode("overwrite").parquet(folder)
            touch_path(self.spark, f"{folder}/{READY}")
        return self.spark.read.schema(batch.schema).parquet(folder)

    def folder(self, query: str, batch_id: int) -> str:
        return f"{self.root}/query={query}/batch={batch_id:09d}"

    def feed(self, saved: DataFrame, query: str, batch_id: int, sinks: Mapping[str, Callable[[DataFrame], None]]) -> None:
        """Hand a stored micro-batch to every sink that has not had it."""
        for name, sink in sinks.items():
            mark = f"{self.folder(query, batch_id)}/_sent_{name}"
            if not path_exists(self.spark, mark):
                sink(saved)
                touch_path(self.spark, mark)

    def batches(self) -> list[str]:
        """Folders of the micro-batches that are whole."""
        found = [f"{self.root}/{q}/{b}" for q in child_folders(self.spark, self.root) for b in child_folders(self.spark, f"{self.root}/{q}")]
        return [f for f in found if path_exists(self.spark, f"{f}/{READY}")]

    def forget(self, query: str, before: int) -> None:
        """Remove micro-batches older than number ``before`` (a restart replays
        the newest one at most)."""
        for b in child_folders(self.spark, f"{self.root}/query={query}"):
            if int(b.split("=")[1]) < before:
                delete_path(self.spark, f"{self.root}/query={query}/{b}")


READY = "_ready"


def published_alerts(spark: SparkSession, root: str, schema) -> DataFrame:
    """All alerts of an outbox, each exactly once."""
    folders = AlertOutbox(spark, root).batches()
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def write_alerts_kafka(batch: DataFrame, bootstrap: str, topic: str = "critical_alerts") -> None:
    """Publish one micro-batch of alerts."""
    (kafka_records(batch).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def console(batch: DataFrame, n: int = 20) -> None:
    """Console mirror of a micro-batch."""
    batch.show(n, truncate=False)


def start_alert_query(alerts: DataFrame, checkpoint: str,
                      sinks: list[Callable[[DataFrame], None]] | Mapping[str, Callable[[DataFrame], None]],
                      trigger: dict | None = None, name: str = "alerts", outbox: str | None = None,
                      keep_batches: int | None = None) -> StreamingQuery:
    """Run the alert stream once into several sinks (ST03). The checkpoint makes
    the query restartable after executor or driver loss.

    With ``outbox`` (a shared folder) each micro-batch is stored there and every
    sink (by name) is fed from the stored rows, once (see the module docstring);
    with ``keep_batches`` older ones are removed. Without it a micro-batch for
    more than one sink is persisted, handed to every sink and released, and a
    replayed one is handed out again."""
    named = dict(sinks) if isinstance(sinks, Mapping) else {str(i): s for i, s in enumerate(sinks)}
    spark = alerts.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        if outbox is not None:
            query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or name
            box = AlertOutbox(spark, outbox)
            box.feed(box.save(batch, query, batch_id), query, batch_id, named)
            if keep_batches is not None:
                box.forget(query, batch_id - keep_batches + 1)
            return
        if len(named) == 1:
            next(iter(named.values()))(batch)
            return
        batch.persist()
        try:
            for sink in named.values():
                sink(batch)
        finally:
            batch.unpersist()

    w = alerts.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
