"""Scoring snapshots as their completion messages arrive."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stagetally.functions.events import (
    DEFAULT_NAMESPACE,
    RESCORE_ALL,
    SNAPSHOT_COMPLETED,
    count_total,
    event_type,
    parse_event,
)
from stagetally.functions.snapshots import parse_snapshot_id, readable_snapshot_id
from stagetally.plans.score import rescore_all, score_snapshots
from stagetally.sources.warehouse import Warehouse


def read_messages(spark: SparkSession, source: str, fmt: str = "text", **options: str) -> DataFrame:
    """Streaming messages in a ``value`` column: text files, or Kafka where its jar is present."""
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(source) if fmt != "kafka" else reader.option("subscribe", source).load()
    return df.select(F.col("value").cast("string").alias("value"))


def route_events(messages: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """What to do with each message: score, rescore_all, ignore or invalid.

    A completed snapshot whose id is missing or unreadable is invalid.
    Works on a batch and on a stream; the event type is kept for all of them.
    """
    event = messages.select(parse_event(F.col("value")).alias("event"))
    kind = F.col("event.type")
    snapshot = F.col("event.data.snapshot_id")
    route = _route(F.col("event"), namespace)
    announced = F.coalesce(count_total(F.col("event.data.data_tables")), F.lit(0).cast("bigint"))
    return event.select(
        route.alias("route"),
        F.coalesce(kind, F.lit("unknown")).alias("event_type"),
        snapshot.alias("snapshot_id"),
        announced.alias("records"),
    )


def _route(event: Column, namespace: str) -> Column:
    kind = event["type"]
    readable = readable_snapshot_id(event["data"]["snapshot_id"]).isNotNull()
    return (
        F.when(event.isNull(), "invalid")
        .when(kind == event_type(RESCORE_ALL, namespace), "rescore_all")
        .when((kind == event_type(SNAPSHOT_COMPLETED, namespace)) & readable, "score")
        .when(kind == event_type(SNAPSHOT_COMPLETED, namespace), "invalid")
        .otherwise("ignore")
    )


def requests(messages: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """The messages that ask for a scoring, unchanged; all others change nothing."""
    # Over an array of one, so that a message is parsed once however often the rules name it.
    asks = F.exists(F.array(parse_event(F.col("value"))), lambda event: _route(event, namespace).isin("score", "rescore_all"))
    return messages.filter(asks)


def deduplicated(messages: DataFrame, within: str) -> DataFrame:
    """A stream of messages without those that were delivered before, ``within`` that time.

    A message is known by the digest of its bytes, and its time is that of its
    arrival, so no message is ever late.  The digests are kept in the stream's
    state, which a restart reads again, until they are older than ``within``.
    """
    return (
        messages.withColumns({"_id": F.sha2(F.col("value"), 256), "_arrived": F.current_timestamp()})
        .withWatermark("_arrived", within)
        .dropDuplicatesWithinWatermark(["_id"])
        .drop("_id", "_arrived")
    )


def handle_batch(
    batch: DataFrame, warehouse: Warehouse, namespace: str = DEFAULT_NAMESPACE, batch_name: str | None = None
) -> None:
    """Score the snapshots a micro-batch names.

    Delivery is at least once: ids are deduplicated here and scoring replaces
    its snapshots, so a repeated batch changes nothing.  With a ``batch_name``,
    which is kept in the log, snapshots that were scored by the very batch
    before it was cut off are not scored again.  Only distinct snapshot ids
    reach the driver.
    """
    snapshot = parse_snapshot_id(readable_snapshot_id(F.col("snapshot_id")))
    routed = (
        route_events(batch, namespace)
        .filter(F.col("route").isin("score", "rescore_all"))
        .groupBy("route", snapshot.cast("string").alias("id"))
        .agg(F.max("records").alias("records"))
        .orderBy("id")
        .collect()
    )
    if any(r["route"] == "rescore_all" for r in routed):
        rescore_all(warehouse, message_id=batch_name, batch_name=batch_name)
    wanted = {r["id"]: r["records"] for r in routed if r["route"] == "score" and r["id"] is not None}
    if wanted:
        score_snapshots(warehouse, wanted, processed=wanted, batch_name=batch_name)


def score_on_event(
    messages: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    namespace: str = DEFAULT_NAMESPACE,
    available_now: bool = False,
    redelivered_within: str | None = "1 day",
) -> StreamingQuery:
    """Start the scoring stream; ``checkpoint`` keeps its place over restarts.

    A message that is delivered again within ``redelivered_within``, in the
    same micro-batch or another, is scored once.  Only messages that ask for a
    scoring reach the stream's state.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    if redelivered_within:
        messages = deduplicated(requests(messages, namespace), redelivered_within)
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: handle_batch(batch, warehouse, namespace, f"stream {stream}, batch {number}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def publish_events(
    events: DataFrame, target: str, checkpoint: str | None = None, available_now: bool = True
) -> StreamingQuery | None:
    """Write envelope rows (``value``) to a text sink, as a stream (which needs a checkpoint) or as a batch."""
    if not events.isStreaming:
        events.select("value").write.mode("append").text(target)
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = (
        events.select("value")
        .writeStream.format("text")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
