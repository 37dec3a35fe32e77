"""Redelivery by timers: a message waits as keyed state and is tried again although nothing new arrives.

The state of a message is its body and how often it was delivered. A message is delivered when it
arrives and again whenever its timer ends, until the batch that worked on it reports it settled
or it was delivered ``max_deliveries`` times. Reports come back as a second input of the same
query, from the folder the batches write them to, so a report is seen before the next timer.
State is spread by message id; a message whose id arrives again while it waits is the same one.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from weftline.catalog import Catalog
from weftline.config import Options
from weftline.session import configure, cut_lineage
from weftline.sources import sinks
from weftline.streaming.upsert_stream import StreamTargets, work

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Waiting(StatefulProcessor):
    """State and timer of one message."""

    def __init__(self, max_deliveries: int, wait_ms: int):
        self.max_deliveries, self.wait_ms = max_deliveries, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "message_id string, body string, correlation_id string, delivered int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        settled, message = False, None
        for row in rows:
            settled, message = settled or row["settled"], message if row["settled"] else row
        if settled:
            self.waiting.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        elif message is not None and not self.waiting.exists():
            yield self._deliver(message["message_id"], message["body"], message["correlation_id"], 0, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.waiting.exists():
            message_id, body, correlation_id, delivered = self.waiting.get()
            yield self._deliver(message_id, body, correlation_id, delivered, timerValues)

    def _deliver(self, message_id, body, correlation_id, delivered, timerValues) -> Row:
        if delivered + 1 < self.max_deliveries:
            self.waiting.update((message_id, body, correlation_id, delivered + 1))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        else:
            self.waiting.clear()
        return Row(message_id=message_id, body=body, correlation_id=correlation_id, attempt=delivered)

    def close(self) -> None:
        pass


def deliveries(messages: DataFrame, settled: DataFrame, max_deliveries: int, wait_seconds: float) -> DataFrame:
    """Stream of (message_id, body, correlation_id, attempt); ``attempt`` counts earlier deliveries.

    ``settled`` is a stream of message ids that need no further delivery.
    """
    kind = messages.schema["message_id"].dataType
    inputs = messages.select(
        F.col("message_id").cast("string").alias("message_id"), "body", "correlation_id", F.lit(False).alias("settled")
    ).unionByName(
        settled.select(
            F.col("message_id").cast("string").alias("message_id"), F.lit(None).cast("string").alias("body"),
            F.lit(None).cast("string").alias("correlation_id"), F.lit(True).alias("settled"),
        )
    )
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("message_id", "body", "correlation_id")] + [T.StructField("attempt", T.IntegerType())])
    out = inputs.groupBy("message_id").transformWithState(
        statefulProcessor=Waiting(max_deliveries, int(1000 * wait_seconds)), outputStructType=schema, outputMode="append", timeMode="processingTime"
    )
    return out.withColumn("message_id", F.col("message_id").cast(kind))


def start_redelivering_stream(
    stream: DataFrame,
    where: StreamTargets,
    catalog: Catalog,
    checkpoint: str,
    options: Options = Options(),
    wait_seconds: float = 30.0,
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Upsert the messages of ``stream``, each up to ``options.max_deliveries`` times, ``wait_seconds`` apart.

    ``partitions`` is how many parts state and batches have, the session's number if not given; a
    checkpoint keeps it for good. Every part costs a little in every batch, also in empty ones.
    """
    spark = configure(stream.sparkSession)
    folder = where.folder("_settled")
    ids = T.StructType([stream.schema["message_id"]])
    if not sinks.finished_versions(spark, folder):
        sinks.write_version(spark.createDataFrame([], ids), folder, 0)
    settled = spark.readStream.schema(ids).option("recursiveFileLookup", "true").parquet(folder)

    def run(batch: DataFrame, batch_id: int) -> None:
        # The state moves on when the batch is read; it is read once.
        due = cut_lineage(batch)
        if due.isEmpty():
            return
        again, _ = work(due, batch_id + 1, where, catalog, options)
        done = due.select("message_id").join(again.select("message_id"), "message_id", "left_anti")
        sinks.write_version(done.distinct(), folder, batch_id + 1)

    out = deliveries(stream, settled, options.max_deliveries, wait_seconds)
    # The query keeps the settings that hold when it starts.
    own = {_STATE_STORE: _ROCKS} | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        writer = out.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def stop_when_settled(query: StreamingQuery, timeout_seconds: float) -> None:
    """Stop ``query`` once nothing new arrives and no message waits, or raise what ended it."""
    quiet, seen, until = 0, -1, time.monotonic() + timeout_seconds
    try:
        while quiet < 3:
            if time.monotonic() > until:
                raise TimeoutError(f"messages still wait after {timeout_seconds} s")
            if not query.isActive:
                raise query.exception() or RuntimeError("the stream has ended")
            now = query.lastProgress
            if now is not None and now["batchId"] != seen:
                seen = now["batchId"]
                waits = sum(s["numRowsTotal"] for s in now["stateOperators"])
                quiet = quiet + 1 if now["numInputRows"] == 0 and waits == 0 else 0
            time.sleep(0.2)
    finally:
        query.stop()
