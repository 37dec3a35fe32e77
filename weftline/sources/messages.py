"""Messages in: read bodies, parse the envelope, flatten batches to payload rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.functions import json_text as J
from weftline.operators import guards
from weftline.session import once


def read_messages(
    spark: SparkSession,
    path: str,
    format: str = "text",
    id_column: str = "message_id",
    body_column: str = "body",
    correlation_column: str | None = None,
    **options: str,
) -> DataFrame:
    """Request documents as ``message_id, body, correlation_id``.

    ``text`` reads one document per file and names it by its path. Any other
    format is read as a table that has an id and a string column.
    """
    if format == "text":
        frame = spark.read.options(**options).text(path, wholetext=True)
        return frame.select(
            F.col("_metadata.file_path").alias("message_id"),
            F.col("value").alias("body"),
            F.lit(None).cast("string").alias("correlation_id"),
        )
    frame = spark.read.format(format).options(**options).load(path)
    return messages_from_table(frame, id_column, body_column, correlation_column)


def messages_from_table(
    frame: DataFrame, id_column: str = "message_id", body_column: str = "body", correlation_column: str | None = None
) -> DataFrame:
    correlation = F.col(correlation_column) if correlation_column else F.lit(None)
    return frame.select(
        F.col(id_column).alias("message_id"),
        F.col(body_column).cast("string").alias("body"),
        correlation.cast("string").alias("correlation_id"),
    )


def stream_messages(spark: SparkSession, format: str, options: dict[str, str], schema=None) -> DataFrame:
    """Queue source: any streaming format whose rows have an id and a body.

    Kafka rows get their id from topic, partition and offset.
    """
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.load()
    if format == "kafka":
        return frame.select(
            F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
            F.col("value").cast("string").alias("body"),
            F.lit(None).cast("string").alias("correlation_id"),
        )
    correlation = "correlation_id" if "correlation_id" in frame.columns else None
    return messages_from_table(frame, correlation_column=correlation)


def parse_batches(messages: DataFrame, options: Options = Options(), channel: str = "request") -> DataFrame:
    """Parse envelopes and run all message guards; nothing is dropped.

    Adds ``payloads`` (an array of member maps, one per payload; null when refused),
    ``max_depth``, ``guard_status`` and ``guard_error``.
    """
    members = F.col("_members")
    parsed = (
        messages.withColumn("_members", J.document(guards.readable(F.col("body"), options, channel)))
        .withColumn(
            "payloads",
            F.when(J.kind_of_member(members, "payloads") == "array", J.bags(J.raw_of(members, "payloads"))),
        )
        .withColumn("max_depth", J.raw_of(members, "maxlookupdepth").try_cast("int"))
    )
    guarded = guards.apply_message_guards(parsed, options, channel)
    kept = guarded.withColumn("payloads", F.when(F.col("guard_status").isNull(), F.col("payloads"))).drop("_members")
    return once(kept, "payloads", "max_depth", "guard_status", "guard_error")


def explode_payloads(batches: DataFrame, keep_refused: bool = False) -> DataFrame:
    """One row per payload, numbered by its place in the batch. Null payloads stay rows.

    With ``keep_refused`` every row also carries its message's correlation id and guard
    columns, and a refused message is one row without ``idx``.
    """
    about = ["correlation_id", "guard_status", "guard_error"] if keep_refused else []
    # The outer form, because the inner one makes the optimizer test for empty arrays first,
    # which would parse every body twice.
    rows = batches.select(
        "message_id", *about, F.col("max_depth").alias("_batch_depth"), F.posexplode_outer("payloads").alias("idx", "m")
    )
    payloads = rows.select("message_id", "idx", *about, *_payload_columns(F.col("m"), F.col("_batch_depth")))
    return payloads if keep_refused else payloads.where(F.col("idx").isNotNull())


def _payload_columns(m: Column, batch_depth: Column) -> list[Column]:
    return [
        m.isNull().alias("is_null"),
        J.raw_of(m, "entitylogicalname").alias("entity"),
        F.lower(J.raw_of(m, "id")).alias("id"),
        J.bag(J.raw_of(m, "keyattributes")).alias("keys"),
        J.bag(J.raw_of(m, "attributes")).alias("attrs"),
        J.raw_of(m, "sourcesystem").alias("source"),
        J.raw_of(m, "lookups").alias("lookups"),
        # A payload without its own depth takes the one of the batch.
        F.coalesce(J.raw_of(m, "maxlookupdepth").try_cast("int"), batch_depth).alias("max_depth"),
    ]
