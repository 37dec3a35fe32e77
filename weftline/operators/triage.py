"""Triage of a table of write failures.

Input ``failures(op_id, node_id, parent_id, op_kind, exc_type, fault_code, message,
retry_after)``: one row per exception, inner exceptions as child rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage

# Fault codes of the record store.
THROTTLING_CODES = (-2147015902, -2147015903, -2147015898, -2147015895)
KEY_CONFLICT_CODES = (-2147220173, -2147086190, -2147220969, -2147086191)
TRANSIENT_CODES = (-2147204783, -2147204784, -2147220970)

# Exception types by what they mean.
VALIDATION_TYPES = (
    "PayloadValidationException", "ArgumentException", "ArgumentNullException", "ArgumentOutOfRangeException",
)
CANCELLATION_TYPES = ("OperationCanceledException", "TaskCanceledException")
TRANSIENT_TYPES = ("TimeoutException", "TimeoutRejectedException", "BrokenCircuitException", "HttpRequestException")
FAULT_TYPE = "FaultException"
PROTOCOL_TYPE = "ProtocolException"
INVALID_OPERATION_TYPES = ("InvalidOperationException", "ObjectDisposedException")
AGGREGATE_TYPE = "AggregateException"

# Texts looked for in messages, ignoring case.
THROTTLE_TEXT = "(?i)rate limit|too many requests|429|throttl"
CONFLICT_TEXT = "(?i)already exists|does not exist|duplicate"
EMPTY_RESPONSE_TEXT = "(?i)response is empty|ThrowIfResponseIsEmpty"
# Of a client that could not be set up; another client says it in other words.
CLIENT_SETUP_TEXT = "failed to connect to the store"

# Which category of a group wins, strongest first.
GROUP_ORDER = ("Cancellation", "Throttling", "Transient", "Validation", "Permanent")


def _says(pattern: str) -> Column:
    return F.coalesce(F.col("message").rlike(pattern), F.lit(False))


def _code(codes: tuple[int, ...]) -> Column:
    return (F.col("exc_type") == FAULT_TYPE) & F.coalesce(F.col("fault_code").isin(*codes), F.lit(False))


def is_throttled() -> Column:
    return _code(THROTTLING_CODES) | _says(THROTTLE_TEXT)


def classify_errors(failures: DataFrame) -> DataFrame:
    """Add ``category`` of every single exception: by type, then fault code, then message."""
    of = F.col("exc_type")
    fault = (
        F.when(_code(THROTTLING_CODES), "Throttling")
        .when(_code(TRANSIENT_CODES), "Transient")
        .when(F.col("fault_code").isNotNull() & _says(THROTTLE_TEXT), "Throttling")
        .otherwise("Permanent")
    )
    invalid_operation = (
        F.when(_says(EMPTY_RESPONSE_TEXT), "Transient").when(_says("(?i)rate limit"), "Throttling").otherwise("Permanent")
    )
    category = (
        F.when(of.isin(*VALIDATION_TYPES), "Validation")
        .when(of.isin(*CANCELLATION_TYPES), "Cancellation")
        .when(of.isin(*TRANSIENT_TYPES), "Transient")
        .when(of == FAULT_TYPE, fault)
        .when((of == PROTOCOL_TYPE) & _says(THROTTLE_TEXT), "Throttling")
        .when(of.isin(*INVALID_OPERATION_TYPES), invalid_operation)
        .otherwise("Permanent")
    )
    return failures.withColumn("category", category)


def _below_aggregates(failures: DataFrame) -> DataFrame:
    """(op_id, parent_id) of aggregates that are the root or stand in the root through aggregates alone.

    Every aggregate points to its parent; a pointer to an aggregate that points on is replaced by
    where that one points to, so the paths halve in every round, however deep causes nest. Paths
    that end at something else, at a missing node, or nowhere (a cycle) do not count.
    """
    aggregates = failures.where(F.col("exc_type") == AGGREGATE_TYPE).select("op_id", "node_id", F.col("parent_id").alias("up")).distinct()
    whole = cut_lineage(aggregates)
    known = whole.select("op_id", F.col("node_id").alias("up"), F.lit(True).alias("_is"))
    state = whole.join(known, ["op_id", "up"], "left").select(
        "op_id", "node_id", F.when(F.col("_is"), F.col("up")).alias("up"), F.col("up").isNull().alias("top")
    )
    # 64 rounds cover any path there can be.
    for _ in range(64):
        if state.where(F.col("up").isNotNull()).isEmpty():
            break
        state = cut_lineage(state)
        above = state.select("op_id", F.col("node_id").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"))
        state = state.join(above, ["op_id", "up"], "left").select(
            "op_id", "node_id", F.col("_up").alias("up"), (F.col("top") | F.coalesce("_top", F.lit(False))).alias("top")
        )
    return state.where("top").select("op_id", F.col("node_id").alias("parent_id"))


def classify_groups(failures: DataFrame) -> DataFrame:
    """Category per operation: that of its root, or for an aggregate the strongest of what it holds.

    What aggregates inside the aggregate hold counts as held by it. A throttle anywhere below an
    aggregate makes the whole operation throttled.
    """
    nodes = classify_errors(failures)
    parents = _below_aggregates(failures).withColumn("_in_aggregate", F.lit(True))
    rank = F.array_position(F.array(*[F.lit(c) for c in GROUP_ORDER]), F.col("category"))
    root = F.col("parent_id").isNull()
    aggregate = F.col("exc_type") == AGGREGATE_TYPE
    member = ~root & ~aggregate & F.coalesce("_in_aggregate", F.lit(False))
    grouped = (
        nodes.join(parents, ["op_id", "parent_id"], "left")
        .groupBy("op_id")
        .agg(
            F.max(F.when(root, F.col("category"))).alias("_own"),
            F.bool_or(root & aggregate).alias("_aggregate"),
            F.bool_or(is_throttled()).alias("_throttled"),
            F.min(F.when(member, rank)).alias("_rank"),
        )
    )
    strongest = F.coalesce(
        F.try_element_at(F.array(*[F.lit(c) for c in GROUP_ORDER]), F.col("_rank").cast("int")), F.lit("Permanent")
    )
    return grouped.select(
        "op_id",
        F.when(~F.col("_aggregate"), F.col("_own"))
        .when(F.col("_throttled"), "Throttling")
        .otherwise(strongest)
        .alias("category"),
    )


def key_conflicts(failures: DataFrame) -> DataFrame:
    """Per operation: did a record appear or vanish under it, anywhere in the chain of causes?"""
    return failures.groupBy("op_id").agg(
        F.bool_or(_code(KEY_CONFLICT_CODES) | _says(CONFLICT_TEXT)).alias("is_key_conflict")
    )


def retryable(failures: DataFrame, setup_text: str = CLIENT_SETUP_TEXT) -> DataFrame:
    """Per operation: may it be sent again? A create only when it surely was not carried out.

    ``setup_text`` is what the client says, in any case, when it could not connect at all: an
    operation that failed so was not carried out. A shorter text than the client's whole phrase
    would call creates safe that are not.
    """
    root = F.col("parent_id").isNull()
    of = F.col("exc_type")
    grouped = failures.groupBy("op_id").agg(
        F.max(F.when(root, F.col("op_kind"))).alias("op_kind"),
        F.max(F.when(root, of)).alias("_type"),
        F.bool_or(is_throttled()).alias("_throttled"),
        F.bool_or(root & F.coalesce(F.contains(F.lower("message"), F.lit(setup_text.lower())), F.lit(False))).alias("_setup"),
        F.bool_or(root & _says(EMPTY_RESPONSE_TEXT)).alias("_empty"),
        F.min(F.when(~root, F.struct("node_id", "exc_type"))).alias("_first_inner"),
    )
    idempotent = F.col("op_kind") != "create"
    of_root = F.col("_type")
    again = (
        F.when(of_root.isin(PROTOCOL_TYPE, FAULT_TYPE), F.col("_throttled"))
        .when(
            of_root.isin(*INVALID_OPERATION_TYPES),
            F.col("_throttled") | F.col("_setup") | (idempotent & F.col("_empty")),
        )
        .when(
            of_root == AGGREGATE_TYPE,
            F.col("_throttled")
            | (idempotent & F.coalesce(F.col("_first_inner.exc_type").isin("TimeoutException", "HttpRequestException"), F.lit(False))),
        )
        .when(of_root.isin("TimeoutException", "HttpRequestException", "TimeoutRejectedException"), idempotent)
        .otherwise(False)
    )
    return grouped.select("op_id", "op_kind", again.alias("retryable"))


def hint_seconds(text: Column) -> Column:
    """Seconds of a retry hint: whole seconds, or ``[days.]hours:minutes[:seconds[.fraction]]``."""
    span = r"^(?:(\d+)\.)?(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d+)?))?$"
    part = lambda i: F.coalesce(F.regexp_extract(text, span, i).try_cast("double"), F.lit(0.0))
    seconds = F.when(text.rlike(r"^\d+$"), text.try_cast("double")).when(
        text.rlike(span), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    )
    return F.when(seconds > 0, seconds)


def retry_delay(failures: DataFrame, max_seconds: int = 300) -> DataFrame:
    """Per throttled operation how long to wait: the store's hint, at most and by default ``max_seconds``."""
    hint = F.when(F.col("exc_type") == FAULT_TYPE, hint_seconds(F.col("retry_after")))
    grouped = failures.groupBy("op_id").agg(
        F.bool_or(is_throttled()).alias("_throttled"),
        F.min_by(hint, F.when(hint.isNotNull(), F.col("node_id"))).alias("_hint"),
    )
    return grouped.select(
        "op_id",
        F.when(
            F.col("_throttled"),
            F.least(F.coalesce("_hint", F.lit(float(max_seconds))), F.lit(float(max_seconds))),
        ).alias("delay_seconds"),
    )
