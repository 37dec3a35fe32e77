"""Result rows, batch status and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.functions.values import empty_guid
from weftline.operators.validate import error_text

# Names of the error categories.
CATEGORIES = ("None", "Validation", "Transient", "Permanent", "Throttling", "Cancellation")

RESULT_COLUMNS = [
    "message_id", "idx", "Id", "Created", "EntityLogicalName", "UpsertKey",
    "ErrorMessage", "ErrorCategory", "ValidationErrors",
]


def success_results(rows: DataFrame) -> DataFrame:
    """Rows that were written: message_id, idx, final_id, created, entity, sig."""
    return rows.select(
        "message_id",
        "idx",
        F.col("final_id").alias("Id"),
        F.col("created").alias("Created"),
        F.col("entity").alias("EntityLogicalName"),
        F.col("sig").alias("UpsertKey"),
        F.lit(None).cast("string").alias("ErrorMessage"),
        F.lit("None").alias("ErrorCategory"),
        F.lit(None).cast("array<string>").alias("ValidationErrors"),
    )


def error_results(rows: DataFrame) -> DataFrame:
    """Rows that were not written: message_id, idx, entity, sig, error, category, errors (validation only)."""
    validation = F.col("category") == "Validation"
    return rows.select(
        "message_id",
        "idx",
        empty_guid().alias("Id"),
        F.lit(False).alias("Created"),
        F.coalesce("entity", F.lit("<unknown>")).alias("EntityLogicalName"),
        F.col("sig").alias("UpsertKey"),
        F.coalesce("error", error_text(F.col("errors"))).alias("ErrorMessage"),
        F.col("category").alias("ErrorCategory"),
        F.when(validation, F.coalesce("errors", F.array("error"))).alias("ValidationErrors"),
    )


def batch_counts(results: DataFrame) -> DataFrame:
    failed = F.col("ErrorCategory") != "None"
    invalid = F.col("ErrorCategory") == "Validation"
    return results.groupBy("message_id").agg(
        F.count("*").alias("total"),
        F.count_if(failed).alias("failed"),
        F.count_if(invalid).alias("validation_failed"),
        F.count_if(failed & ~invalid).alias("technical_failed"),
    )


def batch_status(results: DataFrame, options: Options = Options()) -> DataFrame:
    """One status per message with its counters; seconds to wait only when all that failed was throttling."""
    category = F.col("ErrorCategory")
    grouped = results.groupBy("message_id").agg(
        F.count("*").alias("total"),
        F.count_if(category != "None").alias("failed"),
        F.count_if(category == "Validation").alias("validation_failed"),
        F.count_if(category.isin("Transient", "Permanent", "Cancellation")).alias("_other"),
        F.count_if(category == "Throttling").alias("_throttled"),
    )
    status = (
        F.when(F.col("_other") > 0, 500)
        .when(F.col("_throttled") > 0, 429)
        .when(F.col("validation_failed") > 0, 400)
        .otherwise(200)
    )
    return grouped.select(
        "message_id",
        status.alias("status"),
        F.when(status == 429, options.rate_limit_retry_delay_seconds).alias("retry_after"),
        "total",
        "failed",
        "validation_failed",
        (F.col("failed") - F.col("validation_failed")).alias("technical_failed"),
    )


def message_status(rows: DataFrame, results: DataFrame, options: Options = Options()) -> DataFrame:
    """Status of every message: that of its results, or that of the guard that refused it.

    ``rows`` are payload rows with their message's guard columns (a refused message is one row).
    """
    messages = rows.groupBy("message_id").agg(
        F.min("correlation_id").alias("correlation_id"),
        F.min("guard_status").alias("guard_status"),
        F.min("guard_error").alias("error"),
    )
    zero = F.lit(0).cast("bigint")
    return messages.join(batch_status(results, options), "message_id", "left").select(
        "message_id",
        "correlation_id",
        F.coalesce("guard_status", "status", F.lit(200)).alias("status"),
        "retry_after",
        *[F.coalesce(c, zero).alias(c) for c in ("total", "failed", "validation_failed", "technical_failed")],
        "error",
    )


def error_rows(refused: DataFrame) -> DataFrame:
    """Structured error document per refused message; ``Details`` is left out when there are none."""
    details = F.col("details") if "details" in refused.columns else F.lit(None).cast("array<string>")
    return refused.select(
        "message_id",
        F.to_json(
            F.struct(
                F.col("error").alias("Error"), details.alias("Details"), F.col("correlation_id").alias("CorrelationId")
            )
        ).alias("json"),
    )
