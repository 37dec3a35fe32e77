"""Message guards: which messages are refused as a whole, with which status and text."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.functions import json_text as J
from weftline.functions.text import message
from weftline.functions.values import is_plain_guid

# A lookup definition takes two JSON levels, so documents of at most 32 levels hold at most this many.
MAX_LOOKUP_LEVELS = 14

_DEFINITIONS = "array<struct<ok:boolean,nested:string>>"

# Texts of refused messages, per channel.
_TEXTS = {
    "request": {
        "malformed": "Invalid request: The body is not a valid JSON batch.",
        "null": "Invalid request: Request body must contain a JSON object.",
        "empty": "Invalid request: Payloads must contain at least one item.",
        "count": ("Invalid request: Payloads count (", ") exceeds the maximum of "),
    },
    "queue": {
        "malformed": "Message is not a valid JSON batch.",
        "null": "Message contains no payloads.",
        "empty": "Message contains no payloads.",
        "count": ("Message batch size (", ") exceeds the maximum of "),
    },
}


def too_large(body: Column, max_bytes: int) -> Column:
    return F.octet_length(body) > max_bytes


def readable(body: Column, options: Options, channel: str = "request") -> Column:
    """The body if its size allows it to be parsed."""
    if channel != "request":
        return body
    return F.when(~too_large(body, options.max_request_bytes), body)


def _kind_ok(members: Column, name: str, *kinds: str, required: bool = False) -> Column:
    """A member's kind is one of ``kinds``; a missing one is fine unless required."""
    kind = J.kind_of_member(members, name)
    return F.coalesce(kind.isin(*kinds), F.lit(not required))


def _int_ok(members: Column, name: str) -> Column:
    kind, raw = J.kind_of_member(members, name), J.raw_of(members, name)
    return kind.isNull() | (kind == "null") | ((kind == "int") & raw.try_cast("int").isNotNull())


def _definition_ok(members: Column) -> Column:
    return (
        _kind_ok(members, "entitylogicalname", "string", "null", required=True)
        & _kind_ok(members, "keyattributes", "object", "null", required=True)
        & _kind_ok(members, "createifnotexists", "bool")
        & _kind_ok(members, "createattributes", "object", "null")
        & _kind_ok(members, "nestedlookups", "object", "null")
        & _int_ok(members, "maxdepth")
    )


def _payload_ok(members: Column) -> Column:
    id_kind, id_raw = J.kind_of_member(members, "id"), J.raw_of(members, "id")
    return (
        _kind_ok(members, "entitylogicalname", "string", "null", required=True)
        & _kind_ok(members, "keyattributes", "object", "null", required=True)
        & _kind_ok(members, "attributes", "object", "null", required=True)
        & (id_kind.isNull() | (id_kind == "null") | ((id_kind == "string") & is_plain_guid(id_raw)))
        & _kind_ok(members, "sourcesystem", "string", "null")
        & _kind_ok(members, "lookups", "object", "null")
        & _int_ok(members, "maxlookupdepth")
    )


def _definitions_in(text: Column) -> Column:
    """Whether each definition has its members, and the text of those nested in it.

    Members are read once: a lambda would parse again at every use. They are read definition by
    definition only where a value is no object.
    """
    at_once = F.transform(
        F.map_values(J.bags_by_name(text)),
        lambda m: F.struct(F.when(m.isNull(), "null").otherwise("object").alias("kind"), m.alias("members")),
    )
    one_by_one = F.transform(
        F.map_values(J.bag(text)),
        lambda d: F.struct(d["kind"].alias("kind"), J.bag(d["raw"], fold_names=True).alias("members")),
    )
    definition_ok = lambda d: F.when(d["kind"] == "null", True).otherwise(
        (d["kind"] == "object") & F.coalesce(_definition_ok(d["members"]), F.lit(False))
    )
    return F.coalesce(
        F.transform(
            F.coalesce(at_once, one_by_one),
            lambda d: F.struct(definition_ok(d).alias("ok"), J.raw_of(d["members"], "nestedlookups").alias("nested")),
        ),
        F.array(),
    ).cast(_DEFINITIONS)


@lru_cache(maxsize=1)
def envelope_ok() -> Column:
    """Every required member is present and every envelope member has its type, down all lookups.

    Reads the columns ``_members`` and ``payloads``. Built once: it is a large expression.
    """
    members, payloads = F.col("_members"), F.col("payloads")
    objects = F.filter(payloads, lambda m: m.isNotNull())
    # The payloads are the level above all definitions, so that these are read at one place.
    above = F.transform(
        objects, lambda m: F.struct(F.lit(True).alias("ok"), J.raw_of(m, "lookups").alias("nested"))
    ).cast(_DEFINITIONS)

    def next_level(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        below = F.flatten(
            F.transform(F.filter(last, lambda d: d["nested"].isNotNull()), lambda d: _definitions_in(d["nested"]))
        )
        return F.when(F.size(last) == 0, levels).otherwise(F.concat(levels, F.array(below)))

    definitions = F.flatten(
        F.aggregate(F.sequence(F.lit(1), F.lit(MAX_LOOKUP_LEVELS)), F.array(above), next_level)
    )
    listed = J.kind_of_member(members, "payloads") != "array"
    return (
        _kind_ok(members, "payloads", "array", "null", required=True)
        & _int_ok(members, "maxlookupdepth")
        & (F.coalesce(listed, F.lit(True)) | payloads.isNotNull())
        & F.coalesce(F.forall(objects, _payload_ok), F.lit(True))
        & F.coalesce(F.forall(definitions, lambda d: d["ok"]), F.lit(True))
    )


def apply_message_guards(parsed: DataFrame, options: Options, channel: str = "request") -> DataFrame:
    """Guards in their order: size, parse (JSON, depth, envelope), empty, count.

    ``guard_status`` is 413 or 400, null for messages that go on. Queue messages
    have no size limit.
    """
    texts = _TEXTS[channel]
    body, payloads = F.col("body"), F.col("payloads")
    count = F.coalesce(F.size(payloads), F.lit(0))
    before, after = texts["count"]
    checked = (
        parsed.withColumn(
            "_large", too_large(body, options.max_request_bytes) if channel == "request" else F.lit(False)
        )
        .withColumn("_null", J.is_null_document(F.coalesce(body, F.lit("null"))))
        .withColumn(
            "_malformed",
            F.col("_members").isNull()
            | J.nests_deeper_than(readable(body, options, channel), options.max_json_depth)
            | ~F.coalesce(envelope_ok(), F.lit(False)),
        )
    )
    error = (
        F.when(
            F.col("_large"),
            F.lit(f"Request body exceeds the maximum allowed size of {options.max_request_bytes} bytes."),
        )
        .when(F.col("_null"), texts["null"])
        .when(F.col("_malformed"), texts["malformed"])
        .when(count == 0, texts["empty"])
        .when(count > options.max_batch_items, message(before, count, after, f"{options.max_batch_items}."))
    )
    status = F.when(F.col("_large"), 413).when(F.col("guard_error").isNotNull(), 400)
    return (
        checked.withColumn("guard_error", error)
        .withColumn("guard_status", status.cast("int"))
        .drop("_large", "_null", "_malformed")
    )


def with_correlation_id(messages: DataFrame) -> DataFrame:
    """Keep a caller's id if it is short printable ASCII, else take one derived from the message id."""
    given = F.col("correlation_id")
    keep = given.rlike(r"\A[\x20-\x7E]{1,64}\z") & (F.trim(given) != "")
    fresh = F.substring(F.sha2(F.concat(F.lit("correlation:"), F.col("message_id").cast("string")), 256), 1, 32)
    return messages.withColumn("correlation_id", F.when(F.coalesce(keep, F.lit(False)), given).otherwise(fresh))
