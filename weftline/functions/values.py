"""Kind checks and conversions of single values, as column expressions.

Converted values travel as *canonical text*: one spelling per value and type, so
equal values are equal text whatever their JSON or table form was. ``typed`` turns
canonical text into the column type, ``canonical`` does the reverse for columns of
a target table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.catalog import SPARK_TYPES
from weftline.functions.json_text import plain_text
from weftline.functions.text import message, trimmed

# Fixed value: ISO-like shape of a date text; characters 5 and 8 are dashes.
_DATE_SHAPE = (
    r"^\d{4}-\d{2}-\d{1,2}"
    r"([T ]+\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?"
    r" *(Z|[+-]\d{1,2}(:?\d{2})?)?$"
)

_GUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_EMPTY_GUID = "00000000-0000-0000-0000-000000000000"


def empty_guid() -> Column:
    return F.lit(_EMPTY_GUID)


def timestamp_of(text: Column) -> Column:
    """Timestamp of an ISO-shaped text (no offset means UTC), else null."""
    dashed = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    shaped = (F.length(text) >= 10) & dashed & text.rlike(_DATE_SHAPE)
    return F.when(shaped, text.try_cast("timestamp"))


def is_plain_guid(text: Column) -> Column:
    return (F.length(text) == 36) & text.rlike("(?i)^" + _GUID + "$")


def guid_of(text: Column) -> Column:
    """Canonical lower-case id of any of the usual guid spellings, else null."""
    t = F.lower(trimmed(text))
    inner = F.when(t.rlike(r"^\{.*\}$|^\(.*\)$"), F.substr(t, F.lit(2), F.length(t) - 2)).otherwise(t)
    dashed = F.regexp_replace(t, r"^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
    parts = r"^\{0x([0-9a-f]{8}),0x([0-9a-f]{4}),0x([0-9a-f]{4}),\{" + ",".join([r"0x([0-9a-f]{2})"] * 8) + r"\}\}$"
    hexed = F.regexp_replace(t, parts, "$1-$2-$3-$4$5-$6$7$8$9$10$11")
    return (
        F.when(inner.rlike("^" + _GUID + "$"), inner)
        .when(dashed.rlike("^" + _GUID + "$"), dashed)
        .when(hexed.rlike("^" + _GUID + "$"), hexed)
    )


def choice_code(text: Column, codes: Column) -> Column:
    """Code of a choice given by name, by numeric text or as a list of names."""
    t = trimmed(text)
    named = F.transform(F.split(t, ","), lambda p: F.try_element_at(codes, F.lower(trimmed(p))))
    combined = F.aggregate(named, F.lit(0), lambda acc, c: acc.bitwiseOR(c))
    return (
        F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))
        .when(t.rlike(r"^[+-]|^\d"), F.lit(None).cast("int"))
        .otherwise(combined)
    )


def _int32(kind: Column, raw: Column) -> Column:
    return F.when(kind == "int", raw.try_cast("int"))


def is_compatible(kind: Column, raw: Column, spec: Column) -> Column:
    """May a JSON value of this kind be given for this attribute at all?"""
    of = spec["type"]
    number = kind.isin("int", "number")
    return (
        F.when(kind == "null", True)
        .when(
            of == "choice",
            F.when(kind == "string", choice_code(raw, spec["codes"]).isNotNull()).otherwise(
                _int32(kind, raw).isNotNull()
            ),
        )
        .when(kind == "bool", of == "bool")
        .when(kind == "string", of.isin("string", "guid", "datetime"))
        .when(number, of.isin("int", "long", "float", "double", "decimal", "money", "option"))
        .when(kind == "array", of.isin("choices", "string"))
        .when(kind == "object", of == "string")
        .otherwise(False)
    )


def _decimal_text(kind: Column, raw: Column) -> Column:
    return F.when(kind.isin("int", "number"), raw.try_cast("decimal(38,10)").cast("string"))


def _choice_list_text(kind: Column, raw: Column) -> Column:
    items = F.from_json(raw, "array<variant>")
    codes = F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "BIGINT", F.try_variant_get(v, "$", "int")))
    return F.when((kind == "array") & F.forall(codes, lambda c: c.isNotNull()), F.to_json(codes))


def canonical_text(kind: Column, raw: Column, spec: Column) -> Column:
    """Canonical text of a JSON value for its attribute; null also when it cannot be converted."""
    of = spec["type"]
    number = kind.isin("int", "number")
    return (
        F.when(kind == "null", F.lit(None).cast("string"))
        .when(of == "string", F.when(kind.isin("array", "object"), plain_text(raw)).otherwise(raw))
        .when(
            of == "choice",
            F.when(kind == "string", choice_code(raw, spec["codes"])).otherwise(_int32(kind, raw)).cast("string"),
        )
        .when(of.isin("int", "option"), _int32(kind, raw).cast("string"))
        .when(of == "long", F.when(kind == "int", raw.try_cast("bigint")).cast("string"))
        .when(of.isin("decimal", "money"), _decimal_text(kind, raw))
        .when(of == "double", F.when(number, raw.try_cast("double")).cast("string"))
        .when(of == "float", F.when(number, raw.try_cast("float")).cast("string"))
        .when(of == "bool", F.when(kind == "bool", F.lower(raw)))
        .when(of == "guid", F.when(kind == "string", guid_of(raw)))
        .when(of == "datetime", F.when(kind == "string", F.unix_micros(timestamp_of(raw))).cast("string"))
        .when(of == "choices", _choice_list_text(kind, raw))
    )


def conversion_error(name: Column, kind: Column, text: Column, spec: Column) -> Column:
    """Why ``canonical_text`` gave nothing for a value that is not null."""
    of = spec["type"]
    return F.when(
        (kind != "null") & text.isNull(),
        F.when(
            of == "reference",
            message(
                "Field '", name,
                "' expects EntityReference. This must be provided via lookup resolution, not raw JSON.",
            ),
        )
        .when((of == "choices") & (kind == "array"), message("Field '", name, "' contains an invalid multi-select option value."))
        .otherwise(message("Field '", name, "' could not be converted to '", spec["friendly"], "'.")),
    )


def typed(text: Column, type_name: str) -> Column:
    """Canonical text as a value of the column type."""
    if type_name == "datetime":
        return F.timestamp_micros(text.cast("bigint"))
    if type_name == "choices":
        return F.from_json(text, "array<int>")
    if type_name == "reference":
        return F.when(
            text.isNotNull(),
            F.struct(
                F.substring_index(text, ":", 1).alias("entity"),
                # An id may hold colons of its own.
                F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1).alias("id"),
            ),
        )
    if type_name == "binary":
        return F.unbase64(text)
    return text.try_cast(SPARK_TYPES[type_name])


def canonical(value: Column, type_name: str) -> Column:
    """Canonical text of a typed table value; null where it does not fit the type."""
    if type_name == "datetime":
        return F.unix_micros(value.try_cast("timestamp")).cast("string")
    if type_name == "guid":
        return F.lower(value.cast("string"))
    if type_name in ("decimal", "money"):
        return value.try_cast("decimal(38,10)").cast("string")
    if type_name == "choices":
        return F.to_json(value.try_cast("array<int>"))
    if type_name == "reference":
        return F.when(value.isNotNull(), F.concat(value["entity"], F.lit(":"), value["id"]))
    if type_name == "binary":
        return F.base64(value)
    if type_name in ("int", "choice", "option"):
        return value.try_cast("int").cast("string")
    if type_name == "long":
        return value.try_cast("bigint").cast("string")
    if type_name in ("double", "float"):
        return value.try_cast(type_name).cast("string")
    return value.cast("string")


def normalized_text(kind: Column, raw: Column) -> Column:
    """Text of a value by its own shape, without a catalog: guid, date, number, truth value."""
    stamp = timestamp_of(raw)
    return (
        F.when(kind == "null", "null")
        .when(kind == "bool", F.when(F.lower(raw) == "true", "True").otherwise("False"))
        .when(
            kind == "string",
            F.when(is_plain_guid(raw), F.lower(raw))
            .when(stamp.isNotNull(), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'"))
            .otherwise(raw),
        )
        .when(kind.isin("array", "object"), plain_text(raw))
        .otherwise(raw)
    )


def normalized_kind(kind: Column, raw: Column) -> Column:
    """Which shape ``normalized_text`` saw: guid, datetime, string, int, long, decimal, double, ..."""
    return (
        F.when(
            kind == "string",
            F.when(is_plain_guid(raw), "guid").when(timestamp_of(raw).isNotNull(), "datetime").otherwise("string"),
        )
        .when((kind == "int") & raw.try_cast("int").isNotNull(), "int")
        .when((kind == "int") & raw.try_cast("bigint").isNotNull(), "long")
        .when(kind.isin("int", "number") & _decimal_text(kind, raw).isNotNull(), "decimal")
        .when(kind.isin("int", "number"), "double")
        .otherwise(kind)
    )
