"""Set-at-a-time validation and conversion of payload rows.

Everything here works inside the row: no shuffle, no UDF. A payload ends up with
``errors`` (null when valid) or with ``key_values`` and ``values``, maps of lower-case
attribute name to canonical text. A name missing from ``values`` was not supplied; a
name mapped to null was supplied as null and clears the column.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.catalog import RESTRICTED_PREFIX, Catalog
from weftline.config import Options
from weftline.functions import values as V
from weftline.functions.keys import identity, key_names, signature
from weftline.functions.text import collected, is_blank, message
from weftline.operators.lookup_tree import lookup_nodes

_NO_TEXTS = "array<string>"


def _no_errors() -> Column:
    return F.array().cast(_NO_TEXTS)


def _restricted(name: Column) -> Column:
    return F.startswith(F.lower(name), F.lit(RESTRICTED_PREFIX))


def specs_of(catalog: Catalog, entity: Column) -> Column:
    """Attribute map of the entity, null for an unknown one."""
    return F.try_element_at(catalog.column(), F.lower(entity))


def with_specs(bag: Column, specs: Column) -> Column:
    """Entries of a bag, each with its lower-case name and attribute spec (null when unknown)."""
    return F.transform(
        F.map_entries(bag),
        lambda e: F.struct(
            e["key"].alias("name"),
            F.lower(e["key"]).alias("lname"),
            e["value"]["kind"].alias("kind"),
            e["value"]["raw"].alias("raw"),
            F.try_element_at(specs, F.lower(e["key"])).alias("spec"),
        ),
    )


def attribute_errors(entries: Column, entity: Column) -> Column:
    return F.filter(
        F.transform(
            entries,
            lambda e: F.when(
                e["spec"].isNull(), message("Field '", e["name"], "' is not defined on entity '", entity, "'.")
            )
            .when(_restricted(e["name"]), message("Field '", e["name"], "' is not writable through this endpoint."))
            .when(
                ~V.is_compatible(e["kind"], e["raw"], e["spec"]),
                message("Field '", e["name"], "' has invalid type. Expected '", e["spec"]["friendly"], "'."),
            ),
        ),
        lambda e: e.isNotNull(),
    )


def key_errors(entries: Column, entity: Column, attribute_names: Column) -> Column:
    def of(e: Column) -> Column:
        usable = e["spec"].isNotNull() & ~_restricted(e["name"])
        return collected(
            F.when(
                e["spec"].isNull(),
                message("KeyAttribute '", e["name"], "' is not defined on entity '", entity, "'."),
            ),
            F.when(
                e["spec"].isNotNull() & _restricted(e["name"]),
                message("KeyAttribute '", e["name"], "' is not usable through this endpoint."),
            ),
            F.when(
                usable & ~V.is_compatible(e["kind"], e["raw"], e["spec"]),
                message("KeyAttribute '", e["name"], "' has invalid type. Expected '", e["spec"]["friendly"], "'."),
            ),
            F.when(
                usable & F.array_contains(attribute_names, e["name"]),
                message("KeyAttribute '", e["name"], "' must not also be present in Attributes."),
            ),
        )

    return F.flatten(F.transform(entries, of))


def converted(entries: Column) -> Column:
    """``ARRAY<STRUCT<lname, text, error>>`` of entries with specs.

    Expects the columns the entries come from to be materialised by an earlier projection.
    """
    texts = F.transform(
        entries,
        lambda e: F.struct(
            e["lname"].alias("lname"),
            e["kind"].alias("kind"),
            e["spec"].alias("spec"),
            V.canonical_text(e["kind"], e["raw"], e["spec"]).alias("text"),
        ),
    )
    return F.transform(
        texts,
        lambda e: F.struct(
            e["lname"].alias("lname"),
            e["text"].alias("text"),
            V.conversion_error(e["lname"], e["kind"], e["text"], e["spec"]).alias("error"),
        ),
    )


def values_map(entries: Column) -> Column:
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["lname"].alias("key"), e["text"].alias("value"))))


def first_error(entries: Column) -> Column:
    return F.get(F.filter(entries, lambda e: e["error"].isNotNull()), F.lit(0))["error"]


def structure_errors() -> Column:
    """Errors of the payload's own shape: keys, entity, attributes."""
    return F.when(F.col("is_null"), F.array(F.lit("Payload must not be null."))).otherwise(
        collected(
            F.when(
                F.coalesce(F.size("keys"), F.lit(0)) <= 0,
                F.lit("KeyAttributes must contain at least one entry for the main entity."),
            ),
            F.when(is_blank(F.col("entity")), F.lit("EntityLogicalName is required.")),
            F.when(F.col("attrs").isNull(), F.lit("Attributes are required.")),
        )
    )


@lru_cache(maxsize=16)
def lookup_errors(catalog: Catalog) -> Column:
    """Errors of all lookup definitions in ``nodes``, each with its dotted path."""
    nodes = F.col("nodes")
    catalog_column = catalog.column()

    def names(n: Column, bag: Column, specs: Column, part: str) -> Column:
        return F.coalesce(
            F.filter(
                F.transform(
                    F.map_keys(bag),
                    lambda name: F.when(
                        F.try_element_at(specs, F.lower(name)).isNull(),
                        message(n["path"], f".{part}: Field '", name, "' is not defined on entity '", n["entity"], "'."),
                    ).when(
                        _restricted(name),
                        message(n["path"], f".{part}: Field '", name, "' is not writable through this endpoint."),
                    ),
                ),
                lambda e: e.isNotNull(),
            ),
            _no_errors(),
        )

    def of(n: Column) -> Column:
        blank = is_blank(n["entity"])
        keyless = F.coalesce(F.size(n["keys"]), F.lit(0)) <= 0
        specs = F.try_element_at(catalog_column, F.lower(n["entity"]))
        own = collected(
            F.when(n["absent"], message(n["path"], ": Lookup definition must not be null.")),
            F.when(~n["absent"] & blank, message(n["path"], ": EntityLogicalName is required.")),
            F.when(~n["absent"] & keyless, message(n["path"], ": KeyAttributes must contain at least one entry.")),
            F.when(
                ~n["absent"] & ~blank & ~keyless & specs.isNull(),
                message(n["path"], ": Entity '", n["entity"], "' does not exist in the early-bound model."),
            ),
        )
        named = F.when(
            ~n["absent"] & ~blank & ~keyless & specs.isNotNull(),
            F.concat(names(n, n["keys"], specs, "KeyAttributes"), names(n, n["create_attrs"], specs, "CreateAttributes")),
        ).otherwise(_no_errors())
        return F.concat(own, named)

    return F.coalesce(F.flatten(F.transform(nodes, of)), _no_errors())


def validate_structure(payloads: DataFrame, catalog: Catalog, options: Options = Options()) -> DataFrame:
    """Shape of payloads and of their lookups. Adds ``nodes`` and ``shape_errors``."""
    return (
        payloads.withColumn("nodes", lookup_nodes(options))
        .withColumn("shape_errors", F.concat(structure_errors(), lookup_errors(catalog)))
    )


def validate_attributes(payloads: DataFrame, catalog: Catalog) -> DataFrame:
    """Names and kinds of attributes and keys against the catalog. Adds ``kind_errors``."""
    entity = F.col("entity")
    prepared = (
        payloads.withColumn("_specs", specs_of(catalog, entity))
        .withColumn("_attr_entries", with_specs(F.col("attrs"), F.col("_specs")))
        .withColumn("_key_entries", with_specs(F.col("keys"), F.col("_specs")))
    )
    return prepared.withColumn("kind_errors", _kind_errors())


@lru_cache(maxsize=1)
def _kind_errors() -> Column:
    entity = F.col("entity")
    return F.when(
        F.col("_specs").isNull(),
        F.array(message("Entity '", entity, "' does not exist in the early-bound model.")),
    ).otherwise(
        F.concat(
            attribute_errors(F.col("_attr_entries"), entity),
            key_errors(F.col("_key_entries"), entity, F.map_keys("attrs")),
        )
    )


@lru_cache(maxsize=8)
def _converted_column(name: str) -> Column:
    return converted(F.col(name))


def validate_and_convert(payloads: DataFrame, catalog: Catalog, options: Options = Options()) -> DataFrame:
    """The whole row-level part. Keeps one row per payload.

    Result: message_id, idx, entity (as given), id, source, nodes, sig, errors (or null),
    and for valid payloads entity_name (lower case), values, key_values, identity, key_names.
    """
    shaped = validate_structure(payloads, catalog, options)
    checked = validate_attributes(shaped, catalog)
    stage_a = F.when(F.size("shape_errors") > 0, F.col("shape_errors")).when(
        F.size("kind_errors") > 0, F.col("kind_errors")
    )
    typed = (
        checked.withColumn("_stage_a", stage_a)
        .withColumn("_attrs", F.when(F.col("_stage_a").isNull(), _converted_column("_attr_entries")))
        .withColumn("_keys", F.when(F.col("_stage_a").isNull(), _converted_column("_key_entries")))
        .withColumn("_stage_b", F.coalesce(first_error(F.col("_attrs")), first_error(F.col("_keys"))))
        .withColumn(
            "errors", F.coalesce(F.col("_stage_a"), F.when(F.col("_stage_b").isNotNull(), F.array("_stage_b")))
        )
        .withColumn("_valid", F.col("errors").isNull())
        .withColumn("key_values", F.when(F.col("_valid"), values_map(F.col("_keys"))))
        .withColumn("values", F.when(F.col("_valid"), values_map(F.concat("_attrs", "_keys"))))
    )
    has_id = F.col("id").isNotNull() & (F.col("id") != V.empty_guid())
    about = [c for c in ("correlation_id", "guard_status", "guard_error") if c in payloads.columns]
    return typed.select(
        "message_id",
        "idx",
        *about,
        "is_null",
        "entity",
        F.when(F.col("_valid"), F.lower("entity")).alias("entity_name"),
        F.when(has_id, F.col("id")).alias("id"),
        "source",
        F.when(F.col("_valid"), F.col("nodes")).alias("nodes"),
        signature(F.col("entity"), F.col("keys")).alias("sig"),
        "errors",
        "key_values",
        "values",
        identity(F.col("key_values")).alias("identity"),
        key_names(F.col("key_values")).alias("key_names"),
    )


def validate_batch(validated: DataFrame) -> DataFrame:
    """Per message the errors of its first bad payload, each prefixed with its place."""
    bad = validated.where(F.col("errors").isNotNull())
    first = bad.groupBy("message_id").agg(F.min(F.struct("idx", "errors")).alias("f"))
    return first.select(
        "message_id",
        F.transform(
            F.col("f.errors"), lambda e: F.concat(F.lit("Payload["), F.col("f.idx").cast("string"), F.lit("]: "), e)
        ).alias("errors"),
    )


def error_text(errors: Column) -> Column:
    return F.array_join(errors, "; ")
