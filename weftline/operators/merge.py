"""Fold the changes of a key and merge them sparsely into the entity table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.catalog import Catalog
from weftline.functions.text import message
from weftline.functions.values import typed

_RECORD = ["entity_name", "id"]


def sequence_changes(decided: DataFrame, created_by_lookups: DataFrame | None = None) -> DataFrame:
    """Add ``created``: true for the first row that creates a record, false for all later ones.

    Rows of one record are taken in (message_id, idx) order. The first row is found with a
    partial aggregate and joined back by its own position, so a record that a third of all
    rows write to is never sorted or gathered in one task.
    """
    writable = decided.where(F.col("error").isNull() & (F.col("action") == "create"))
    first = writable.groupBy("entity_name", F.col("final_id").alias("id")).agg(
        F.min(F.struct("message_id", "idx")).alias("first")
    )
    if created_by_lookups is not None:
        # The record was made for a reference before the row itself was written.
        first = first.join(created_by_lookups.select(*_RECORD), _RECORD, "left_anti")
    marks = first.select("first.message_id", "first.idx", F.lit(True).alias("created"))
    return decided.join(marks, ["message_id", "idx"], "left").withColumn(
        "created", F.coalesce("created", F.lit(False))
    )


def fold_changes(changes: DataFrame) -> DataFrame:
    """Per record and attribute the last supplied value, explicit null included.

    ``changes``: entity_name, id, seq (orderable), exists, values (map of canonical text).
    Aggregating by attribute first combines on the map side, whatever the number of changes
    of one record; the second aggregate gathers at most one entry per attribute.
    """
    single = changes.select(*_RECORD, "seq", "exists", F.explode("values").alias("attribute", "text"))
    last = single.groupBy(*_RECORD, "attribute").agg(
        F.max_by(F.struct("text"), "seq").alias("last"), F.max("exists").alias("exists")
    )
    return last.groupBy(*_RECORD).agg(
        F.max("exists").alias("exists"),
        F.map_from_entries(
            F.collect_list(F.struct(F.col("attribute").alias("key"), F.col("last.text").alias("value")))
        ).alias("values"),
    )


def _nullable(data_type: T.DataType) -> T.DataType:
    """The type with nullable members: a reference can always be cleared."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in data_type.fields])
    return data_type


def merge_entity(target: DataFrame, folded: DataFrame, catalog: Catalog, entity: str) -> DataFrame:
    """New state of one table: supplied columns replaced, all others kept, new records added.

    Updates join the table from the left, so a small batch is broadcast and the table is
    neither shuffled nor sorted; creates need no join at all.
    """
    specs, id_column = catalog.entities[entity], catalog.id_column(entity)
    mine = folded.where(F.col("entity_name") == entity)
    updates = mine.where("exists").select(F.col("id").alias("_id"), F.col("values").alias("_values"))
    creates = mine.where(~F.col("exists")).select(F.col("id").alias("_id"), F.col("values").alias("_values"))

    def value_of(column: str, type_: T.DataType) -> Column:
        text = F.try_element_at(F.col("_values"), F.lit(column.lower()))
        # What does not fit was refused before; nothing may end the whole batch here.
        value = typed(text, specs[column.lower()].type)
        return value.cast(_nullable(type_)) if isinstance(type_, T.StructType) else value.try_cast(_nullable(type_))

    def updated(f: T.StructField) -> Column:
        if f.name.lower() == id_column or f.name.lower() not in specs:
            return F.col(f.name)
        supplied = F.map_contains_key("_values", f.name.lower())
        kept = F.col(f.name).cast(_nullable(f.dataType))
        return F.when(supplied, value_of(f.name, f.dataType)).otherwise(kept).alias(f.name)

    def fresh(f: T.StructField) -> Column:
        if f.name.lower() == id_column:
            return F.col("_id").cast(f.dataType).alias(f.name)
        if f.name.lower() not in specs:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return value_of(f.name, f.dataType).alias(f.name)

    fields = target.schema.fields
    changed = target.join(updates, F.col(id_column).cast("string") == F.col("_id"), "left").select(
        *[updated(f) for f in fields]
    )
    return changed.unionByName(creates.select(*[fresh(f) for f in fields]))


def value_refusal(
    entity_name: Column, entity: Column, values: Column, targets: Mapping[str, DataFrame], catalog: Catalog
) -> Column:
    """Why values cannot be written to their entity's table, or null: table, columns and types as they are."""
    names = F.map_keys(values)
    refusal = F.when(~entity_name.isin(list(targets)), message("Entity '", entity, "' has no table to write to."))
    for name, target in targets.items():
        mine, specs = entity_name == name, catalog.entities.get(name, {})
        fields = {f.name.lower(): f.dataType for f in target.schema.fields}
        known = F.array(*[F.lit(n) for n in fields]).cast("array<string>")
        missing = F.array_min(F.array_except(names, known))
        refusal = F.coalesce(refusal, F.when(mine & missing.isNotNull(), message("Field '", missing, "' has no column to write to.")))
        for field, type_ in fields.items():
            if field not in specs or isinstance(type_, T.StructType):
                continue
            text = F.try_element_at(values, F.lit(field))
            fits = typed(text, specs[field].type).try_cast(type_).isNotNull()
            refusal = F.coalesce(
                refusal, F.when(mine & text.isNotNull() & ~fits, message("Field '", F.lit(field), "' does not fit its column."))
            )
    return F.when(values.isNotNull(), refusal)


def reference_refusal(entity_name: Column, attribute: Column, targets: Mapping[str, DataFrame], catalog: Catalog) -> Column:
    """Why an entity's table cannot hold a reference under ``attribute``, or null. Says nothing of entities without a table."""
    name, refusal = F.lower(attribute), F.lit(None).cast("string")
    for entity, target in targets.items():
        specs = catalog.entities.get(entity, {})
        places = [f.lower() for f in target.columns if f.lower() in specs]
        references = [f for f in places if specs[f].type == "reference"]
        own = F.when(~name.isin(places), message("Field '", name, "' has no column to write to.")).when(
            ~name.isin(references), message("Field '", name, "' cannot hold a reference.")
        )
        refusal = F.when(entity_name == entity, own).otherwise(refusal)
    return refusal


def write_refusals(rows: DataFrame, targets: Mapping[str, DataFrame], catalog: Catalog) -> Column:
    """Why a row's values or references cannot be written, or null."""
    refusal = value_refusal(F.col("entity_name"), F.col("entity"), F.col("values"), targets, catalog)
    return F.coalesce("misplaced", refusal) if "misplaced" in rows.columns else refusal


def first_misplaced(rows: DataFrame, targets: Mapping[str, DataFrame], catalog: Catalog) -> Column:
    """Why a row's table has no place for the first of its lookups that is misplaced, or null."""
    if "lookup_names" in rows.columns:
        names = F.col("lookup_names")
    else:
        names = F.transform(F.filter("nodes", lambda n: n["depth"] == 0), lambda n: n["attribute"])
    misplaced = F.filter(
        F.transform(names, lambda name: reference_refusal(F.col("entity_name"), name, targets, catalog)),
        lambda e: e.isNotNull(),
    )
    return F.get(misplaced, F.lit(0))


def merge_entities(targets: Mapping[str, DataFrame], folded: DataFrame, catalog: Catalog) -> dict[str, DataFrame]:
    return {entity: merge_entity(target, folded, catalog, entity) for entity, target in targets.items()}


def fold_typed_changes(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], present: str = "present"
) -> DataFrame:
    """``fold_changes`` for changes that already have typed columns.

    ``present`` is the array of column names a row supplies. Each result column is a struct
    ``{v}``: null when no row supplied it, ``{null}`` when the last one that did cleared it.
    """
    seq = F.struct(*order)
    return changes.groupBy(*keys).agg(
        *[
            F.max_by(
                F.when(F.array_contains(present, c), F.struct(F.col(c).alias("v"))),
                F.when(F.array_contains(present, c), seq),
            ).alias(c)
            for c in columns
        ]
    )


def merge_typed_changes(
    target: DataFrame, folded: DataFrame, key: str, columns: Sequence[str], new_row: Mapping[str, Column] | None = None
) -> DataFrame:
    """Sparse merge on a business key for folded typed changes; unmatched changes become new rows.

    ``new_row`` gives values for target columns the changes do not carry, such as the id.
    """
    new_row = new_row or {}
    renamed = folded.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.withColumn("_there", F.lit(True)).join(renamed, F.col(key) == F.col("_key"), "full")
    there = F.coalesce("_there", F.lit(False))

    def merged(f: T.StructField) -> Column:
        if f.name == key:
            return F.coalesce(F.col(key), F.col("_key")).alias(key)
        if f.name in columns:
            change = F.col(f"_{f.name}")
            return F.when(change.isNotNull(), change["v"].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        fresh = new_row.get(f.name, F.lit(None)).cast(f.dataType)
        return F.when(there, F.col(f.name)).otherwise(fresh).alias(f.name)

    return joined.select(*[merged(f) for f in target.schema.fields])
