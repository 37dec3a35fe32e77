"""Change records that already are table rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.catalog import RESTRICTED_PREFIX, AttributeSpec, Catalog
from weftline.config import Options
from weftline.functions import json_text as J
from weftline.functions import keys as K
from weftline.functions import values as V
from weftline.operators import lookups as L
from weftline.operators.lookup_tree import NODE_DDL
from weftline.operators.resolve import Profile

_WHOLE_32 = (T.ByteType, T.ShortType, T.IntegerType)
_WHOLE = (*_WHOLE_32, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_STAMP = (T.TimestampType, T.TimestampNTZType, T.DateType)

# Which table types may be given for an attribute type.
_ACCEPTED = {
    "string": (T.StringType,),
    "guid": (T.StringType,),
    "bool": (T.BooleanType,),
    "int": _WHOLE_32,
    "long": _WHOLE,
    "decimal": _NUMBER,
    "double": _NUMBER,
    "float": _NUMBER,
    "money": _NUMBER,
    "datetime": (*_STAMP, T.StringType),
    "choice": (*_WHOLE_32, T.StringType),
    "option": _WHOLE_32,
    "choices": (T.ArrayType,),
    "reference": (T.StructType,),
    "binary": (T.BinaryType,),
}


@dataclass(frozen=True)
class Lookup:
    """A reference to resolve for every row: attribute, where to look, by which columns."""

    attribute: str
    entity: str
    keys: Mapping[str, Column]
    create: bool = False
    create_attrs: Mapping[str, Column] = field(default_factory=dict)
    nested: Sequence[Lookup] = ()
    max_depth: int | None = None


def is_type_accepted(data_type: T.DataType, spec: AttributeSpec) -> bool:
    if isinstance(data_type, T.NullType):
        return True
    if not isinstance(data_type, _ACCEPTED[spec.type]):
        return False
    if spec.type == "choices":
        return isinstance(data_type.elementType, T.IntegerType)
    if spec.type == "reference":
        return [f.name for f in data_type.fields] == ["entity", "id"]
    return True


def typed_text(value: Column, data_type: T.DataType, spec: AttributeSpec, codes: Mapping[str, int] | None) -> Column:
    """Canonical text of a typed value; null for a text that does not read as the attribute's type."""
    if isinstance(data_type, T.StringType):
        if spec.type == "guid":
            return V.guid_of(value)
        if spec.type == "datetime":
            return F.unix_micros(V.timestamp_of(value)).cast("string")
        if spec.type == "choice":
            names = F.from_json(F.lit(json.dumps(dict(codes or {}))), "map<string,int>")
            return V.choice_code(value, names).cast("string")
    return V.canonical(value, spec.type)


def _checked(
    frame: DataFrame, catalog: Catalog, entity: str, columns: Mapping[str, Column], label: str
) -> tuple[list[Column], dict[str, Column]]:
    """Errors and canonical texts of the columns. Types are settled here, once, not per row."""
    specs = catalog.entities.get(entity.lower(), {})
    shown = "Field" if label == "Field" else "KeyAttribute"
    types = frame.select(*[c.alias(n) for n, c in columns.items()]).schema if columns else []
    errors, texts = [], {}
    for name, column in columns.items():
        spec = specs.get(name.lower())
        invalid = spec and f"{shown} '{name}' has invalid type. Expected '{spec.friendly}'."
        if spec is None:
            errors.append(F.lit(f"{shown} '{name}' is not defined on entity '{entity}'."))
        elif name.lower().startswith(RESTRICTED_PREFIX):
            use = "writable" if shown == "Field" else "usable"
            errors.append(F.lit(f"{shown} '{name}' is not {use} through this endpoint."))
        elif not is_type_accepted(types[name].dataType, spec):
            errors.append(F.when(column.isNotNull(), F.lit(invalid)))
        else:
            text = typed_text(column, types[name].dataType, spec, catalog.options.get(spec.option_set))
            if spec.type != "string":
                errors.append(F.when(column.isNotNull() & text.isNull(), F.lit(invalid)))
            texts[name.lower()] = text
    return errors, texts


def _map_of(texts: Mapping[str, Column]) -> Column:
    if not texts:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[part for n, c in texts.items() for part in (F.lit(n), c.cast("string"))])


def _json_forms(frame: DataFrame, columns: Mapping[str, Column]) -> dict[str, tuple[Column, Column]]:
    """Kind and text each typed column would have had as a JSON member."""
    types = frame.select(*[c.alias(n) for n, c in columns.items()]).schema
    forms = {}
    for name, column in columns.items():
        data_type = types[name].dataType
        if isinstance(data_type, _WHOLE):
            kind = "int"
        elif isinstance(data_type, _NUMBER):
            kind = "number"
        elif isinstance(data_type, T.BooleanType):
            kind = "bool"
        else:
            kind = "string"
        forms[name] = (F.when(column.isNull(), "null").otherwise(F.lit(kind)), column.cast("string"))
    return forms


def bag_of(frame: DataFrame, columns: Mapping[str, Column]) -> Column:
    """Typed columns as a bag, as if they had been JSON members."""
    if not columns:
        return F.lit(None).cast(J.BAG_DDL)
    parts = [
        part
        for name, (kind, raw) in _json_forms(frame, columns).items()
        for part in (F.lit(name), F.struct(kind.alias("kind"), raw.alias("raw")))
    ]
    return F.create_map(*parts).cast(J.BAG_DDL)


@dataclass(frozen=True)
class _Place:
    """A lookup of typed rows in its tree. ``above`` are the lookups it is nested in, outermost first."""

    item: Lookup
    order: str
    parent: str
    path: str
    depth: int
    limit: int
    above: tuple[Lookup, ...]


def _places(lookups: Sequence[Lookup], options: Options) -> list[_Place]:
    flat: list[_Place] = []

    def walk(items: Sequence[Lookup], parent: str, path: str, eff: int, above: tuple[Lookup, ...]) -> None:
        for i, item in enumerate(items):
            limit = eff if item.max_depth is None else max(1, min(item.max_depth, options.max_lookup_depth))
            order, where = f"{parent}.{i:07d}", f"{path}.{item.attribute}"
            flat.append(_Place(item, order, parent, where, len(above), limit, above))
            walk(item.nested, order, where, limit, (*above, item))

    walk(lookups, "", "Lookups", options.max_lookup_depth, ())
    return flat


def _signature(frame: DataFrame, item: Lookup) -> Column:
    return K.signature_of(item.entity, _json_forms(frame, item.keys))


def _nodes(frame: DataFrame, lookups: Sequence[Lookup], options: Options) -> Column:
    flat = [
        F.struct(
            F.lit(at.order).alias("ord"),
            F.lit(at.parent).alias("parent"),
            F.lit(at.path).alias("path"),
            F.lit(at.item.attribute).alias("attribute"),
            F.lit(at.depth).alias("depth"),
            F.lit(False).alias("absent"),
            F.lit(at.item.entity).alias("entity"),
            bag_of(frame, at.item.keys).alias("keys"),
            F.lit(at.item.create).alias("create"),
            bag_of(frame, at.item.create_attrs).alias("create_attrs"),
            F.lit(at.limit).alias("eff_depth"),
            _signature(frame, at.item).alias("sig"),
            F.array(*[_signature(frame, a) for a in at.above]).cast("array<string>").alias("above"),
            F.lit(None).cast("string").alias("nested"),
            F.lit(at.above[-1].entity if at.above else None).cast("string").alias("holder"),
        )
        for at in _places(lookups, options)
    ]
    return (F.array(*flat) if flat else F.array()).cast(NODE_DDL)


def _may_repeat(one: Lookup, other: Lookup) -> bool:
    """False if the signatures differ whatever the values: another entity, or other key columns."""
    names = [one.entity, other.entity, *one.keys, *other.keys]
    if not all(n.isidentifier() for n in names):
        return True
    same = lambda item: (item.entity.lower(), sorted(n.lower() for n in item.keys))
    return same(one) == same(other)


def _settled_nodes(frame: DataFrame, catalog: Catalog, lookups: Sequence[Lookup], options: Options) -> Column:
    """``nodes`` as ``lookups.explode_lookups`` would settle them, here with names and types known.

    Nothing goes through bags and lambdas, so all of it is compiled.
    """
    nothing, no_map = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")

    def converted(entity: str, columns: Mapping[str, Column]) -> tuple[dict[str, Column], Column]:
        specs = F.try_element_at(catalog.column(), F.lit(entity.lower()))
        texts, errors = {}, [nothing]
        for name, (kind, raw) in (_json_forms(frame, columns) if columns else {}).items():
            spec = F.try_element_at(specs, F.lit(name.lower()))
            texts[name.lower()] = V.canonical_text(kind, raw, spec)
            errors.append(V.conversion_error(F.lit(name.lower()), kind, texts[name.lower()], spec))
        return texts, F.coalesce(*errors)

    flat = []
    for at in _places(lookups, options):
        item = at.item
        keys, key_error = converted(item.entity, item.keys)
        attrs, create_error = converted(item.entity, item.create_attrs)
        own, above = _signature(frame, item), [_signature(frame, a) for a in at.above]
        repeats = [F.upper(a) == F.upper(own) for a, it in zip(above, at.above) if _may_repeat(it, item)]
        error, category = L.node_error(
            F.lit(at.depth), F.lit(at.limit), reduce(or_, repeats, F.lit(False)), F.lit(item.attribute), own,
            F.concat_ws(" -> ", *above), key_error,
        )
        # Create attributes win over keys of the same name.
        values = F.map_concat(_map_of(keys), _map_of(attrs)) if item.create and keys else no_map
        flat.append(
            F.struct(
                F.lit(at.order).alias("ord"),
                F.lit(at.parent).alias("parent"),
                F.lit(at.path).alias("path"),
                F.lit(item.attribute).alias("attribute"),
                F.lit(at.depth).alias("depth"),
                F.lit(item.entity).alias("entity"),
                F.lit(item.create).alias("create"),
                F.lit(at.above[-1].entity if at.above else None).cast("string").alias("holder"),
                (K.identity_of(keys) if keys else nothing).alias("identity"),
                values.alias("create_values"),
                (create_error if item.create else nothing).alias("create_error"),
                error.alias("error"),
                category.alias("category"),
            )
        )
    return F.array(*flat)


def payloads_from_table(
    frame: DataFrame,
    catalog: Catalog,
    entity: str,
    keys: Mapping[str, Column],
    attrs: Mapping[str, Column],
    lookups: Sequence[Lookup] = (),
    message_id: Column | None = None,
    idx: Column | None = None,
    id: Column | None = None,
    present: Column | None = None,
    options: Options = Options(),
) -> DataFrame:
    """Rows ready for ``upsert_rows``, straight from typed columns.

    ``present`` names the attributes a row supplies (array of lower-case names); without it
    all are supplied and a null value clears the column.
    """
    both = [
        F.lit(f"KeyAttribute '{n}' must not also be present in Attributes.") for n in keys if n in attrs
    ]
    attr_errors, attr_texts = _checked(frame, catalog, entity, attrs, "Field")
    key_problems, key_texts = _checked(frame, catalog, entity, keys, "KeyAttribute")
    if entity.lower() not in catalog.entities:
        problems = [F.lit(f"Entity '{entity}' does not exist in the early-bound model.")]
    else:
        problems = attr_errors + key_problems + both
    errors = F.filter(F.array(*problems), lambda e: e.isNotNull()) if problems else F.array().cast("array<string>")
    supplied = _map_of(attr_texts)
    if present is not None:
        supplied = F.map_filter(supplied, lambda name, _: F.array_contains(present, name))
    typed_keys = key_texts if len(key_texts) == len(keys) else {}
    return frame.select(
        (message_id if message_id is not None else F.col("message_id")).alias("message_id"),
        (idx if idx is not None else F.lit(0)).cast("int").alias("idx"),
        F.lit(False).alias("is_null"),
        F.lit(entity).alias("entity"),
        F.lit(entity.lower()).alias("entity_name"),
        (F.lower(id) if id is not None else F.lit(None).cast("string")).alias("id"),
        F.lit(None).cast("string").alias("source"),
        _nodes(frame, lookups, options).alias("nodes"),
        *([_settled_nodes(frame, catalog, lookups, options).alias("settled_nodes")] if lookups else []),
        F.array(*[F.lit(item.attribute) for item in lookups]).cast("array<string>").alias("lookup_names"),
        K.signature_of(entity, _json_forms(frame, keys)).alias("sig"),
        F.when(F.size(errors) > 0, errors).alias("errors"),
        _map_of(key_texts).alias("key_values"),
        F.map_concat(supplied, _map_of(key_texts)).alias("values"),
        K.identity_of(typed_keys).alias("identity"),
        F.array(*[F.lit(n) for n in sorted(typed_keys)]).cast("array<string>").alias("key_names"),
    )


def profile_of(
    entity: str, keys: Mapping[str, Column], lookups: Sequence[Lookup] = (), id: Column | None = None
) -> Profile:
    """What ``upsert_rows`` would otherwise find out with a pass over the rows."""
    shapes, levels = {(entity.lower(), tuple(sorted(n.lower() for n in keys)))}, 0
    level = list(lookups)
    while level:
        levels += 1
        shapes |= {(item.entity.lower(), tuple(sorted(n.lower() for n in item.keys))) for item in level}
        level = [below for item in level for below in item.nested]
    return Profile(sorted(shapes), levels, id is not None)
