"""What may be written: attributes of every entity, their types and choices."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a type is called in error texts.
FRIENDLY_NAMES = {
    "string": "string",
    "guid": "guid",
    "bool": "bool",
    "int": "int",
    "long": "long",
    "decimal": "decimal",
    "double": "double",
    "float": "float",
    "datetime": "datetime",
    "money": "Money",
    "option": "OptionSetValue",
    "choices": "OptionSetValueCollection",
    "reference": "EntityReference",
    "binary": "Byte[]",
}

# Fixed value: attributes that are never writable.
RESTRICTED_PREFIX = "adx_identity_"

SPARK_TYPES = {
    "string": "string",
    "guid": "string",
    "bool": "boolean",
    "int": "int",
    "long": "bigint",
    "decimal": "decimal(38,10)",
    "money": "decimal(38,10)",
    "double": "double",
    "float": "float",
    "datetime": "timestamp",
    "choice": "int",
    "option": "int",
    "choices": "array<int>",
    "reference": "struct<entity:string,id:string>",
    "binary": "binary",
}

_SPEC_DDL = "map<string,map<string,struct<type:string,friendly:string,codes:map<string,int>>>>"

# A catalog is metadata: it is planned into the job as one literal. This bounds it.
MAX_ATTRIBUTES = 20_000
MAX_OPTIONS = 200_000


@dataclass(frozen=True)
class AttributeSpec:
    type: str
    option_set: str | None = None
    writable: bool = True

    @property
    def friendly(self) -> str:
        if self.type == "choice":
            return f"OptionSetValue ({self.option_set})"
        return FRIENDLY_NAMES[self.type]

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True, eq=False)
class Catalog:
    """``entities``: entity -> attribute -> spec. ``options``: option set -> name -> code."""

    entities: Mapping[str, Mapping[str, AttributeSpec]]
    options: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    # Name of the id column of each entity's table, "<entity>id" if not given.
    ids: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        count = 0
        for entity, attributes in self.entities.items():
            for name, spec in attributes.items():
                count += 1
                if entity != entity.lower() or name != name.lower():
                    raise ValueError(f"catalog names are lower case: {entity}.{name}")
                if spec.type not in SPARK_TYPES:
                    raise ValueError(f"unknown type {spec.type} of {entity}.{name}")
                if spec.type == "choice" and spec.option_set not in self.options:
                    raise ValueError(f"no options for {entity}.{name}")
        if count > MAX_ATTRIBUTES:
            raise ValueError(f"catalog has {count} attributes, at most {MAX_ATTRIBUTES} are allowed")
        if sum(map(len, self.options.values())) > MAX_OPTIONS:
            raise ValueError(f"catalog has more than {MAX_OPTIONS} options")

    def id_column(self, entity: str) -> str:
        return self.ids.get(entity, f"{entity}id")

    @staticmethod
    def from_rows(
        attributes: Iterable[tuple],
        options: Iterable[tuple[str, str, int]] = (),
        ids: Mapping[str, str] | None = None,
    ) -> Catalog:
        """Rows (entity, attribute, type[, option_set[, writable]]) and (option_set, name, code)."""
        entities: dict[str, dict[str, AttributeSpec]] = {}
        for entity, name, type_, *rest in attributes:
            entities.setdefault(entity.lower(), {})[name.lower()] = AttributeSpec(type_, *rest)
        sets: dict[str, dict[str, int]] = {}
        for option_set, name, code in options:
            sets.setdefault(option_set, {})[name.lower()] = int(code)
        return Catalog(entities, sets, dict(ids or {}))

    @staticmethod
    def from_frames(attributes: DataFrame, options: DataFrame | None = None) -> Catalog:
        """Catalog tables (entity, attribute, type, option_set, writable) and (option_set, name, code)."""
        rows = attributes.select("entity", "attribute", "type", "option_set", "writable")
        codes = options.select("option_set", "name", "code") if options is not None else None
        found = rows.limit(MAX_ATTRIBUTES + 1).collect()
        return Catalog.from_rows(
            [tuple(r) for r in found], [tuple(r) for r in codes.limit(MAX_OPTIONS + 1).collect()] if codes is not None else ()
        )

    @staticmethod
    def from_schemas(schemas: Mapping[str, T.StructType], ids: Mapping[str, str] | None = None) -> Catalog:
        """Derive the catalog from the schemas of the target tables."""
        rows = [
            (entity, f.name, _type_of(f.dataType)) for entity, schema in schemas.items() for f in schema.fields
        ]
        return Catalog.from_rows(rows, ids=ids)

    def attribute_rows(self) -> list[tuple]:
        return [
            (entity, name, spec.type, spec.option_set, spec.writable and not name.startswith(RESTRICTED_PREFIX))
            for entity, attributes in self.entities.items()
            for name, spec in attributes.items()
        ]

    def attribute_frame(self, spark: SparkSession) -> DataFrame:
        ddl = "entity string, attribute string, type string, option_set string, writable boolean"
        return spark.createDataFrame(self.attribute_rows(), ddl)

    def column(self) -> Column:
        """The catalog as one constant map column, folded at planning time."""
        payload = {
            entity: {
                name: {
                    "type": spec.type,
                    "friendly": spec.friendly,
                    "codes": dict(self.options[spec.option_set]) if spec.type == "choice" else None,
                }
                for name, spec in attributes.items()
            }
            for entity, attributes in self.entities.items()
        }
        return F.from_json(F.lit(json.dumps(payload)), _SPEC_DDL)


def _type_of(data_type: T.DataType) -> str:
    simple = {
        T.StringType: "string",
        T.BooleanType: "bool",
        T.ByteType: "int",
        T.ShortType: "int",
        T.IntegerType: "int",
        T.LongType: "long",
        T.DoubleType: "double",
        T.FloatType: "float",
        T.DecimalType: "decimal",
        T.TimestampType: "datetime",
        T.TimestampNTZType: "datetime",
        T.DateType: "datetime",
        T.BinaryType: "binary",
    }
    for spark_type, name in simple.items():
        if isinstance(data_type, spark_type):
            return name
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.IntegerType):
        return "choices"
    if isinstance(data_type, T.StructType) and {f.name for f in data_type.fields} == {"entity", "id"}:
        return "reference"
    raise ValueError(f"no attribute type for {data_type.simpleString()}")
