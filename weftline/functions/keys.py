"""Signatures for people, identities for joins, ids for new records."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import is_blank, trimmed
from weftline.functions.values import canonical, normalized_text

_SEPARATORS = r"([\\,=:])"


def escaped(text: Column) -> Column:
    """Backslash before every separator, so different key sets never read the same."""
    return F.regexp_replace(text, _SEPARATORS, r"\\$1")


def signature(entity: Column, keys: Column) -> Column:
    """``entity:name=value,...`` of a bag of keys, names sorted without regard to case.

    Null when there is no entity or no key.
    """
    ordered = F.array_sort(
        F.transform(
            F.map_entries(keys),
            lambda e: F.struct(
                F.upper(e["key"]).alias("sort"),
                e["key"].alias("key"),
                e["value"].alias("value"),
            ),
        )
    )
    pairs = F.transform(
        ordered,
        lambda e: F.concat(
            escaped(F.lower(e["key"])),
            F.lit("="),
            escaped(normalized_text(e["value"]["kind"], e["value"]["raw"])),
        ),
    )
    return F.when(
        ~is_blank(entity) & (F.coalesce(F.size(keys), F.lit(0)) > 0),
        F.concat(F.lower(entity), F.lit(":"), F.array_join(pairs, ",")),
    )


def folded(text: Column) -> Column:
    """Keys that differ only by case or outer spaces are one key."""
    return F.lower(trimmed(text))


def _pair(name: Column, text: Column) -> Column:
    # A null key has no "=": it equals other null keys of the batch and no table row.
    return F.when(text.isNull(), name).otherwise(F.concat(name, F.lit("="), escaped(folded(text))))


def identity(keys: Column) -> Column:
    """Join text of converted keys (``MAP<name, canonical text>``)."""
    ordered = F.array_sort(F.map_entries(keys))
    return F.array_join(F.transform(ordered, lambda e: _pair(e["key"], e["value"])), ",")


def signature_of(entity: str, keys: Mapping[str, tuple[Column, Column]]) -> Column:
    """``signature`` when the key names are known: name -> (kind, raw text)."""
    pairs = [
        F.concat(F.lit(re.sub(_SEPARATORS, r"\\\1", name.lower()) + "="), escaped(normalized_text(*keys[name])))
        for name in sorted(keys, key=str.upper)
    ]
    return F.concat(F.lit(f"{entity.lower()}:"), F.concat_ws(",", *pairs))


def identity_of(keys: Mapping[str, Column]) -> Column:
    """``identity`` when the key names are known: lower-case name -> canonical text."""
    return F.concat_ws(",", *[_pair(F.lit(name), keys[name]) for name in sorted(keys)])


def key_names(keys: Column) -> Column:
    return F.array_sort(F.map_keys(keys))


def table_identity(columns: Mapping[str, tuple[Column, str]]) -> Column:
    """The same join text for a table row: name -> (column, attribute type). Null if a key is null."""
    names = sorted(columns)
    return F.array_join(
        F.array(
            *[F.concat(F.lit(n + "="), escaped(folded(canonical(*columns[n])))) for n in names]
        ),
        ",",
    )


def all_keys_set(columns: Sequence[Column]) -> Column:
    condition = F.lit(True)
    for column in columns:
        condition = condition & column.isNotNull()
    return condition


def new_id(entity: Column, key_identity: Column, salt: str = "") -> Column:
    """Id of a record to create. The same key gives the same id, so a retried job creates nothing twice."""
    digest = F.sha2(F.concat_ws(":", entity, key_identity, F.lit(salt) if salt else F.lit(None).cast("string")), 256)
    part = lambda start, length: F.substring(digest, start, length)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
