"""Strict JSON parsing that keeps member order, raw text and value kinds.

A *bag* is ``MAP<STRING, STRUCT<kind, raw>>``: member name -> what kind of JSON
value it had (``null bool int number string array object``) and its text. Strings
are unquoted, nested values stay JSON text, so the next level can be parsed from
them when it is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Types of a VARIANT; whatever else is no text is a number.
_SCALARS = {"STRING": "string", "BIGINT": "int", "BOOLEAN": "bool"}

BAG_DDL = "map<string,struct<kind:string,raw:string>>"

# A decimal with more digits than a double holds travels as a text with this character before it,
# because the parser passes numbers of nested values through doubles.
_EXACT = "\ue000"
_LONG_DECIMAL = r"(?=[0-9.\-]{17})-?(?:0|[1-9][0-9]*+)\.[0-9]++(?![0-9.eE+\-])"
_BEFORE = r"""(?:"(?:[^"\\]++|\\.)*+"|[^"0-9\-]++|(?!""" + _LONG_DECIMAL + r""")[\-0-9][0-9.eE+\-]*+)*+"""


def exact_decimals(body: Column) -> Column:
    """``body`` with decimals of 17 characters or more, outside strings, as marked texts."""
    marked = F.regexp_replace(body, rf"(?s)\G({_BEFORE})({_LONG_DECIMAL})", f'$1"{_EXACT}$2"')
    return F.when(body.rlike(r"[0-9.]{16}"), marked).otherwise(body)


def _is_exact(raw: Column) -> Column:
    return F.coalesce(F.startswith(raw, F.lit(_EXACT)), F.lit(False)) & raw.rlike(rf"^{_EXACT}{_LONG_DECIMAL}$")


def plain_text(raw: Column) -> Column:
    """JSON text of a nested value as it was written, without marks."""
    return F.when(F.contains(raw, F.lit(_EXACT)), F.regexp_replace(raw, rf'"{_EXACT}({_LONG_DECIMAL})"', "$1")).otherwise(raw)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def kind_of(raw: Column, value: Column) -> Column:
    """Kind of a value from its raw text and its VARIANT. Integers are told apart from other numbers.

    Nested values are recognised by their outermost level only; naming their whole schema, or
    taking their members out, would walk them to the end.
    """
    first = F.substring(raw, 1, 1)
    kinds = F.create_map(*[F.lit(t) for pair in _SCALARS.items() for t in pair])
    string = F.lit("string")
    return (
        F.when(raw.isNull(), "null")
        .when(first == "{", F.when(F.try_variant_get(value, "$", "struct<>").isNotNull(), "object").otherwise(string))
        .when(first == "[", F.when(F.try_variant_get(value, "$", "array<struct<>>").isNotNull(), "array").otherwise(string))
        .otherwise(F.coalesce(F.try_element_at(kinds, F.schema_of_variant(value)), F.lit("number")))
    )


def _zip_bag(raw: Column, variants: Column, fold_names: bool) -> Column:
    name = (lambda key: F.lower(key)) if fold_names else (lambda key: key)
    return F.map_from_entries(
        F.zip_with(
            F.map_entries(raw),
            F.map_values(variants),
            lambda e, v: F.struct(
                name(e["key"]).alias("key"),
                F.when(
                    _is_exact(e["value"]), F.struct(F.lit("number").alias("kind"), F.substr(e["value"], F.lit(2)).alias("raw"))
                )
                .otherwise(F.struct(kind_of(e["value"], v).alias("kind"), e["value"].alias("raw")))
                .alias("value"),
            ),
        )
    )


def bag(text: Column, fold_names: bool = False) -> Column:
    """Parse one JSON object into a bag. Null for anything that is not an object."""
    return _zip_bag(
        F.from_json(text, "map<string,string>", _STRICT), F.from_json(text, "map<string,variant>", _STRICT), fold_names
    )


def bags_by_name(text: Column) -> Column:
    """Parse one JSON object of objects into a map of bags with lower-case names, in one go.

    Null values stay null. Null when a value is something else, or the text is.
    """
    raw, variants = (F.from_json(text, f"map<string,map<string,{of}>>", _STRICT) for of in ("string", "variant"))
    return F.map_from_entries(
        F.zip_with(
            F.map_entries(raw),
            F.map_values(variants),
            lambda e, v: F.struct(e["key"].alias("key"), _zip_bag(e["value"], v, fold_names=True).alias("value")),
        )
    )


def texts_by_name(text: Column) -> Column:
    """``bags_by_name`` without kinds: a map of maps of raw texts, for objects whose kinds were checked."""
    read = F.map_from_entries(
        F.transform(
            F.map_entries(F.from_json(text, "map<string,map<string,string>>", _STRICT)),
            lambda e: F.struct(e["key"].alias("key"), F.transform_keys(e["value"], lambda name, _: F.lower(name)).alias("value")),
        )
    )
    # A name given twice may first have had another kind of value: only the last one counts.
    one_by_one = F.transform_values(
        bag(text), lambda _, v: F.transform_values(bag(v["raw"], fold_names=True), lambda _, m: m["raw"])
    )
    return F.coalesce(read, one_by_one)


def bags(text: Column) -> Column:
    """Parse one JSON array of objects into an array of bags with lower-case names.

    Null elements stay null. Null when the text is no array or an element is something else.
    """
    return F.zip_with(
        F.from_json(text, "array<map<string,string>>", _STRICT),
        F.from_json(text, "array<map<string,variant>>", _STRICT),
        lambda raw, variants: _zip_bag(raw, variants, fold_names=True),
    )


def document(body: Column) -> Column:
    """The body as a bag with lower-case names, if it is exactly one well-formed JSON object.

    Reading it as the only element of an array is what makes the parser look at the whole
    text: it would accept an object with anything behind it. Decimals keep all their digits, at
    any depth; a string that is U+E000 and such a decimal reads as the number.
    """
    return _let(bags(F.concat(F.lit("["), exact_decimals(body), F.lit("]"))), lambda d: F.when(F.size(d) == 1, F.get(d, F.lit(0))))


def is_null_document(body: Column) -> Column:
    return body.rlike(r"^[ \t\r\n]*null[ \t\r\n]*$")


def member(members: Column, name: str) -> Column:
    return F.try_element_at(members, F.lit(name))


def raw_of(members: Column, name: str) -> Column:
    """Raw text of a member, null when it is absent or an explicit null."""
    return member(members, name)["raw"]


def kind_of_member(members: Column, name: str) -> Column:
    """Kind of a member, null when it is absent."""
    return member(members, name)["kind"]


def nests_deeper_than(body: Column, limit: int) -> Column:
    """True when brackets nest deeper than ``limit``.

    Strings are removed first, then all innermost bracket pairs once per level.
    What is left after ``limit`` rounds was nested deeper.
    """
    bare = F.regexp_replace(body, r"(?s)\\.", "")
    bare = F.regexp_replace(bare, r'"[^"]*+"', "")
    brackets = F.regexp_replace(bare, r"[^\[\]{}]++", "")
    left = F.aggregate(
        F.sequence(F.lit(1), F.lit(limit)),
        brackets,
        lambda acc, _: F.when(acc == "", acc).otherwise(F.regexp_replace(acc, r"\[\]|\{\}", "")),
    )
    return F.when(F.length(brackets) <= 2 * limit, F.lit(False)).otherwise(left != "")
