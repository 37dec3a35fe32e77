"""Business keys to record ids.

All keys of a run, own keys and lookup keys alike, are first reduced to distinct
(entity, key set, values) and then matched with one join, so a parent that millions
of rows point to is looked up once.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.catalog import Catalog
from weftline.functions import keys as K
from weftline.functions.text import message
from weftline.operators.hot import join_unique
from weftline.operators.ranges import last_before
from weftline.session import cut_lineage, spread_small_input

# (entity, sorted key column names)
Shape = tuple[str, tuple[str, ...]]


@dataclass(frozen=True)
class Profile:
    """What a set of rows needs: key sets in use, how deep lookups nest, whether ids are given."""

    shapes: list[Shape]
    levels: int
    given: bool


def key_shapes(requests: DataFrame) -> list[Shape]:
    """Which sets of key columns are used. Reads names only, as many sets as there are; a set is data in the plan."""
    found = requests.where(F.size("key_names") > 0).select("entity_name", "key_names").distinct().collect()
    return sorted((r["entity_name"], tuple(r["key_names"])) for r in found)


def scan_keys(target: DataFrame, catalog: Catalog, entity: str, names: Sequence[str]) -> DataFrame:
    """Id and join text of the table rows, reading the id and the key columns only."""
    columns = {n: (F.col(n), catalog.entities[entity][n].type) for n in names}
    return target.where(K.all_keys_set([c for c, _ in columns.values()])).select(
        F.lit(entity).alias("entity_name"),
        K.table_identity(columns).alias("identity"),
        F.col(catalog.id_column(entity)).cast("string").alias("match_id"),
    )


#: Bits of the filter of wanted keys, at most: 8 MB. It has sixteen for each key.
FILTER_BITS = 1 << 26


def wanted_filter(wanted: DataFrame) -> DataFrame | None:
    """A Bloom filter of (entity_name, identity) as one row with an array of 64-bit words, or None.

    Two bits are set for each key. Beyond ``FILTER_BITS`` / 4 keys it would let too much pass
    and is not made.
    """
    keys = wanted.count()
    bits = 1 << max(10, (16 * keys - 1).bit_length())
    if keys == 0 or bits > 4 * FILTER_BITS:
        return None
    bits = min(bits, FILTER_BITS)
    places = wanted.select(F.explode(_places(F.col("entity_name"), F.col("identity"), F.lit(bits))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))).alias("w")
    )
    every = wanted.sparkSession.range(bits // 64).join(words, "id", "left")
    dense = F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")))), lambda x: x["w"])
    return every.agg(dense.alias("filter"))


def _places(entity: Column, identity: Column, bits: Column) -> Column:
    h = F.xxhash64(entity, identity)
    return F.array(F.pmod(h, bits), F.pmod(F.shiftright(h, 32), bits)).cast("array<bigint>")


def may_be_wanted(entity: Column, identity: Column, words: Column) -> Column:
    """False only for keys that are not wanted. Without lambdas, which are not compiled."""
    places = _places(entity, identity, F.size(words).cast("bigint") * 64)

    def is_set(p: Column) -> Column:
        return F.call_function("bit_get", F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1

    return is_set(F.get(places, F.lit(0))) & is_set(F.get(places, F.lit(1)))


#: Columns for which a number holds the bits.
_BITS = 62


def scan_key_sets(
    target: DataFrame, catalog: Catalog, entity: str, sets: Sequence[Sequence[str]], asked: DataFrame | None = None
) -> DataFrame:
    """``scan_keys`` for many sets of key columns in one scan: a row gives one join text per set.

    The sets are an array in the plan, so its size does not grow with their number. With the
    one-row filter ``asked`` texts that are not asked for leave before a row becomes many.
    """
    if len(sets) == 1:
        return scan_keys(target, catalog, entity, sets[0])
    names = sorted({n for own in sets for n in own})
    words = range(0, len(names), _BITS)
    bit = {n: (i // _BITS, 1 << i % _BITS) for i, n in enumerate(names)}
    # A set is the bits of its columns. What is done for every row and set has no lambdas, so it is compiled.
    wanted = F.from_json(
        F.lit(json.dumps([[sum(bit[n][1] for n in own if bit[n][0] == w) for w in range(len(words))] for own in sets])), "array<array<bigint>>"
    )
    kinds = catalog.entities[entity]
    texts = {n: F.when(F.col(n).isNotNull(), K.table_identity({n: (F.col(n), kinds[n].type)})) for n in names}
    row = target.select(
        F.col(catalog.id_column(entity)).cast("string").alias("match_id"), *[t.alias(f"_t{i}") for i, t in enumerate(texts.values())]
    )
    # A key that is null has no text: its sets match nothing.
    null = [sum((F.when(F.col(f"_t{i}").isNull(), bit[n][1]).otherwise(0) for i, n in enumerate(names) if bit[n][0] == w), F.lit(0).cast("bigint")) for w in range(len(words))]
    # A row becomes as many as there are sets: one small file would be one long task.
    rows = spread_small_input(row).select("*", *[n.alias(f"_null{w}") for w, n in enumerate(null)]).select("*", F.explode(wanted).alias("_set"))
    for w in range(len(words)):
        rows = rows.where(F.get("_set", F.lit(w)).bitwiseAND(F.col(f"_null{w}")) == 0)
    parts = [F.when(F.get("_set", F.lit(bit[n][0])).bitwiseAND(F.lit(bit[n][1])) != 0, F.col(f"_t{i}")) for i, n in enumerate(names)]
    keyed = rows.select(F.lit(entity).alias("entity_name"), F.concat_ws(",", *parts).alias("identity"), "match_id")
    if asked is None:
        return keyed
    # One row of at most FILTER_BITS bits.
    return keyed.crossJoin(F.broadcast(asked)).where(may_be_wanted(F.lit(entity), F.col("identity"), F.col("filter"))).drop("filter")


def match_keys(
    requests: DataFrame, targets: Mapping[str, DataFrame], catalog: Catalog, shapes: Sequence[Shape]
) -> DataFrame:
    """Distinct (entity_name, identity) that exist, with ``match_count`` and an id."""
    wanted = requests.where(F.col("identity").isNotNull()).select("entity_name", "identity").distinct()
    sets: dict[str, list[tuple[str, ...]]] = {}
    for entity, names in shapes:
        if entity in targets and names:
            sets.setdefault(entity, []).append(names)
    bloom = None
    if any(len(own) > 1 for own in sets.values()):
        wanted = cut_lineage(wanted)
        bloom = wanted_filter(wanted)
        bloom = None if bloom is None else cut_lineage(bloom)
    scans = [scan_key_sets(targets[entity], catalog, entity, own, bloom) for entity, own in sets.items()]
    if not scans:
        return wanted.where(F.lit(False)).select(
            "entity_name", "identity", F.lit(0).cast("bigint").alias("match_count"), F.lit("").alias("match_id")
        )
    table_keys = scans[0]
    for scan in scans[1:]:
        table_keys = table_keys.unionByName(scan)
    # Inner join, so whichever side is small is the one that may be broadcast.
    return (
        table_keys.join(wanted, ["entity_name", "identity"])
        # A key that very many table rows share is counted in parts first.
        .groupBy("entity_name", "identity", F.pmod(F.hash("match_id"), F.lit(32)).alias("_part"))
        .agg(F.count("*").alias("match_count"), F.min("match_id").alias("match_id"))
        .groupBy("entity_name", "identity")
        .agg(F.sum("match_count").alias("match_count"), F.min("match_id").alias("match_id"))
    )


def match_ids(requests: DataFrame, targets: Mapping[str, DataFrame], catalog: Catalog) -> DataFrame:
    """Which of the given (entity_name, id) exist in their tables, in any case, with the table's spelling."""
    wanted = requests.where(F.col("id").isNotNull()).select("entity_name", F.lower("id").alias("_folded"), "id").distinct()
    tables = None
    for entity, target in targets.items():
        ids = target.select(
            F.lit(entity).alias("entity_name"), F.col(catalog.id_column(entity)).cast("string").alias("table_id")
        )
        tables = ids if tables is None else tables.unionByName(ids)
    found = tables.withColumn("_folded", F.lower("table_id")).join(wanted, ["entity_name", "_folded"])
    return found.groupBy("entity_name", "id").agg(F.min("table_id").alias("table_id"))


def free_ids(
    frame: DataFrame, column: str, creates: Column, targets: Mapping[str, DataFrame], catalog: Catalog, salt: str = ""
) -> DataFrame:
    """``frame`` with another id in ``column`` for ``creates`` whose id the table already holds.

    That happens when a record was created under a key and then given another key. Ids stay a
    hash of the key, with a number added, so a retried job still makes the same ones, and a
    record that lookups and payloads both would create gets one id. Only tables of entities
    with creates are read. ``frame`` is a written table.
    """
    number = 0
    while True:
        wanted = frame.where(creates).select("entity_name", F.lower(column).alias("id"))
        entities = {r["entity_name"] for r in wanted.select("entity_name").distinct().collect()}
        probed = {entity: target for entity, target in targets.items() if entity in entities}
        if not probed:
            return frame
        found = match_ids(wanted, probed, catalog).select("entity_name", F.col("id").alias("_id"), F.lit(True).alias("_taken"))
        found = cut_lineage(found)
        if found.isEmpty():
            return frame
        number += 1
        other = K.new_id(F.col("entity_name"), F.col("identity"), f"{salt}#{number}")
        marked = frame.withColumn("_id", F.when(creates, F.lower(column))).join(found, ["entity_name", "_id"], "left")
        again = F.coalesce("_taken", F.lit(False))
        frame = cut_lineage(marked.withColumn(column, F.when(again, other).otherwise(F.col(column))).drop("_taken", "_id"))


def _join_if_set(rows: DataFrame, found: DataFrame, column: str, hot: Sequence[int] = ()) -> DataFrame:
    """Left join on (entity_name, ``column``) that deals rows without a value evenly.

    Most rows give no id and invalid rows have no key. As nulls they would all meet in one
    task; under a text of their own, which matches nothing, they are spread.
    """
    own = F.concat_ws(":", F.lit("none"), F.col("message_id").cast("string"), F.col("idx").cast("string"))
    keyed = rows.withColumn("_entity", F.when(F.col(column).isNotNull(), F.col("entity_name")).otherwise(own)).withColumn(
        "_value", F.coalesce(column, own)
    )
    renamed = found.withColumnRenamed("entity_name", "_entity").withColumnRenamed(column, "_value")
    return join_unique(keyed, renamed, hot, ["message_id", "idx"], ["_entity", "_value"]).drop("_entity", "_value")


def resolve_keys(rows: DataFrame, matches: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """Add ``match_count`` and ``match_id`` to rows by their own key. A given id needs no match."""
    keyed = _join_if_set(rows, matches, "identity", hot)
    searched = F.col("id").isNull()
    return keyed.withColumn(
        "match_count", F.when(searched, F.coalesce("match_count", F.lit(0))).otherwise(F.lit(0))
    ).withColumn("match_id", F.when(searched, F.col("match_id")))


def ids_as_of(decided: DataFrame) -> DataFrame:
    """(message_id, idx, as_of_id): the id a row's key has by its place in the run, where an earlier row changed it.

    A row with a given id writes its key to that record, so later rows with the key mean that
    record, whatever the table says. Rows with an ``error`` change nothing. Only keys that a
    given id is written under are looked at, in ranges, so a hot key is not gathered.
    """
    position = ["message_id", "idx"]
    keyed = decided.where(F.col("identity").isNotNull()).select(
        "entity_name", "identity", *position,
        F.col("id").isNull().alias("_asks"),
        F.when(F.col("id").isNotNull() & F.col("error").isNull(), F.col("final_id")).alias("_sets"),
    )
    changed = keyed.where(F.col("_sets").isNotNull()).select("entity_name", "identity").distinct()
    concerned = keyed.join(changed, ["entity_name", "identity"], "left_semi")
    known = last_before(concerned, ["entity_name", "identity"], position, "_sets", "as_of_id")
    return known.where(F.col("_asks") & F.col("as_of_id").isNotNull()).select(*position, "as_of_id")


def ambiguity_error() -> Column:
    return F.when(
        F.col("match_count") > 1,
        message(
            "Multiple '", F.col("entity"), "' records (", F.least(F.col("match_count"), F.lit(3)),
            "+) found for KeyAttributes '", F.col("sig"), "'.",
        ),
    )


def reresolve_conflicts(
    conflicts: DataFrame, targets: Mapping[str, DataFrame], catalog: Catalog
) -> DataFrame:
    """Second and last try for rows whose write met a record that appeared or vanished.

    Only these rows are matched again, against the tables as they are now. A row with
    a given id keeps it: it stays in conflict if the id is still not there.
    """
    requests = conflicts.where(F.col("identity").isNotNull())
    matches = match_keys(requests, targets, catalog, key_shapes(requests))
    return decide_action(
        resolve_keys(conflicts.drop("match_count", "match_id", "action", "error", "final_id", "id_exists"), matches),
        match_ids(conflicts, targets, catalog),
    )


def decide_action(resolved: DataFrame, known_ids: DataFrame | None = None, salt: str = "") -> DataFrame:
    """Update when the id is known, else create; errors for ambiguous keys and for given ids that are gone.

    Adds ``action``, ``final_id`` and ``error`` (null when the row can be written).
    """
    if known_ids is None:
        checked = resolved.withColumn("id_exists", F.col("id").isNotNull()).withColumn("table_id", F.col("id"))
    else:
        checked = _join_if_set(resolved, known_ids.withColumn("id_exists", F.lit(True)), "id")
    # The record is written under its table's spelling of the id.
    found = F.coalesce("table_id", "id", F.when(F.col("match_count") == 1, F.col("match_id")))
    gone = F.when(
        F.col("id").isNotNull() & ~F.coalesce("id_exists", F.lit(False)),
        message("Entity '", F.col("entity"), "' with id '", F.col("id"), "' does not exist."),
    )
    return (
        checked.withColumn("error", F.coalesce(gone, ambiguity_error()))
        .withColumn("action", F.when(found.isNotNull(), "update").otherwise("create"))
        .withColumn("final_id", F.coalesce(found, K.new_id(F.col("entity_name"), F.col("identity"), salt)))
        .drop("table_id")
    )
