"""The whole upsert: messages or table rows in, new tables and results out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.catalog import Catalog
from weftline.config import Options
from weftline.functions.keys import key_names
from weftline.operators import lookups as L
from weftline.operators import merge as M
from weftline.operators import resolve as R
from weftline.operators import results as S
from weftline.operators.hot import hot_keys
from weftline.operators.validate import validate_and_convert
from weftline.session import configure, cut_lineage
from weftline.sources.messages import explode_payloads, parse_batches


@dataclass
class Decision:
    """What each row does, before anything is merged."""

    rows: DataFrame  # one per payload: final_id, action, created, error, category, errors, values
    writes: DataFrame  # the same without ``created``
    outcomes: DataFrame | None  # lookups, None when no row has any
    lookup_levels: int
    records: DataFrame | None  # records created by lookups
    profile: R.Profile


@dataclass
class UpsertOutcome:
    results: DataFrame
    traces: DataFrame | None
    lookup_levels: int
    # Folded changes per record: entity_name, id, exists, values. What a table format with
    # row-level writes needs instead of ``tables``.
    changes: DataFrame
    tables: dict[str, DataFrame]
    status: DataFrame


def profile_rows(rows: DataFrame) -> R.Profile:
    """One pass over the parsed rows: key sets in use, depth of lookups, whether ids are given."""
    own = F.array(
        F.struct(
            F.col("entity_name"),
            F.col("key_names"),
            F.lit(-1).alias("depth"),
            F.col("id").isNotNull().alias("given"),
        )
    )
    below = F.transform(
        "nodes",
        lambda n: F.struct(
            F.lower(n["entity"]).alias("entity_name"),
            F.array_distinct(key_names(F.transform_keys(n["keys"], lambda k, _: F.lower(k)))).alias("key_names"),
            n["depth"].alias("depth"),
            F.lit(False).alias("given"),
        ),
    )
    found = (
        rows.where(F.col("errors").isNull())
        .select(F.explode(F.concat(own, below)).alias("k"))
        .groupBy("k.entity_name", "k.key_names")
        .agg(F.max("k.depth").alias("depth"), F.max("k.given").alias("given"))
        .collect()
    )
    shapes = sorted({(r["entity_name"], tuple(r["key_names"])) for r in found})
    levels = max((r["depth"] for r in found), default=-1) + 1
    return R.Profile(shapes, levels, any(r["given"] for r in found))


def decide(
    validated: DataFrame,
    targets: Mapping[str, DataFrame],
    catalog: Catalog,
    options: Options = Options(),
    salt: str = "",
    profile: R.Profile | None = None,
    made: DataFrame | None = None,
) -> Decision:
    """Resolve lookups and own keys, choose create or update, order rows of the same record.

    With a ``profile`` (``sources.tables.profile_of``) no pass over the rows is needed to plan.
    ``made`` are records (entity_name, identity, id) that lookups find besides those of the tables.
    """
    rows = validated
    profile = profile or profile_rows(rows)
    levels = profile.levels
    valid = rows.where(F.col("errors").isNull())
    own_requests = valid.where(F.col("id").isNull()).select("entity_name", "identity")

    nodes = None
    requests = own_requests
    if levels > 0:
        nodes = cut_lineage(L.explode_lookups(valid, catalog, targets))
        requests = own_requests.unionByName(nodes.where(F.col("error").isNull()).select("entity_name", "identity"))
    matches = cut_lineage(R.match_keys(requests, targets, catalog, profile.shapes))
    hot = hot_keys(requests)

    outcomes = records = None
    bare = rows
    if "nodes" in rows.columns:
        # Of the lookups only this is still needed; joins then move rows without them.
        bare = rows.withColumn("misplaced", M.first_misplaced(rows, targets, catalog))
        bare = bare.drop("nodes", "settled_nodes", "lookup_names")
    referenced = bare.withColumn("lookup_error", F.lit(None).cast("string")).withColumn(
        "lookup_category", F.lit(None).cast("string")
    )
    if nodes is not None:
        findable = matches
        if made is not None:
            there = made.select("entity_name", "identity", F.lit(1).cast("bigint").alias("match_count"), F.col("id").alias("match_id"))
            findable = matches.unionByName(there)
        outcomes = L.resolve_lookups(cut_lineage(L.with_matches(nodes, findable, hot)), levels, targets, catalog, salt, hot)
        records = cut_lineage(L.created_records(outcomes, nodes))
        referenced = L.attach_references(bare, outcomes)

    known_ids = R.match_ids(valid, targets, catalog) if profile.given else None
    acted = R.decide_action(R.resolve_keys(referenced, matches, hot), known_ids, salt)
    # A value, attribute or entity without a place is this row's error, not a loss.
    acted = acted.withColumn("_refusal", M.write_refusals(acted, targets, catalog))
    if profile.given:
        acted = _with_changed_keys(cut_lineage(acted))
    acted = acted.withColumn("error", F.coalesce("error", "_refusal")).drop("_refusal")
    category = (
        F.when(F.col("errors").isNotNull(), "Validation")
        .when(F.col("lookup_error").isNotNull(), F.col("lookup_category"))
        .when(F.col("error").isNotNull(), "Permanent")
    )
    acted = (
        acted.withColumn("category", category)
        .withColumn(
            "error",
            F.when(F.col("errors").isNotNull(), F.array_join("errors", "; ")).otherwise(
                F.coalesce("lookup_error", "error")
            ),
        )
        .drop("lookup_error", "lookup_category", "misplaced")
    )
    creating = F.col("error").isNull() & (F.col("action") == "create")
    acted = R.free_ids(cut_lineage(acted), "final_id", creating, targets, catalog, salt)
    return Decision(M.sequence_changes(acted, records), acted, outcomes, levels, records, profile)


def _with_changed_keys(acted: DataFrame) -> DataFrame:
    """Rows whose key an earlier row gave to another record update that record."""
    failed = F.coalesce(F.array_join("errors", "; "), F.col("lookup_error"), F.col("error"), F.col("_refusal"))
    changed = cut_lineage(R.ids_as_of(acted.withColumn("error", failed)))
    if changed.isEmpty():
        return acted
    now = F.col("as_of_id")
    return (
        acted.join(changed, ["message_id", "idx"], "left")
        .withColumn("error", F.when(now.isNull(), F.col("error")))
        .withColumn("action", F.when(now.isNotNull(), "update").otherwise(F.col("action")))
        .withColumn("final_id", F.coalesce(now, "final_id"))
        .drop("as_of_id")
    )


def conflicting_rows(decision: Decision, fresh: Mapping[str, DataFrame], catalog: Catalog) -> DataFrame:
    """(message_id, idx) of rows that the tables as they are now contradict.

    A record to create is there, a record to update or to point to is gone, for the row itself or
    for any of its lookups. Rows that rely on a record which such a row's lookups create are in
    conflict too, until nothing is added.
    """
    place, name = ["message_id", "idx"], ["entity_name", "identity"]
    rows, shapes = decision.writes.where(F.col("error").isNull()), decision.profile.shapes
    creates = rows.where((F.col("action") == "create") & F.col("identity").isNotNull()).select(*place, *name)
    points = rows.where(F.col("action") == "update").select(*place, "entity_name", F.col("final_id").alias("id"))
    if decision.outcomes is not None:
        nodes = decision.outcomes.where(F.col("error").isNull())
        fresh_made = decision.records.select("entity_name", "id").distinct().withColumn("_made", F.lit(True))
        nodes = nodes.withColumnRenamed("resolved_id", "id").join(fresh_made, ["entity_name", "id"], "left")
        creates = creates.unionByName(nodes.where("_made").select(*place, *name))
        points = points.unionByName(nodes.where(F.col("_made").isNull()).select(*place, "entity_name", "id"))
    appeared = R.match_keys(creates.select(*name), fresh, catalog, shapes).select(*name)
    found = creates.join(appeared, name, "left_semi").select(*place)
    there = R.match_ids(points, fresh, catalog).select("entity_name", "id")
    found = found.unionByName(points.join(there, ["entity_name", "id"], "left_anti").select(*place))
    if decision.profile.given:
        # A given id that was not there may be there now.
        gone = decision.writes.where(F.col("id").isNotNull() & (F.col("category") == "Permanent")).select(*place, "entity_name", "id")
        back = R.match_ids(gone, fresh, catalog).select("entity_name", "id")
        found = found.unionByName(gone.join(back, ["entity_name", "id"], "left_semi").select(*place))
    found = cut_lineage(found.distinct())
    if found.isEmpty() or (decision.outcomes is None and not decision.profile.given):
        return found
    count = found.count()
    while True:
        more = found
        if decision.outcomes is not None:
            lost = decision.outcomes.where("was_created").join(found, place, "left_semi").select(*name).distinct()
            more = more.unionByName(creates.join(lost, name, "left_semi").select(*place))
        if decision.profile.given:
            # Rows of one key are decided together: one may have given the key to another record.
            keyed = decision.writes.where(F.col("identity").isNotNull()).select(*place, *name)
            keys = keyed.join(found, place, "left_semi").select(*name).distinct()
            more = more.unionByName(keyed.join(keys, name, "left_semi").select(*place))
        found = cut_lineage(more.distinct())
        now = found.count()
        if now == count:
            return found
        count = now


def decide_again(
    decision: Decision,
    validated: DataFrame,
    fresh: Mapping[str, DataFrame],
    catalog: Catalog,
    options: Options = Options(),
    salt: str = "",
) -> Decision:
    """Second and last try for the rows in conflict with the tables as they are now; all others stay."""
    place = ["message_id", "idx"]
    conflicts = conflicting_rows(decision, fresh, catalog)
    if conflicts.isEmpty():
        return decision
    kept = decision.writes.join(conflicts, place, "left_anti")
    records = outcomes = made = None
    if decision.outcomes is not None:
        outcomes = decision.outcomes.join(conflicts, place, "left_anti")
        records = decision.records.join(conflicts, place, "left_anti")
        made = outcomes.where("was_created").select("entity_name", "identity", F.col("resolved_id").alias("id"))
    second = decide(validated.join(conflicts, place, "left_semi"), fresh, catalog, options, salt, decision.profile, made)
    writes = cut_lineage(kept.unionByName(second.writes))
    if second.outcomes is not None:
        outcomes = cut_lineage(outcomes.unionByName(second.outcomes))
        records = records.unionByName(second.records)
    return Decision(M.sequence_changes(writes, records), writes, outcomes, decision.lookup_levels, records, decision.profile)


def changes_of(decision: Decision, phase: int = 1) -> DataFrame:
    """All writes of a decision; records made for lookups come before the rows themselves."""
    rows = decision.writes.where(F.col("error").isNull()).select(
        "entity_name",
        F.col("final_id").alias("id"),
        F.struct(F.lit(phase).alias("phase"), "message_id", "idx", F.lit("").alias("ord")).alias("seq"),
        (F.col("action") == "update").alias("exists"),
        "values",
    )
    if decision.records is None:
        return rows
    return rows.unionByName(
        decision.records.select(
            "entity_name",
            "id",
            F.struct(F.lit(phase - 1).alias("phase"), "message_id", "idx", "ord").alias("seq"),
            F.lit(False).alias("exists"),
            "values",
        )
    )


def results_of(decision: Decision) -> DataFrame:
    rows = decision.rows
    return S.success_results(rows.where(F.col("error").isNull())).unionByName(
        S.error_results(rows.where(F.col("error").isNotNull()))
    )


def upsert_rows(
    validated: DataFrame,
    targets: Mapping[str, DataFrame],
    catalog: Catalog,
    options: Options = Options(),
    salt: str = "",
    profile: R.Profile | None = None,
    fresh: Callable[[], Mapping[str, DataFrame] | None] | None = None,
) -> UpsertOutcome:
    """Upsert rows that are already validated or came typed from a table.

    ``fresh`` is asked just before the merge for the tables as they are then, and answers None
    when nothing was committed since ``targets`` were read. Rows that those tables contradict are
    decided once more, lookups included, and everything is merged into them.
    """
    configure(validated.sparkSession)
    decision = decide(validated, targets, catalog, options, salt, profile)
    now = fresh() if fresh is not None else None
    if now is not None:
        targets = now
        decision = decide_again(decision, validated, targets, catalog, options, salt)
    results = results_of(decision)
    changes = M.fold_changes(changes_of(decision))
    return UpsertOutcome(
        results=results,
        traces=L.lookup_traces(decision.outcomes) if decision.outcomes is not None else None,
        lookup_levels=decision.lookup_levels,
        changes=changes,
        tables=M.merge_entities(targets, changes, catalog),
        status=S.batch_status(results, options),
    )


def upsert_batch(
    messages: DataFrame,
    targets: Mapping[str, DataFrame],
    catalog: Catalog,
    options: Options = Options(),
    channel: str = "request",
    salt: str = "",
    fresh: Callable[[], Mapping[str, DataFrame] | None] | None = None,
) -> UpsertOutcome:
    """Messages (message_id, body, correlation_id) against the entity tables.

    Refused messages appear in ``status`` with the status and text of their guard. ``fresh`` is
    as in ``upsert_rows``; ``sinks.newer_tables`` answers it for tables kept in versions.
    """
    configure(messages.sparkSession)
    payloads = explode_payloads(parse_batches(messages, options, channel), keep_refused=True)
    # Bodies are read and parsed once; everything below works on this table.
    rows = cut_lineage(validate_and_convert(payloads, catalog, options))
    outcome = upsert_rows(rows.where(F.col("idx").isNotNull()), targets, catalog, options, salt, fresh=fresh)
    outcome.status = S.message_status(rows, outcome.results, options)
    return outcome


def with_traces(outcome: UpsertOutcome) -> DataFrame:
    """Results with their lookup traces as nested JSON; failed rows have none."""
    if outcome.traces is None:
        return outcome.results.withColumn("LookupTraces", F.lit(None).cast("string"))
    nested = L.nest_traces(outcome.traces, outcome.lookup_levels)
    return outcome.results.join(nested, ["message_id", "idx"], "left").withColumn(
        "LookupTraces", F.when(F.col("ErrorCategory") == "None", F.col("LookupTraces"))
    )
