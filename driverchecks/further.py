"""More queries over whole driver tables: writes, conflicts, changing keys, lookups in messages."""

from __future__ import annotations

import itertools
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverchecks import inputs as I
from driverchecks.queries import GEO_CATALOG, _customer_rows, _geo_targets
from weftline import Catalog, Options
from weftline.functions import keys as K
from weftline.operators import reports as P
from weftline.operators import resolve as R
from weftline.operators import results as S
from weftline.operators import triage as T
from weftline.plans.upsert import upsert_batch, upsert_rows
from weftline.session import shared_folder
from weftline.sources import buckets, sinks
from weftline.sources.documents import parse_account_documents
from weftline.sources.messages import stream_messages
from weftline.sources.tables import Lookup, payloads_from_table
from weftline.streaming.redelivery import start_redelivering_stream, stop_when_settled
from weftline.streaming.upsert_stream import StreamTargets, dead_letters, settle


def _outcomes(results: DataFrame, name: str) -> DataFrame:
    return results.select(
        F.col("message_id").alias(name), F.col("Id").alias("id"), F.col("Created").alias("created"),
        F.col("ErrorCategory").alias("category"), F.col("ErrorMessage").alias("error"),
    )


# --- writes that tables refuse ----------------------------------------------------------------

_NARROW = Catalog.from_rows(
    [("customer", "c_custkey", "guid"), ("customer", "c_name", "string"), ("customer", "c_nationkey", "int"), ("customer", "c_fax", "string")],
    ids={"customer": "c_custkey"},
)


def write_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Values too wide for their column and attributes without one are errors of their rows."""
    of = F.col("event_type")
    rows = payloads_from_table(
        I.events(spark, sf, spread=True), _NARROW, "customer", {"c_name": I.customer_key(F.col("user_id"))},
        {"c_nationkey": F.col("k") * 3, "c_fax": of}, message_id=F.col("event_id"),
        present=F.when(of == "click", F.array(F.lit("c_nationkey"))).when(of == "error", F.array(F.lit("c_fax"))).otherwise(F.array().cast("array<string>")),
    )
    narrow = I.customers(spark, sf).select("c_custkey", "c_name", F.col("c_nationkey").cast("tinyint"))
    return _outcomes(upsert_rows(rows, {"customer": narrow}, _NARROW).results, "event_id").drop("id", "created")


_LOOKED_UP = Catalog.from_rows(
    [
        ("order", "orderid", "guid"),
        ("order", "o_orderkey", "long"),
        ("order", "o_custkey", "reference"),
        ("order", "o_comment", "string"),
        ("customer", "c_custkey", "guid"),
        ("customer", "c_name", "string"),
        ("customer", "c_mktsegment", "string"),
        ("customer", "c_level", "int"),
        ("customer", "c_fax", "string"),
        ("customer", "c_nationkey", "reference"),
        ("nation", "n_nationkey", "guid"),
        ("nation", "n_name", "string"),
        ("nation", "n_regionkey", "reference"),
        ("region", "r_regionkey", "guid"),
        ("region", "r_name", "string"),
        ("ghost", "ghostid", "guid"),
        ("ghost", "g_name", "string"),
    ],
    ids={"customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey"},
)


def _order_message(lookups: Column, more: Column | str = "") -> Column:
    return F.concat(
        F.lit('{"EntityLogicalName":"order","KeyAttributes":{"o_orderkey":'), F.col("event_id").cast("string"),
        F.lit('},"Attributes":{},"Lookups":{'), lookups, F.lit("}"), F.lit(more) if isinstance(more, str) else more, F.lit("}"),
    )


def _definition(entity: str, key: str, value: Column, more: Column | str = "", create: bool = True) -> Column:
    return F.concat(
        F.lit(f'{{"EntityLogicalName":"{entity}","KeyAttributes":{{"{key}":"'), value,
        F.lit(f'"}},"CreateIfNotExists":{str(create).lower()}'), F.lit(more) if isinstance(more, str) else more, F.lit("}"),
    )


def _messages(spark: SparkSession, sf: str, payload: Column) -> DataFrame:
    """One message for ten events."""
    return I.as_messages(I.events(spark, sf).select("event_id", payload.alias("payload")))


def _per_event(results: DataFrame, *columns) -> DataFrame:
    """Results of messages of ten events, by event."""
    event = (F.col("message_id") * 10 + F.col("idx")).cast("bigint").alias("event_id")
    return results.select(event, *columns)



def lookup_create_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Records that lookups would create, refused by their tables; what was created is pointed to."""
    of, n = F.col("event_type"), F.col("event_id").cast("string")
    name = F.concat(F.lit("New#"), n)
    more = (
        F.when(of == "click", F.concat(F.lit(',"CreateAttributes":{"c_level":'), (F.col("k") * 3).cast("string"), F.lit("}")))
        .when(of == "error", F.lit(',"CreateAttributes":{"c_fax":"x"}'))
        .when(of == "purchase", F.concat(F.lit(',"NestedLookups":{"c_mktsegment":'), _definition("nation", "n_name", F.lit("NATION_1")), F.lit("}")))
        .otherwise("")
    )
    target = F.when(of == "signup", _definition("ghost", "g_name", name)).otherwise(_definition("customer", "c_name", name, more))
    targets = _geo_targets(spark, sf)
    targets["customer"] = targets["customer"].withColumn("c_level", F.lit(None).cast("tinyint"))
    out = upsert_batch(_messages(spark, sf, _order_message(F.concat(F.lit('"o_custkey":'), target))), targets, _LOOKED_UP)
    customers = out.tables["customer"].select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("points_to"))
    orders = out.tables["order"].select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey.id").alias("_id"))
    results = _per_event(out.results, F.col("ErrorCategory").alias("category"), F.col("ErrorMessage").alias("error"))
    return results.join(orders.join(customers, "_id"), "event_id", "left").select("event_id", "category", "error", "points_to")


def lookup_free_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the ids that lookups would give are in the table under other keys."""
    base = I.events(spark, sf, spread=True)
    free = F.concat(F.lit("Free#"), F.col("user_id").cast("string"))
    taken = base.where(F.col("user_id") % 2 == 0).select("user_id").distinct().select(
        F.upper(K.new_id(F.lit("customer"), F.concat(F.lit("c_name=free#"), F.col("user_id").cast("string")))).alias("c_custkey"),
        F.concat(F.lit("Moved#"), F.col("user_id").cast("string")).alias("c_name"),
    )
    targets = _geo_targets(spark, sf)
    targets["customer"] = targets["customer"].unionByName(taken, allowMissingColumns=True)
    rows = payloads_from_table(
        base, GEO_CATALOG, "order", {"o_orderkey": F.col("event_id")}, {},
        [Lookup("o_custkey", "customer", {"c_name": free}, create=True)], message_id=F.col("event_id"),
    )
    return upsert_rows(rows, targets, GEO_CATALOG).traces.select(
        F.col("message_id").alias("event_id"), F.col("ResolvedId").alias("resolved_id"), F.col("WasCreated").alias("was_created")
    )


# --- ids and keys that change -----------------------------------------------------------------


def given_ids_any_case(spark: SparkSession, sf: str) -> DataFrame:
    """Given ids match in any case; results name the table's spelling."""
    orders = I.spread_table(spark, sf, "orders")
    given = F.upper(F.concat(F.lit("Cust-"), (F.col("o_custkey") * 2).cast("string")))
    rows = payloads_from_table(
        orders, I.CUSTOMER_CATALOG, "customer", {"c_name": I.customer_key(F.col("o_custkey") * 2)}, {},
        message_id=F.col("o_orderkey"), id=given,
    )
    table = I.customers(spark, sf).withColumn("c_custkey", F.concat(F.lit("Cust-"), F.col("c_custkey")))
    return _outcomes(upsert_rows(rows, {"customer": table}, I.CUSTOMER_CATALOG).results, "o_orderkey")


def id_after_key_change(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth order gives its key to the record of another id; later orders with the key mean that record.

    A third of all orders have one key.
    """
    orders = I.spread_table(spark, sf, "orders")
    n = F.col("o_orderkey")
    number = F.when(n % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey") * 2)
    given = F.when(n % 10 == 0, ((F.col("o_custkey") * 7) % 2000 + 1).cast("string"))
    rows = payloads_from_table(
        orders, I.CUSTOMER_CATALOG, "customer", {"c_name": I.customer_key(number)}, {}, message_id=n, id=given
    )
    return _outcomes(upsert_rows(rows, {"customer": I.customers(spark, sf)}, I.CUSTOMER_CATALOG).results, "o_orderkey")


def conflict_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Decided on half of the customers and ten nations, committed when others had come and some gone."""
    everyone = _geo_targets(spark, sf)
    nations, people = everyone["nation"], everyone["customer"]
    base = {"customer": people.where(F.col("c_nationkey.id").try_cast("int") < 12), "nation": nations.where(F.col("n_nationkey").try_cast("int") < 10)}
    fresh = {"customer": people.where(F.col("c_custkey").try_cast("int") % 41 != 0), "nation": nations}
    nation = F.concat(F.lit("NATION_"), (F.col("k") % 40).cast("string"))
    rows = payloads_from_table(
        I.events(spark, sf, spread=True), GEO_CATALOG, "customer", {"c_name": I.customer_key(F.col("user_id") + 30 * F.col("k"))},
        {"c_mktsegment": F.col("event_type")}, [Lookup("c_nationkey", "nation", {"n_name": nation}, create=True)],
        message_id=F.col("event_id"),
    )
    out = upsert_rows(rows, base, GEO_CATALOG, fresh=lambda: fresh)
    traces = out.traces.select(
        F.col("message_id").alias("event_id"), F.col("ResolvedId").alias("nation_id"), F.col("WasCreated").alias("nation_created")
    )
    rows_left = out.tables["customer"].agg(F.count("*").alias("customers_after"))
    return _outcomes(out.results, "event_id").drop("error").join(traces, "event_id").crossJoin(F.broadcast(rows_left))


_MANY_COLUMNS = [f"k{i}" for i in range(1, 10)]
#: 300 sets of three to six of nine key columns.
_MANY_SETS = [c for size in (3, 4, 5, 6) for c in itertools.combinations(_MANY_COLUMNS, size)][:300]
_MANY_CATALOG = Catalog.from_rows(
    [("part", "p_partkey", "guid"), *[("part", c, "long") for c in _MANY_COLUMNS]], ids={"part": "p_partkey"}
)


def _many_keys(n: Column) -> dict[str, Column]:
    return {c: ((n * (2 * i + 3)) % (11 + 6 * i)).cast("bigint") for i, c in enumerate(_MANY_COLUMNS)}


def resolve_many_key_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Requests by 300 different sets of key columns, answered by one scan of the table."""
    n = F.col("p_partkey")
    target = I.table(spark, sf, "part").select(n.cast("string").alias("p_partkey"), *[v.alias(c) for c, v in _many_keys(n).items()])
    sets = F.from_json(F.lit(json.dumps(_MANY_SETS)), "array<array<string>>")
    names = F.get(sets, (F.col("event_id") % 300).cast("int"))
    values = _many_keys(F.col("event_id") % 2500 + 1)
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(c).alias("key"), v.cast("string").alias("value")) for c, v in values.items()]))
    chosen = F.map_filter(pairs, lambda name, _: F.array_contains(names, name))
    requests = I.events(spark, sf).select(F.lit("part").alias("entity_name"), K.identity(chosen).alias("identity"), K.key_names(chosen).alias("key_names"))
    matches = R.match_keys(requests, {"part": target}, _MANY_CATALOG, R.key_shapes(requests))
    return matches.select("identity", "match_count", F.col("match_id"))


# --- failure log and request log ----------------------------------------------------------------


def nested_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Events as causes of sixteen to an operation: a tree in even operations, one long chain in odd ones."""
    n, k = F.col("event_id") % 16, F.col("k")
    base = I.failures(spark, sf).withColumn("_n", F.col("op_id") * 4 + F.col("node_id")).select("_n", "fault_code", "message", "retry_after")
    types = F.array(*[F.lit(t) for t in ("TimeoutException", "ArgumentException", "Exception", "TaskCanceledException")])
    rows = I.events(spark, sf).select(
        F.col("event_id").alias("_n"), F.floor(F.col("event_id") / 16).alias("op_id"), n.cast("int").alias("node_id"),
        F.when(n > 0, F.when(F.floor(F.col("event_id") / 16) % 2 == 0, F.floor((n - 1) / 2)).otherwise(n - 1)).cast("int").alias("parent_id"),
        F.when((k * 3 + F.col("user_id")) % 4 < 3, "AggregateException").otherwise(F.get(types, (k % 4).cast("int"))).alias("exc_type"),
    )
    quiet = F.when(F.col("op_id") % 3 == 0, F.col("message")).otherwise("")
    return rows.join(base, "_n").select("op_id", "node_id", "parent_id", F.lit("update").alias("op_kind"), "exc_type", "fault_code", quiet.alias("message"), "retry_after")


def classify_nested_groups(spark: SparkSession, sf: str) -> DataFrame:
    return T.classify_groups(nested_failures(spark, sf))


def throttle_windows_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Five threads, each index many times: requests of one index go by their time."""
    log = I.request_log(spark, sf).withColumns(
        {"thread_id": (F.col("thread_id") % 5).cast("bigint"), "request_index": F.floor(F.col("request_index") / 50)}
    )
    return P.throttle_windows(P.request_numbers(log))


# --- what is written --------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/weftline/{name}-{uuid.uuid4().hex}"


def versioned_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of a table: the newest one, the one before, and a replay that changes nothing."""
    root, people = _scratch(spark, "versions"), I.customers(spark, sf)
    richer = people.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    sinks.write_entities({"customer": people}, root, 0)
    sinks.write_entities({"customer": richer}, root, 3)
    sinks.write_entities({"customer": people.limit(0)}, root, 3)
    old = sinks.read_version(spark, f"{root}/customer", before=3).select("c_custkey", F.col("c_acctbal").alias("before"))
    return sinks.read_version(spark, f"{root}/customer").select("c_custkey", "c_acctbal").join(old, "c_custkey")


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The request log as the report file says it."""
    path, log = _scratch(spark, "report"), I.request_log(spark, sf)
    sinks.write_report(log.select("thread_id", "request_index", "status_code", "success", "error"), path)
    return spark.read.schema("thread_id bigint, request_index bigint, status_code int, success boolean, error string").json(path)


def dead_letter_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages set aside by a batch that is replayed, and by the next."""
    path, bodies = _scratch(spark, "dead"), I.event_bodies(spark, sf)
    status = S.batch_status(I.event_results(spark, sf)).withColumn("error", F.lit(None).cast("string"))
    deliveries = bodies.withColumn("attempt", (F.col("message_id") % 3).cast("int"))
    for version, part in ((1, 0), (1, 1), (2, 1)):
        _, dead = settle(deliveries.where(F.col("message_id") % 2 == part), status, Options(max_deliveries=3))
        sinks.write_dead_letters(dead, path, version)
    return spark.read.option("basePath", path).parquet(path).select("message_id", F.col("version").cast("bigint").alias("batch"), "reason")


# --- typed rows and documents -----------------------------------------------------------------


def typed_row_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Columns whose type or text an attribute does not take."""
    n = F.col("event_id")
    day = F.when(n % 5 == 0, "2024-01").otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"))
    rows = payloads_from_table(
        I.events(spark, sf, spread=True), I.EVENT_CATALOG, "Event", {"number": n},
        {"k": F.when(n % 3 == 0, F.col("props")), "kind": F.when(n % 7 == 0, "nokind").otherwise(F.col("event_type")), "happened": day,
         "amount": F.col("value"), "large": F.when(n % 11 == 0, F.col("value") > 5)},
        message_id=n,
    )
    return rows.select(F.col("message_id").alias("event_id"), F.array_join("errors", "; ").alias("error"), "identity")


def guard_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Account documents with more contacts than are allowed."""
    parsed = parse_account_documents(I.account_bodies(spark, sf), Options(max_batch_items=2))
    return parsed.select("message_id", F.col("guard_status").alias("status"), F.col("guard_error").alias("error"))


# --- tables in buckets ------------------------------------------------------------------------


def bucketed_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of changes into a table of 64 buckets, each rewriting the buckets it touches."""
    path = f"{shared_folder(spark).rstrip('/')}/weftline/customer-{uuid.uuid4().hex}"
    buckets.make_table(I.customers(spark, sf), path, "c_custkey", 64)
    rows = _customer_rows(spark, sf)
    for version, part in enumerate((rows.where(F.col("message_id") % 1000 < 500), rows.where(F.col("message_id") % 1000 >= 500)), 1):
        outcome = upsert_rows(part, {"customer": buckets.read_table(spark, path)}, I.CUSTOMER_CATALOG)
        buckets.merge_changes(outcome.changes, path, I.CUSTOMER_CATALOG, "customer", version)
    return buckets.read_table(spark, path)


# --- streams ----------------------------------------------------------------------------------


def stream_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """Events as queued messages, all there at once; what fails is tried again by timers, three times in all.

    Some messages never succeed, some wait for a record that another message of the same batch makes.
    """
    n, m = F.col("event_id"), F.floor(F.col("event_id") / 10)
    late = F.concat(F.lit("Late#"), (m - F.when(m % 10 == 8, 1).otherwise(0)).cast("string"))
    own = F.concat(
        F.lit('{"EntityLogicalName":"customer","KeyAttributes":{"c_name":"'),
        F.when((m % 10 == 8) & (n % 10 == 0), late).otherwise(I.customer_key(F.col("user_id") + 30 * F.col("k"))),
        F.lit('"},"Attributes":{"c_mktsegment":'), F.when(n % 100 == 35, F.lit("5")).otherwise(F.lit('"S"')), F.lit("}}"),
    )
    payload = F.when(m % 10 == 7, _order_message(F.concat(F.lit('"o_custkey":'), _definition("customer", "c_name", late, create=False)))).otherwise(own)
    messages = _messages(spark, sf, payload)
    messages = messages.withColumn("body", F.when(F.col("message_id") % 50 == 49, F.lit('{"Payloads": [')).otherwise(F.col("body")))
    root = f"{shared_folder(spark).rstrip('/')}/weftline/stream-{uuid.uuid4().hex}"
    messages.write.parquet(f"{root}/_queue")
    targets = _geo_targets(spark, sf)
    where = StreamTargets(root, ("order", "customer"))
    sinks.write_entities({e: targets[e] for e in where.entities}, root, 0)
    stream = stream_messages(spark, "parquet", {"path": f"{root}/_queue"}, messages.schema)
    query = start_redelivering_stream(stream, where, GEO_CATALOG, f"{root}/_checkpoint", Options(max_deliveries=3), wait_seconds=0.5, partitions=8)
    stop_when_settled(query, 1800)
    dead = dead_letters(spark, where).select("message_id", F.lit("dead").alias("fate"), F.col("attempt").cast("bigint").alias("deliveries"), "reason")
    tried = spark.read.option("basePath", where.folder("_results")).parquet(where.folder("_results"))
    done = tried.groupBy("message_id").agg(F.count_distinct("version").alias("deliveries")).join(dead, "message_id", "left_anti")
    return dead.unionByName(done.select("message_id", F.lit("done").alias("fate"), "deliveries", F.lit(None).cast("string").alias("reason")))


QUERIES = {
    f.__name__: f
    for f in (
        write_refusals, lookup_create_refusals, lookup_free_ids, given_ids_any_case, id_after_key_change, conflict_pass, bucketed_merge,
        stream_redelivery, resolve_many_key_sets, classify_nested_groups, throttle_windows_repeated,
        versioned_tables, report_rows, dead_letter_rows, typed_row_errors, guard_contacts,
    )
}
