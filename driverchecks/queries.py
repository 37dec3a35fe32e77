"""One query per operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverchecks import inputs as I
from weftline import Catalog, Options
from weftline.catalog import SPARK_TYPES
from weftline.functions import json_text as J
from weftline.functions import keys as K
from weftline.functions import values as V
from weftline.operators import documents as D
from weftline.operators import guards as G
from weftline.operators import lookups as L
from weftline.operators import merge as M
from weftline.operators import reports as P
from weftline.operators import resolve as R
from weftline.operators import results as S
from weftline.operators import triage as T
from weftline.operators import validate as VAL
from weftline.plans.account_documents import upsert_account_documents
from weftline.plans.upsert import upsert_batch, upsert_rows, with_traces
from weftline.session import cut_lineage
from weftline.sources import sinks
from weftline.sources.documents import parse_account_documents
from weftline.sources.messages import explode_payloads, messages_from_table, parse_batches
from weftline.sources.tables import Lookup, payloads_from_table, profile_of
from weftline.streaming.upsert_stream import settle

Query = Callable[[SparkSession, str], DataFrame]


# --- upsert -------------------------------------------------------------------------------


_CUSTOMER_PROFILE = R.Profile([("customer", ("c_name",))], 0, False)


def _customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    changes = I.customer_changes(spark, sf)
    return payloads_from_table(
        changes,
        I.CUSTOMER_CATALOG,
        "customer",
        keys={"c_name": F.col("c_name")},
        attrs={c: F.col(c) for c in ("c_nationkey", "c_acctbal", "c_mktsegment")},
        present=F.col("present"),
    )


def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    targets = {"customer": I.customers(spark, sf)}
    return upsert_rows(
        _customer_rows(spark, sf), targets, I.CUSTOMER_CATALOG, profile=_CUSTOMER_PROFILE
    ).tables["customer"]


def upsert_customers_from_json(spark: SparkSession, sf: str) -> DataFrame:
    targets = {"customer": I.customers(spark, sf)}
    return upsert_batch(I.customer_bodies(spark, sf), targets, I.CUSTOMER_CATALOG).tables["customer"]


def upsert_results(spark: SparkSession, sf: str) -> DataFrame:
    targets = {"customer": I.customers(spark, sf)}
    return upsert_rows(
        _customer_rows(spark, sf), targets, I.CUSTOMER_CATALOG, profile=_CUSTOMER_PROFILE
    ).results.select(
        "message_id", F.col("Id").alias("id"), F.col("Created").alias("created"),
        F.col("UpsertKey").alias("upsert_key"), F.col("ErrorCategory").alias("category"),
    )


def upsert_customers_typed(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["c_nationkey", "c_acctbal", "c_mktsegment"]
    folded = M.fold_typed_changes(I.customer_changes(spark, sf), ["c_name"], ["message_id"], columns)
    fresh = K.new_id(F.lit("customer"), F.concat(F.lit("c_name="), F.lower("_key")))
    return M.merge_typed_changes(I.customers(spark, sf), folded, "c_name", columns, {"c_custkey": fresh})


def last_present_wins(spark: SparkSession, sf: str) -> DataFrame:
    of = F.col("event_type")
    changes = I.events(spark, sf).select(
        "user_id",
        "event_id",
        F.when(of != "error", F.col("value")).alias("value"),
        F.when(of == "click", F.col("k")).alias("k"),
        F.when(of == "view", F.array(F.lit("k")))
        .when(of == "click", F.array(F.lit("k"), F.lit("value")))
        .otherwise(F.array(F.lit("value")))
        .alias("present"),
    )
    folded = M.fold_typed_changes(changes, ["user_id"], ["event_id"], ["value", "k"])
    return folded.select(
        "user_id",
        F.col("value.v").alias("value"),
        F.col("value").isNotNull().alias("value_supplied"),
        F.col("k.v").alias("k"),
        F.col("k").isNotNull().alias("k_supplied"),
    )


def fold_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_rows(spark, sf)
    changes = rows.select(
        "entity_name",
        F.col("identity").alias("id"),
        F.struct("message_id", "idx").alias("seq"),
        F.lit(False).alias("exists"),
        "values",
    )
    got = lambda c: F.try_element_at("values", F.lit(c))
    return M.fold_changes(changes).select(
        F.col("id").alias("identity"),
        got("c_nationkey").cast("int").alias("c_nationkey"),
        got("c_acctbal").cast("double").alias("c_acctbal"),
        got("c_mktsegment").alias("c_mktsegment"),
        F.map_contains_key("values", "c_acctbal").alias("acctbal_supplied"),
    )


# --- keys ---------------------------------------------------------------------------------


def key_signature(spark: SparkSession, sf: str) -> DataFrame:
    joined = I.table(spark, sf, "customer").join(
        I.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    text = lambda c: F.struct(F.lit("string").alias("kind"), c.alias("raw"))
    keys = F.create_map(
        F.lit("C_Name"), text(F.concat(F.col("c_name"), F.lit("="), F.col("n_name"))),
        F.lit("Seg:ment"), text(F.concat(F.col("c_mktsegment"), F.lit(",\\"))),
        F.lit("c_nation"), F.struct(F.lit("int").alias("kind"), F.col("c_nationkey").cast("string").alias("raw")),
        F.lit("rich"), F.struct(F.lit("bool").alias("kind"), (F.col("c_acctbal") > 5000).cast("string").alias("raw")),
        F.lit("none"), F.struct(F.lit("null").alias("kind"), F.lit(None).cast("string").alias("raw")),
    )
    return joined.select("c_custkey", K.signature(F.lit("Customer"), keys).alias("signature"))


def key_signature_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = I.spread_table(spark, sf, "orders")
    text = lambda c: F.struct(F.lit("string").alias("kind"), c.alias("raw"))
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd")
    keys = F.create_map(
        F.lit("day"), text(day),
        F.lit("month"), text(F.substring(day, 1, 7)),
        F.lit("stamp"), text(F.concat(day, F.lit("T12:30:00+02:00"))),
    )
    return orders.select("o_orderkey", K.signature(F.lit("order"), keys).alias("signature"))


def identity_key(spark: SparkSession, sf: str) -> DataFrame:
    part = I.table(spark, sf, "part")
    keys = F.create_map(
        F.lit("p_name"), F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")),
        F.lit("p_brand"), F.col("p_brand"),
        F.lit("p_type"), F.when(F.col("p_size") > 25, F.col("p_type")),
    )
    return part.select(
        "p_partkey", K.identity(keys).alias("identity"), K.new_id(F.lit("part"), K.identity(keys)).alias("new_id")
    )


# --- resolution -----------------------------------------------------------------------------


def resolve_unique(spark: SparkSession, sf: str) -> DataFrame:
    orders = I.spread_table(spark, sf, "orders")
    name = I.customer_key(F.col("o_custkey") + (F.col("o_orderkey") % 3) * 500)
    rows = payloads_from_table(
        orders, I.CUSTOMER_CATALOG, "customer", {"C_NAME": F.upper(name)}, {}, message_id=F.col("o_orderkey")
    )
    targets = {"customer": I.customers(spark, sf)}
    matches = R.match_keys(rows, targets, I.CUSTOMER_CATALOG, R.key_shapes(rows))
    decided = R.decide_action(R.resolve_keys(rows, matches))
    return decided.select(F.col("message_id").alias("o_orderkey"), "match_count", "match_id", "action", "final_id")


PART_CATALOG = Catalog.from_rows(
    [("part", "p_partkey", "guid"), ("part", "p_brand", "string"), ("part", "p_size", "int"), ("part", "p_name", "string")],
    ids={"part": "p_partkey"},
)


def resolve_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    part = I.table(spark, sf, "part")
    lines = I.spread_table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = payloads_from_table(
        lines, PART_CATALOG, "part", {"p_brand": F.col("p_brand"), "p_size": F.col("p_size")}, {},
        message_id=F.col("l_orderkey"), idx=F.col("l_linenumber"),
    )
    targets = {"part": part.withColumn("p_partkey", F.col("p_partkey").cast("string"))}
    matches = R.match_keys(rows, targets, PART_CATALOG, R.key_shapes(rows))
    decided = R.decide_action(R.resolve_keys(rows, matches))
    return decided.groupBy(F.col("sig").alias("signature"), "match_count", "error").agg(F.count("*").alias("rows"))


def resolve_given_ids(spark: SparkSession, sf: str) -> DataFrame:
    orders = I.spread_table(spark, sf, "orders")
    given = F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_custkey") * 2).cast("string"))
    rows = payloads_from_table(
        orders, I.CUSTOMER_CATALOG, "customer", {"c_name": I.customer_key(F.col("o_custkey"))}, {},
        message_id=F.col("o_orderkey"), id=given,
    )
    targets = {"customer": I.customers(spark, sf)}
    matches = R.match_keys(rows, targets, I.CUSTOMER_CATALOG, R.key_shapes(rows))
    decided = R.decide_action(R.resolve_keys(rows, matches), R.match_ids(rows, targets, I.CUSTOMER_CATALOG))
    return decided.select(F.col("message_id").alias("o_orderkey"), "action", "final_id", "error")


def reresolve_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """First try against half of the customers, second against all: creates become updates."""
    orders = I.spread_table(spark, sf, "orders")
    everyone = I.customers(spark, sf)
    early = {"customer": everyone.where(F.col("c_nationkey") < 12)}
    rows = payloads_from_table(
        orders, I.CUSTOMER_CATALOG, "customer", {"c_name": I.customer_key(F.col("o_custkey"))}, {},
        message_id=F.col("o_orderkey"),
    )
    first = R.decide_action(
        R.resolve_keys(rows, R.match_keys(rows, early, I.CUSTOMER_CATALOG, R.key_shapes(rows)))
    )
    conflicts = first.where(F.col("action") == "create")
    again = R.reresolve_conflicts(conflicts, {"customer": everyone}, I.CUSTOMER_CATALOG)
    return again.select(F.col("message_id").alias("o_orderkey"), "action", "final_id", "error")


# --- lookups ---------------------------------------------------------------------------------

GEO_CATALOG = Catalog.from_rows(
    [
        ("order", "orderid", "guid"),
        ("order", "o_orderkey", "long"),
        ("order", "o_custkey", "reference"),
        ("customer", "c_custkey", "guid"),
        ("customer", "c_name", "string"),
        ("customer", "c_mktsegment", "string"),
        ("customer", "c_nationkey", "reference"),
        ("nation", "n_nationkey", "guid"),
        ("nation", "n_name", "string"),
        ("nation", "n_regionkey", "reference"),
        ("region", "r_regionkey", "guid"),
        ("region", "r_name", "string"),
    ],
    ids={"customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey"},
)


def _geo_targets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    ref = lambda entity, c: F.struct(F.lit(entity).alias("entity"), F.col(c).cast("string").alias("id"))
    return {
        "order": spark.createDataFrame(
            [], "orderid string, o_orderkey bigint, o_custkey struct<entity:string,id:string>"
        ),
        "customer": I.table(spark, sf, "customer").select(
            F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", ref("nation", "c_nationkey").alias("c_nationkey")
        ),
        "nation": I.table(spark, sf, "nation").select(
            F.col("n_nationkey").cast("string"), "n_name", ref("region", "n_regionkey").alias("n_regionkey")
        ),
        "region": I.table(spark, sf, "region").select(F.col("r_regionkey").cast("string"), "r_name"),
    }


def lookup_one_level(spark: SparkSession, sf: str) -> DataFrame:
    base = I.table(spark, sf, "customer")
    wanted = F.concat(F.lit("nation_"), (F.col("c_nationkey") + F.when(F.col("c_custkey") % 7 == 0, 100).otherwise(0)).cast("string"))
    rows = payloads_from_table(
        base, GEO_CATALOG, "customer", {"c_name": F.col("c_name")}, {"c_mktsegment": F.col("c_mktsegment")},
        lookups=[Lookup("c_nationkey", "nation", {"n_name": wanted})], message_id=F.col("c_custkey"),
    )
    outcome = upsert_rows(rows, _geo_targets(spark, sf), GEO_CATALOG)
    return outcome.tables["customer"].select(
        "c_custkey", F.col("c_nationkey.id").alias("nation_id")
    ).join(
        outcome.results.select(
            F.col("message_id").cast("string").alias("c_custkey"),
            F.col("ErrorCategory").alias("category"),
            F.col("ErrorMessage").alias("error"),
        ),
        "c_custkey",
    )


def _create_missing(spark: SparkSession, sf: str):
    base = I.events(spark, sf, spread=True)
    name = I.customer_key(F.col("user_id") * 20 + F.col("k"))
    keys = {"o_orderkey": F.col("event_id")}
    lookups = [
        Lookup(
            "o_custkey", "customer", {"c_name": name}, create=True,
            create_attrs={"c_mktsegment": F.concat(F.lit("E"), F.col("event_id").cast("string"))},
        )
    ]
    rows = payloads_from_table(base, GEO_CATALOG, "order", keys, {}, lookups, message_id=F.col("event_id"))
    return upsert_rows(
        rows, _geo_targets(spark, sf), GEO_CATALOG, profile=profile_of("order", keys, lookups)
    )


def lookup_create_missing(spark: SparkSession, sf: str) -> DataFrame:
    return _create_missing(spark, sf).traces.select(
        F.col("message_id").alias("event_id"),
        F.col("ResolvedId").alias("resolved_id"),
        F.col("WasCreated").alias("was_created"),
        F.col("path"),
        F.col("Depth").cast("bigint").alias("depth"),
    )


def lookup_created_records(spark: SparkSession, sf: str) -> DataFrame:
    return _create_missing(spark, sf).tables["customer"].select("c_custkey", "c_name", "c_mktsegment")


def _nested(spark: SparkSession, sf: str, depth: int):
    base = I.spread_table(spark, sf, "orders")
    number = F.col("o_custkey") * 2
    nation = number % 40
    regions = F.array(*[F.lit(r) for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "ATLANTIS")])
    lookup = Lookup(
        "o_custkey", "customer", {"c_name": I.customer_key(number)}, create=True,
        nested=[
            Lookup(
                "c_nationkey", "nation", {"n_name": F.concat(F.lit("NATION_"), nation.cast("string"))}, create=True,
                nested=[Lookup("n_regionkey", "region", {"r_name": F.get(regions, (nation % 6).cast("int"))})],
            )
        ],
    )
    options = Options(max_lookup_depth=depth)
    keys = {"o_orderkey": F.col("o_orderkey")}
    rows = payloads_from_table(
        base, GEO_CATALOG, "order", keys, {}, [lookup], message_id=F.col("o_orderkey"), options=options
    )
    profile = profile_of("order", keys, [lookup])
    return upsert_rows(rows, _geo_targets(spark, sf), GEO_CATALOG, options, profile=profile)


def _nested_results(depth: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        outcome = _nested(spark, sf, depth)
        return outcome.results.select(
            F.col("message_id").alias("o_orderkey"),
            F.col("ErrorCategory").alias("category"),
            F.col("ErrorMessage").alias("error"),
        )

    return query


def lookup_nested_records(spark: SparkSession, sf: str) -> DataFrame:
    tables = _nested(spark, sf, 3).tables
    customer = tables["customer"].select(
        F.lit("customer").alias("entity"), F.col("c_name").alias("name"), F.col("c_nationkey.id").alias("parent_id")
    )
    nation = tables["nation"].select(
        F.lit("nation").alias("entity"), F.col("n_name").alias("name"), F.col("n_regionkey.id").alias("parent_id")
    )
    return customer.unionByName(nation)


def lookup_trace_trees(spark: SparkSession, sf: str) -> DataFrame:
    outcome = _nested(spark, sf, 3)
    return with_traces(outcome).select(F.col("message_id").alias("o_orderkey"), F.col("LookupTraces").alias("traces"))


# --- messages, guards, validation -------------------------------------------------------------


def guard_messages(spark: SparkSession, sf: str) -> DataFrame:
    n, text = F.col("doc_id"), F.col("text")
    payload = F.concat(
        F.lit('{"EntityLogicalName":"x","KeyAttributes":{},"Attributes":{"t":"'), F.hex(text), F.lit('"}}')
    )
    body = (
        F.when(n % 8 == 0, text)
        .when(n % 8 == 1, F.concat(F.lit('{"Payloads":[],"t":"'), F.hex(text), F.lit('"}')))
        .when(n % 8 == 2, F.concat(F.lit('{"Payloads":['), F.array_join(F.array_repeat(payload, 3), ","), F.lit("]}")))
        .when(n % 8 == 3, F.concat(F.lit('{"Payloads":['), payload, F.lit('],"MaxLookupDepth":"2"}')))
        .when(n % 8 == 4, F.concat(F.lit('{"Payloads":['), payload, F.lit("]} x")))
        .when(n % 8 == 5, F.concat(F.lit('{"Payloads":['), payload, F.lit('],"d":'), F.repeat(F.lit("["), (20 + n % 20).cast("int")), F.repeat(F.lit("]"), (20 + n % 20).cast("int")), F.lit("}")))
        .when(n % 8 == 6, F.lit("null"))
        .otherwise(F.concat(F.lit('{"payloads":['), payload, F.lit("]}")))
    )
    messages = messages_from_table(I.table(spark, sf, "documents").withColumn("body", body), "doc_id")
    options = Options(max_request_bytes=20_000, max_batch_items=2)
    return parse_batches(messages, options).select(
        F.col("message_id").alias("doc_id"),
        F.col("guard_status").alias("status"),
        F.col("guard_error").alias("error"),
        F.coalesce(F.size("payloads"), F.lit(-1)).alias("payloads"),
    )


def guard_depth(spark: SparkSession, sf: str) -> DataFrame:
    depth = (F.col("page_id") % 40).cast("int")
    body = F.concat(
        F.repeat(F.lit('{"a":['), depth), F.lit('"[[{{'), F.hex("html"), F.lit('\\"[["'), F.repeat(F.lit("]}"), depth)
    )
    return I.table(spark, sf, "pages").select("page_id", G.J.nests_deeper_than(body, 32).alias("too_deep"))


def correlation_ids(spark: SparkSession, sf: str) -> DataFrame:
    turns = I.table(spark, sf, "conversations")
    messages = turns.select(
        F.concat_ws("/", "conv_id", "turn").alias("message_id"), F.lit("").alias("body"), F.col("text").alias("correlation_id")
    )
    short = turns.select(
        F.concat_ws("/", "conv_id", "turn", F.lit("r")).alias("message_id"), F.lit("").alias("body"), F.col("role").alias("correlation_id")
    )
    return G.with_correlation_id(messages.unionByName(short)).select("message_id", "correlation_id")


def _validated_events(spark: SparkSession, sf: str) -> DataFrame:
    batches = parse_batches(I.event_bodies(spark, sf))
    return cut_lineage(VAL.validate_and_convert(explode_payloads(batches), I.EVENT_CATALOG))


def validate_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return _validated_events(spark, sf).select(
        "message_id",
        F.col("idx").cast("bigint").alias("idx"),
        F.col("sig").alias("signature"),
        VAL.error_text(F.col("errors")).alias("error"),
    )


def coerce_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = _validated_events(spark, sf).where(F.col("errors").isNull())
    got = lambda c: F.try_element_at("values", F.lit(c))
    return rows.select(
        V.typed(got("number"), "long").alias("number"),
        V.typed(got("kind"), "choice").alias("kind"),
        V.typed(got("amount"), "money").cast("double").alias("amount"),
        V.typed(got("k"), "int").alias("k"),
        F.map_contains_key("values", "k").alias("k_supplied"),
        F.unix_seconds(V.typed(got("happened"), "datetime")).alias("happened"),
        got("details").alias("details"),
        V.typed(got("large"), "bool").alias("large"),
        F.to_json(V.typed(got("tags"), "choices")).alias("tags"),
    )


def validate_batches(spark: SparkSession, sf: str) -> DataFrame:
    return VAL.validate_batch(_validated_events(spark, sf)).select(
        "message_id", F.array_join("errors", "|").alias("errors")
    )


def message_status(spark: SparkSession, sf: str) -> DataFrame:
    targets = {
        "event": I.events(spark, sf).where(F.col("event_id") % 2 == 0).select(
            F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("eventid"),
            F.col("event_id").alias("number"),
            F.col("k"),
            *[
                F.lit(None).cast(SPARK_TYPES[spec.type]).alias(name)
                for name, spec in sorted(I.EVENT_CATALOG.entities["event"].items())
                if name not in ("eventid", "number", "k") and spec.type in SPARK_TYPES
            ],
        )
    }
    outcome = upsert_batch(I.event_bodies(spark, sf), targets, I.EVENT_CATALOG)
    return outcome.status.select("message_id", "status", "total", "failed", "validation_failed", "technical_failed", "error")


def convert_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversion on the texts of a table: ids in all spellings, numbers, dates, choices."""
    n = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    digits = F.md5(n.cast("string"))
    p = lambda a, b: F.substring(digits, a, b)
    dashed = F.concat_ws("-", p(1, 8), p(9, 4), p(13, 4), p(17, 4), p(21, 12))
    bytes_ = F.concat_ws(",", *[F.concat(F.lit("0x"), p(17 + 2 * i, 2)) for i in range(8)])
    hexed = F.concat(
        F.lit("{0x"), p(1, 8), F.lit(",0x"), p(9, 4), F.lit(",0x"), p(13, 4), F.lit(",{"), bytes_, F.lit("}}")
    )
    spelled = (
        F.when(n % 6 == 0, digits)
        .when(n % 6 == 1, F.upper(dashed))
        .when(n % 6 == 2, F.concat(F.lit("{"), dashed, F.lit("}")))
        .when(n % 6 == 3, F.concat(F.lit(" ("), dashed, F.lit(") ")))
        .when(n % 6 == 4, hexed)
        .otherwise(F.concat(dashed, F.lit("0")))
    )
    codes = F.from_json(F.lit('{"a":1,"n":2,"r":4}'), "map<string,int>")
    flag = (
        F.when(n % 3 == 0, F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" , r ")))
        .when(n % 3 == 1, F.col("l_linenumber").cast("string"))
        .otherwise(F.col("l_linestatus"))
    )
    stamp = F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd")
    shown = (
        F.when(n % 4 == 0, stamp)
        .when(n % 4 == 1, F.concat(stamp, F.lit("T08:00:00-01:30")))
        .when(n % 4 == 2, F.substring(stamp, 1, 7))
        .otherwise(F.concat(F.lit("ACC-"), stamp))
    )
    return I.spread_table(spark, sf, "lineitem").select(
        n.cast("bigint").alias("n"),
        V.guid_of(spelled).alias("guid"),
        V.choice_code(flag, codes).alias("choice"),
        F.unix_seconds(V.timestamp_of(shown)).alias("stamp"),
    )


def normalize_untyped(spark: SparkSession, sf: str) -> DataFrame:
    """Shape and text of values no catalog knows."""
    n = F.col("event_id")
    raw = (
        F.when(n % 6 == 0, F.col("k").cast("string"))
        .when(n % 6 == 1, F.concat((n * 1000000000).cast("string")))
        .when(n % 6 == 2, F.lit("1.5"))
        .when(n % 6 == 3, F.concat(F.lit('"2024-01-'), F.format_string("%02d", F.col("k") % 28 + 1), F.lit('"')))
        .when(n % 6 == 4, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
        .otherwise(F.col("props"))
    )
    bag = J.bag(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    v = F.element_at(bag, "v")
    return (
        I.events(spark, sf)
        .withColumn("_v", v)
        .select(
            "event_id",
            V.normalized_kind(F.col("_v.kind"), F.col("_v.raw")).alias("kind"),
            V.normalized_text(F.col("_v.kind"), F.col("_v.raw")).alias("text"),
        )
    )


# --- results ----------------------------------------------------------------------------------


def batch_status(spark: SparkSession, sf: str) -> DataFrame:
    return S.batch_status(I.event_results(spark, sf)).withColumn("retry_after", F.col("retry_after").cast("bigint"))


def batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    return S.batch_counts(I.event_results(spark, sf))


def result_documents(spark: SparkSession, sf: str) -> DataFrame:
    results = _customer_results_from_json(spark, sf)
    return sinks.response_bodies(results)


def _customer_results_from_json(spark: SparkSession, sf: str) -> DataFrame:
    targets = {"customer": I.customers(spark, sf)}
    return upsert_batch(I.customer_bodies(spark, sf), targets, I.CUSTOMER_CATALOG).results


def error_documents(spark: SparkSession, sf: str) -> DataFrame:
    batches = parse_batches(I.event_bodies(spark, sf)).where(F.col("guard_status").isNotNull())
    named = G.with_correlation_id(batches.withColumn("error", F.col("guard_error")))
    return S.error_rows(named)


# --- failure log --------------------------------------------------------------------------------


def classify_errors(spark: SparkSession, sf: str) -> DataFrame:
    return T.classify_errors(I.failures(spark, sf)).select("op_id", F.col("node_id").cast("bigint").alias("node_id"), "category")


# --- account documents ---------------------------------------------------------------------------


def validate_documents(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_account_documents(I.account_bodies(spark, sf))
    return D.validate_account_documents(parsed).select(
        "message_id", "guard_error", F.when(F.col("guard_status").isNull(), F.array_join("errors", "; ")).alias("errors")
    )


def _documents(spark: SparkSession, sf: str):
    return upsert_account_documents(I.account_bodies(spark, sf), I.account_targets(spark, sf), I.ACCOUNT_CATALOG)


def document_results(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).results.select(
        "message_id",
        F.col("idx").cast("bigint").alias("idx"),
        F.col("EntityLogicalName").alias("entity"),
        F.col("UpsertKey").alias("upsert_key"),
        F.col("Created").alias("created"),
        F.col("ErrorCategory").alias("category"),
        F.col("ErrorMessage").alias("error"),
    )


def document_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).tables["account"].select(
        F.col("accountid"), "accountnumber", "name", "address1_city", "address1_line1",
        F.col("primarycontactid.id").alias("primary_contact"),
    )


def document_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).tables["contact"].select(
        "contactid", "emailaddress1", "firstname", "lastname", "jobtitle",
        F.col("parentcustomerid.id").alias("parent"),
    )


def document_status(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).status.select("message_id", "status", "total", "failed", "error")


# --- queue ----------------------------------------------------------------------------------------


def redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """Which messages are delivered again and which are set aside after this delivery."""
    bodies = I.event_bodies(spark, sf)
    status = S.batch_status(I.event_results(spark, sf)).withColumn("error", F.lit(None).cast("string"))
    deliveries = bodies.withColumn("attempt", (F.col("message_id") % 3).cast("int"))
    again, dead = settle(deliveries, status, Options(max_deliveries=3))
    both = again.withColumn("fate", F.lit("again")).unionByName(dead.withColumn("fate", F.lit("dead")))
    return both.select("message_id", "fate", F.col("attempt").cast("bigint").alias("attempt"), "reason")


# --- request log ----------------------------------------------------------------------------------


def throttle_windows(spark: SparkSession, sf: str) -> DataFrame:
    return P.throttle_windows(P.request_numbers(I.request_log(spark, sf)))


def sustained_throttling(spark: SparkSession, sf: str) -> DataFrame:
    return P.sustained_throttling(throttle_windows(spark, sf))


def until_sustained(spark: SparkSession, sf: str) -> DataFrame:
    numbered = P.request_numbers(I.request_log(spark, sf))
    cuts = P.sustained_throttling(P.throttle_windows(numbered))
    return P.until_sustained(numbered, cuts).select("thread_id", "request_index", "n")


def failure_ratio_windows(spark: SparkSession, sf: str) -> DataFrame:
    calls = I.request_log(spark, sf).select(
        F.col("event_type").alias("service"),
        # One day of calls per second, so that windows fill up.
        F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 3600)).alias("ts"),
        (F.col("response_ms") > 20).alias("counted_failure"),
    )
    return P.failure_ratio_windows(calls, Options())


def rate_breaches(spark: SparkSession, sf: str) -> DataFrame:
    calls = I.request_log(spark, sf).select(F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 3600)).alias("ts"))
    return P.rate_breaches(calls, 15).select(F.unix_seconds("second").alias("second"), "calls")


QUERIES: dict[str, Query] = {
    "upsert_customers": upsert_customers,
    "upsert_customers_from_json": upsert_customers_from_json,
    "upsert_customers_typed": upsert_customers_typed,
    "upsert_results": upsert_results,
    "last_present_wins": last_present_wins,
    "fold_changes": fold_changes,
    "key_signature": key_signature,
    "key_signature_dates": key_signature_dates,
    "identity_key": identity_key,
    "resolve_unique": resolve_unique,
    "resolve_ambiguous": resolve_ambiguous,
    "resolve_given_ids": resolve_given_ids,
    "reresolve_conflicts": reresolve_conflicts,
    "lookup_one_level": lookup_one_level,
    "lookup_create_missing": lookup_create_missing,
    "lookup_created_records": lookup_created_records,
    "lookup_nested_depth_3": _nested_results(3),
    "lookup_nested_depth_2": _nested_results(2),
    "lookup_nested_records": lookup_nested_records,
    "lookup_trace_trees": lookup_trace_trees,
    "guard_messages": guard_messages,
    "guard_depth": guard_depth,
    "correlation_ids": correlation_ids,
    "validate_attributes": validate_attributes,
    "validate_batches": validate_batches,
    "coerce_values": coerce_values,
    "convert_texts": convert_texts,
    "normalize_untyped": normalize_untyped,
    "message_status": message_status,
    "batch_status": batch_status,
    "batch_counts": batch_counts,
    "result_documents": result_documents,
    "error_documents": error_documents,
    "classify_errors": classify_errors,
    "classify_groups": lambda s, d: T.classify_groups(I.failures(s, d)),
    "key_conflicts": lambda s, d: T.key_conflicts(I.failures(s, d)),
    "retryable": lambda s, d: T.retryable(I.failures(s, d)),
    "retry_delay": lambda s, d: T.retry_delay(I.failures(s, d)),
    "validate_documents": validate_documents,
    "document_results": document_results,
    "document_accounts": document_accounts,
    "document_contacts": document_contacts,
    "document_status": document_status,
    "redelivery": redelivery,
    "load_summary": lambda s, d: P.load_summary(I.request_log(s, d), 3, 120.0),
    "latency_stats": lambda s, d: P.latency_stats(I.request_log(s, d)),
    "latency_percentiles": lambda s, d: P.latency_percentiles(I.request_log(s, d)),
    "status_breakdown": lambda s, d: P.status_breakdown(I.request_log(s, d)),
    "throttle_windows": throttle_windows,
    "sustained_throttling": sustained_throttling,
    "until_sustained": until_sustained,
    "sample_errors": lambda s, d: P.sample_errors(I.request_log(s, d)),
    "failure_ratio_windows": failure_ratio_windows,
    "rate_breaches": rate_breaches,
}
