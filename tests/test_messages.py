"""Envelope parsing, guards, correlation ids."""

import json

from conftest import by, make_messages, payload
from driverchecks.inputs import as_messages
from pyspark.sql import functions as F

from weftline import Options
from weftline.functions import json_text as J
from weftline.operators import guards
from weftline.operators.guards import with_correlation_id
from weftline.operators.lookup_tree import lookup_nodes
from weftline.operators.results import error_rows
from weftline.session import cut_lineage
from weftline.sources.messages import explode_payloads, parse_batches, read_messages

BAD = "Invalid request: The body is not a valid JSON batch."


def test_guards_in_order(spark):
    ok = payload()
    deep = {"a": 1}
    for _ in range(40):
        deep = {"n": deep}
    bodies = [
        {"Payloads": [ok]},
        '{"Payloads": [{"broken json',
        "null",
        {"Payloads": []},
        {"Payloads": None},
        {"payloads": [ok, ok, ok]},
        {"Payloads": [ok], "x": "y" * 5000},
        json.dumps({"Payloads": [ok]}) + " x",
        "[1]",
        "{'Payloads': []}",
        {"MaxLookupDepth": 1},
        {"Payloads": [ok], "deep": deep},
        {"Payloads": [ok], "text": "[" * 100},
        None,
        json.dumps([{"Payloads": [ok]}]),
        '{"Payloads":[]},{"Payloads":[]}',
    ]
    got = by(
        parse_batches(make_messages(spark, *bodies), Options(max_batch_items=2, max_request_bytes=4096)).collect(),
        "message_id",
    )
    found = {i: (r["guard_status"], r["guard_error"]) for i, r in got.items()}
    assert found[0] == (None, None) and found[12] == (None, None)
    for i in (1, 7, 8, 9, 10, 11, 14, 15):
        assert found[i] == (400, BAD), i
    for i in (2, 13):
        assert found[i] == (400, "Invalid request: Request body must contain a JSON object.")
    for i in (3, 4):
        assert found[i] == (400, "Invalid request: Payloads must contain at least one item.")
    assert found[5] == (400, "Invalid request: Payloads count (3) exceeds the maximum of 2.")
    assert found[6] == (413, "Request body exceeds the maximum allowed size of 4096 bytes.")


def test_queue_texts_and_no_size_limit(spark):
    bodies = [{"Payloads": [payload()], "x": "y" * 5000}, "null", "nope", {"Payloads": [payload(), payload()]}]
    got = parse_batches(
        make_messages(spark, *bodies), Options(max_batch_items=1, max_request_bytes=1024), "queue"
    ).orderBy("message_id")
    assert [r["guard_error"] for r in got.collect()] == [
        None,
        "Message contains no payloads.",
        "Message is not a valid JSON batch.",
        "Message batch size (2) exceeds the maximum of 1.",
    ]


def test_envelope_types_reject_the_whole_message(spark):
    def lookup(**change):
        return payload(Lookups={"parentaccountid": {"EntityLogicalName": "account", "KeyAttributes": {"name": "x"}, **change}})

    no_entity = payload()
    del no_entity["EntityLogicalName"]
    bad = [
        no_entity,
        payload(entity=5),
        payload(keys=[1]),
        payload(attrs="x"),
        payload(Id="not-a-guid"),
        payload(MaxLookupDepth="2"),
        payload(MaxLookupDepth=1.5),
        payload(SourceSystem=1),
        payload(Lookups=[]),
        payload(Lookups={"a": 5}),
        payload(Lookups={"a": {"EntityLogicalName": "account"}}),
        lookup(CreateIfNotExists="yes"),
        lookup(MaxDepth="1"),
        lookup(CreateAttributes=[1]),
        lookup(NestedLookups={"b": {"EntityLogicalName": "contact"}}),
        5,
    ]
    fine = [
        payload(entity=None),
        {"EntityLogicalName": None, "KeyAttributes": None, "Attributes": None},
        payload(Id="6F9619FF-8B86-D011-B42D-00C04FC964FF", Unknown=[1, {"a": 2}]),
        lookup(CreateIfNotExists=True, MaxDepth=2, NestedLookups={"b": None}),
        None,
    ]
    got = parse_batches(make_messages(spark, *[{"Payloads": [payload(), p]} for p in bad + fine])).orderBy("message_id")
    errors = [r["guard_error"] for r in got.collect()]
    assert errors[: len(bad)] == [BAD] * len(bad)
    assert errors[len(bad) :] == [None] * len(fine)


def test_payload_rows(spark):
    body = (
        '{"PAYLOADS":[{"entitylogicalname":"account","keyATTRIBUTES":{"b":1,"A":"x","b":2},"Attributes":{"z":1.0,"a":null,'
        '"n":{"q":[1]}}},null,{"EntityLogicalName":"contact","KeyAttributes":{},"Attributes":{},"MaxLookupDepth":1}],'
        '"maxLookupDepth":2}'
    )
    frame = explode_payloads(parse_batches(make_messages(spark, body)))
    # Collected maps lose their order, entries keep it.
    frame = frame.withColumn("keys", F.map_entries("keys")).withColumn("attrs", F.map_entries("attrs"))
    rows = frame.orderBy("idx").collect()
    assert [r["idx"] for r in rows] == [0, 1, 2]
    assert [(k, v["kind"], v["raw"]) for k, v in rows[0]["keys"]] == [("b", "int", "2"), ("A", "string", "x")]
    assert [(k, v["kind"]) for k, v in rows[0]["attrs"]] == [("z", "number"), ("a", "null"), ("n", "object")]
    assert [r["max_depth"] for r in rows] == [2, 2, 1]
    assert rows[1]["is_null"] and rows[1]["entity"] is None


def test_kinds_of_values(spark):
    text = '{"s":"{x","t":"[1]","o":{},"a":[],"i":-5,"d":1.5,"e":1e3,"b":false,"n":null,"q":"true","z":99999999999999999999}'
    row = spark.range(1).select(J.bag(F.lit(text)).alias("b")).first()["b"]
    assert {k: v["kind"] for k, v in row.items()} == {
        "s": "string", "t": "string", "o": "object", "a": "array", "i": "int", "d": "number", "e": "number",
        "b": "bool", "n": "null", "q": "string", "z": "number",
    }


def test_correlation_ids_and_error_documents(spark):
    given = ["abc-1", "  ", "x" * 65, "a\nb", "ümlaut", None, "x" * 64]
    frame = spark.createDataFrame([(i, "", c) for i, c in enumerate(given)], "message_id int, body string, correlation_id string")
    got = [r["correlation_id"] for r in with_correlation_id(frame).orderBy("message_id").collect()]
    assert got[0] == "abc-1" and got[6] == "x" * 64
    for i in (1, 2, 3, 4, 5):
        assert got[i] != given[i] and len(got[i]) == 32
    refused = spark.createDataFrame(
        [(1, "Validation failed.", ["a", "b"], "c1"), (2, "Nope", None, "c2")],
        "message_id int, error string, details array<string>, correlation_id string",
    )
    docs = [json.loads(r["json"]) for r in error_rows(refused).orderBy("message_id").collect()]
    assert docs == [
        {"Error": "Validation failed.", "Details": ["a", "b"], "CorrelationId": "c1"},
        {"Error": "Nope", "CorrelationId": "c2"},
    ]


def test_read_messages(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"Payloads":\n []}')
    (tmp_path / "two.json").write_text("x")
    rows = read_messages(spark, str(tmp_path)).collect()
    assert {r["body"] for r in rows} == {'{"Payloads":\n []}', "x"}
    assert all(r["message_id"].endswith(".json") for r in rows)
    spark.createDataFrame([(7, "b")], "n bigint, t string").write.parquet(str(tmp_path / "table"))
    row = read_messages(spark, str(tmp_path / "table"), "parquet", "n", "t").first()
    assert (row["message_id"], row["body"], row["correlation_id"]) == (7, "b", None)


def test_envelope_reads_each_definition_once(spark):
    """A lambda parses again at every use: members are read once on the way down, as texts and as values."""
    assert str(guards.envelope_ok()).count("from_json") <= 8


def test_packed_tables_are_not_broadcast_by_their_size_as_files(spark):
    """Megabytes of Parquet may be millions of rows, which the driver would gather to broadcast them."""
    rows = cut_lineage(spark.range(300_000).select("id", F.lit(0).alias("idx"), F.lit("same").alias("text")))
    marks = cut_lineage(spark.range(0, 300_000, 2))
    plan = rows.join(marks, "id", "left_semi")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_filter_on_the_guards_does_not_parse_again(spark):
    batches = parse_batches(make_messages(spark, {"Payloads": [payload()]}, "{"))
    parses = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    refused = batches.where(F.col("guard_status").isNotNull())
    assert parses(refused) == parses(batches)
    assert [r["guard_status"] for r in refused.collect()] == [400]


def test_messages_stay_in_many_partitions(spark):
    events = spark.range(200).select(F.col("id").alias("event_id"), F.lit("{}").alias("payload"))
    filled = as_messages(events).select("message_id", F.spark_partition_id().alias("p")).collect()
    assert len(filled) == 20 and len({r["p"] for r in filled}) > 2


def test_definitions_read_at_once_are_as_read_one_by_one(spark):
    texts = [
        '{"a":{"EntityLogicalName":"x","KeyAttributes":{"k":[1.50,"{"]},"MaxDepth":2},"b":null,"c":{}}',
        '{"a":{"maxdepth":1,"MaxDepth":"x","n":1e2,"t":true,"l":[],"q":"[1","o":{"p":null}}}',
        '{"a":{"m":1},"b":{},"a":{"m":"\\u00e9"}}',
        "{}",
    ]
    mixed = ['{"a":5,"a":{"M":1}}', '{"a":{"m":1},"b":"{"}', "[1]", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts + mixed)], "n int, text string")
    each = F.transform_values(J.bag(F.col("text")), lambda _, v: J.bag(v["raw"], fold_names=True))
    raw = F.transform_values(each, lambda _, m: F.transform_values(m, lambda _, v: v["raw"]))
    got = rows.select("n", each.alias("each"), raw.alias("raw"), J.bags_by_name(F.col("text")).alias("bags"), J.texts_by_name(F.col("text")).alias("texts"))
    for r in got.collect():
        # Texts are read whatever is mixed; bags leave mixed values to the other way.
        assert r["texts"] == r["raw"] and list(r["texts"] or ()) == list(r["raw"] or ()), r["n"]
        assert r["bags"] == (r["each"] if r["n"] < len(texts) else None), r["n"]


def test_a_definition_given_twice_counts_as_given_last(spark):
    good = '{"EntityLogicalName":"contact","KeyAttributes":{"emailaddress1":"x"}}'
    lookups = [f'{{"a":5,"a":{good}}}', f'{{"a":{good},"a":5}}', f'{{"a":{good},"b":null}}', f'{{"a":{{"EntityLogicalName":1}},"a":{good}}}']
    bodies = [
        f'{{"Payloads":[{{"EntityLogicalName":"account","KeyAttributes":{{"accountnumber":"1"}},"Attributes":{{}},"Lookups":{text}}}]}}'
        for text in lookups
    ]
    batches = parse_batches(make_messages(spark, *bodies))
    status = {r["message_id"]: r["guard_status"] for r in batches.collect()}
    assert status == {0: None, 1: 400, 2: None, 3: None}
    nodes = explode_payloads(batches).select("message_id", lookup_nodes(Options()).alias("nodes")).collect()
    assert {r["message_id"]: [(n["attribute"], n["absent"], n["entity"]) for n in r["nodes"]] for r in nodes} == {
        0: [("a", False, "contact")], 2: [("a", False, "contact"), ("b", True, None)], 3: [("a", False, "contact")],
    }


def test_kinds_of_nested_values_do_not_take_their_members_out(spark):
    kind = J.kind_of(F.col("raw"), F.parse_json("raw"))
    frame = spark.createDataFrame([('{"a":1}',), ("[1]",), ("7",), ("7.5",), ("true",)], "raw string")
    assert [r["k"] for r in frame.select(kind.alias("k")).collect()] == ["object", "array", "int", "number", "bool"]
    plan = frame.select(kind.alias("k"))._jdf.queryExecution().analyzed().toString()
    assert "map<string,variant>" not in plan.lower() and "array<variant>" not in plan.lower()
    assert "MapType(StringType,VariantType" not in plan and "ArrayType(VariantType" not in plan
