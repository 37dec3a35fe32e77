"""End to end: create, update, lookups, conflicts, ordering, sinks."""

import json
from itertools import combinations

from conftest import CATALOG, by, make_messages, make_targets, payload
from pyspark.sql import functions as F

from weftline import Catalog, Options
from weftline.operators import lookups as L
from weftline.operators import resolve as R
from weftline.plans.upsert import decide, upsert_batch, with_traces
from weftline.sources import sinks
from weftline.sources.tables import Lookup, payloads_from_table, profile_of

ACCOUNTS = [
    {"accountid": "t1", "accountnumber": "T1", "name": "old", "address1_city": "Oslo"},
    {"accountid": "d1", "accountnumber": "DUP"},
    {"accountid": "d2", "accountnumber": "dup "},
    {"accountid": "self", "accountnumber": "SELF-1", "name": "Self Parent"},
]
CONTACTS = [{"contactid": "c1", "emailaddress1": "Primary@Example.com"}]


def lookup(entity, keys, create=False, **more):
    return {"EntityLogicalName": entity, "KeyAttributes": keys, "CreateIfNotExists": create, **more}


def run(spark, *bodies, options=Options(), accounts=ACCOUNTS, contacts=CONTACTS):
    return upsert_batch(make_messages(spark, *bodies), make_targets(spark, accounts, contacts), CATALOG, options)


def table(outcome, name, key):
    return by(outcome.tables[name].collect(), key)


def test_create_update_and_sparse_merge(spark):
    out = run(
        spark,
        {
            "Payloads": [
                payload(keys={"AccountNumber": "NEW"}, attrs={"Name": "First", "address1_city": "Rome", "revenue": 5}),
                payload(keys={"accountnumber": "t1"}, attrs={"address1_utcoffset": 3, "address1_city": None}),
                payload(keys={"accountnumber": " new"}, attrs={"name": None, "industrycode": "accounting"}),
                payload(keys={"accountnumber": "DUP"}),
                payload(keys={"accountnumber": "T1"}, attrs={"name": 5}),
                None,
                payload(Id="00000000-0000-0000-0000-00000000000f", keys={"accountnumber": "T1"}),
                payload(Id="00000000-0000-0000-0000-000000000000", keys={"accountnumber": "T1"}, attrs={"numberofemployees": 1}),
            ]
        },
        {"Payloads": [payload(keys={"accountnumber": "NEW"}, attrs={"address1_city": "Bern"})]},
        "broken",
    )
    rows = by(out.results.collect(), "message_id", "idx")
    got = {k: (r["Created"], r["ErrorCategory"]) for k, r in rows.items()}
    assert got == {
        (0, 0): (True, "None"), (0, 1): (False, "None"), (0, 2): (False, "None"), (0, 3): (False, "Permanent"),
        (0, 4): (False, "Validation"), (0, 5): (False, "Validation"), (0, 6): (False, "Permanent"),
        (0, 7): (False, "None"), (1, 0): (False, "None"),
    }
    assert rows[0, 3]["ErrorMessage"] == "Multiple 'account' records (2+) found for KeyAttributes 'account:accountnumber=DUP'."
    assert rows[0, 4]["ValidationErrors"] == ["Field 'name' has invalid type. Expected 'string'."]
    assert (rows[0, 5]["EntityLogicalName"], rows[0, 5]["UpsertKey"]) == ("<unknown>", None)
    assert rows[0, 5]["Id"] == "00000000-0000-0000-0000-000000000000"
    assert "does not exist" in rows[0, 6]["ErrorMessage"] and rows[0, 6]["ValidationErrors"] is None
    assert rows[0, 0]["Id"] == rows[0, 2]["Id"] == rows[1, 0]["Id"] and rows[0, 1]["Id"] == "t1"
    accounts = table(out, "account", "accountid")
    assert len(accounts) == 5
    new, old = accounts[rows[0, 0]["Id"]], accounts["t1"]
    assert (new["name"], new["address1_city"], float(new["revenue"]), new["industrycode"]) == (None, "Bern", 5.0, 1)
    assert (old["name"], old["address1_city"], old["address1_utcoffset"]) == ("old", None, 3)
    assert 1 in {a["numberofemployees"] for a in accounts.values()}
    status = by(out.status.collect(), "message_id")
    assert [status[i]["status"] for i in range(3)] == [500, 200, 400]
    assert (status[0]["total"], status[0]["failed"], status[0]["validation_failed"], status[0]["technical_failed"]) == (8, 4, 2, 2)
    assert status[2]["error"] == "Invalid request: The body is not a valid JSON batch."


def test_upsert_is_idempotent_and_independent_of_partitions(spark):
    body = {
        "Payloads": [payload(keys={"accountnumber": f"K{i % 7}"}, attrs={"name": f"n{i}"}) for i in range(40)]
        + [payload("contact", {"emailaddress1": f"x{i}@y"}, {}, Lookups={"parentcustomerid": lookup("account", {"accountnumber": f"P{i % 3}"}, True)}) for i in range(9)]
    }
    messages = make_messages(spark, body)
    targets = make_targets(spark, ACCOUNTS, CONTACTS)
    first = upsert_batch(messages, targets, CATALOG)
    again = upsert_batch(messages.repartition(5), first.tables, CATALOG)
    for name in ("account", "contact"):
        assert sorted(map(str, first.tables[name].collect())) == sorted(map(str, again.tables[name].collect()))
    assert again.results.where("Created").count() == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = upsert_batch(messages.repartition(3), targets, CATALOG)
        assert sorted(map(str, other.results.collect())) == sorted(map(str, first.results.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r["name"] for r in first.tables["account"].where("accountnumber like 'K%'").collect()} == {f"n{i}" for i in range(33, 40)}


def test_lookups(spark):
    contact = lambda mail, lookups, **more: payload("contact", {"emailaddress1": mail}, {}, Lookups=lookups, **more)
    nested = lambda keys, below, **more: lookup("account", keys, True, NestedLookups=below, **more)
    out = run(
        spark,
        {
            "Payloads": [
                contact("a@x", {"ParentCustomerId": lookup("account", {"accountnumber": "t1"})}),
                contact("b@x", {"parentcustomerid": lookup("account", {"accountnumber": "NOPE"})}),
                contact("c@x", {"parentcustomerid": lookup("account", {"accountnumber": "DUP"}, True)}),
                contact("d@x", {"parentcustomerid": lookup("account", {"accountnumber": "NEW"}, True, CreateAttributes={"name": "One", "AccountNumber": "new"})}),
                contact("e@x", {"parentcustomerid": lookup("account", {"accountnumber": "new"}, True, CreateAttributes={"name": "Two"})}),
                # Nested: created with its child, child first.
                contact("f@x", {"parentcustomerid": nested({"accountnumber": "TREE"}, {"primarycontactid": lookup("contact", {"emailaddress1": "leaf@x"}, True)})}),
                # Nested lookups of an existing parent are not looked at.
                contact("g@x", {"parentcustomerid": nested({"accountnumber": "T1"}, {"primarycontactid": lookup("contact", {"emailaddress1": "none@x"})})}),
                # First failing child stops, earlier children stay.
                contact("h@x", {"parentcustomerid": nested({"accountnumber": "FAIL"}, {
                    "primarycontactid": lookup("contact", {"emailaddress1": "kept@x"}, True),
                    "parentaccountid": lookup("account", {"accountnumber": "MISSING"}),
                    "accountid": lookup("contact", {"emailaddress1": "never@x"}, True)})}),
                # Depth and cycles.
                contact("i@x", {"parentcustomerid": nested({"accountnumber": "L0"}, {"parentaccountid": nested({"accountnumber": "L1"}, {"parentaccountid": lookup("account", {"accountnumber": "L2"}, True)})})}, MaxLookupDepth=2),
                contact("j@x", {"parentcustomerid": nested({"accountnumber": "CYC"}, {"parentaccountid": lookup("account", {"AccountNumber": "cyc"}, True)})}),
                contact("k@x", {"parentcustomerid": nested({"accountnumber": "M"}, {"primarycontactid": lookup("contact", {"emailaddress1": "m@x"}, True)}, MaxDepth=1)}),
                # A bad value in a lookup is a validation failure; a number is text for a text key.
                contact("l@x", {"parentcustomerid": lookup("account", {"address1_utcoffset": "x"})}),
                contact("m@x", {"parentcustomerid": lookup("account", {"accountnumber": 77}, True, CreateAttributes={"address1_utcoffset": 1.5})}),
                contact("n@x", {"parentcustomerid": lookup("account", {"accountnumber": 78}, True)}),
                # Two failing lookups: the first one is reported. Its sibling's record stays.
                contact("o@x", {"accountid": lookup("account", {"accountnumber": "SIB"}, True), "parentcustomerid": lookup("account", {"accountnumber": "NO1"}), "accountID": lookup("account", {"accountnumber": "NO2"})}),
                # Own key equal to what its lookup creates: then it is an update. References to itself work.
                payload(keys={"accountnumber": "OWN"}, attrs={"name": "own"}, Lookups={"parentaccountid": lookup("account", {"accountnumber": "own"}, True)}),
                payload(keys={"accountnumber": "SELF-1"}, attrs={}, Lookups={"parentaccountid": lookup("account", {"accountnumber": "SELF-1"})}),
            ]
        },
    )
    rows = by(out.results.where("message_id = 0").collect(), "idx")
    error = {i: r["ErrorMessage"] for i, r in rows.items()}
    none = "entity 'account' not found and CreateIfNotExists is false."
    for i in (0, 3, 4, 5, 6, 13, 15, 16):
        assert error[i] is None, (i, error[i])
    assert error[1] == f"Lookup resolution for 'parentcustomerid': {none}"
    assert error[2] == "Lookup resolution for 'parentcustomerid': 2+ 'account' records match the alternate key."
    assert error[7] == f"Lookup resolution for 'parentaccountid': {none}"
    assert error[8] == "Lookup resolution for 'parentaccountid' exceeded maximum depth of 2."
    assert error[9] == (
        "Cyclic lookup detected for 'parentaccountid' (account:accountnumber=cyc). Resolution path: account:accountnumber=CYC"
    )
    assert error[10] == "Lookup resolution for 'primarycontactid' exceeded maximum depth of 1."
    assert (error[11], rows[11]["ErrorCategory"]) == ("Field 'address1_utcoffset' could not be converted to 'int'.", "Validation")
    assert rows[11]["ValidationErrors"] == ["Field 'address1_utcoffset' could not be converted to 'int'."]
    assert rows[12]["ErrorCategory"] == "Validation"
    assert error[14] == f"Lookup resolution for 'parentcustomerid': {none}"
    assert rows[15]["Created"] is False
    accounts, contacts = table(out, "account", "accountnumber"), table(out, "contact", "emailaddress1")
    assert set(accounts) == {"T1", "DUP", "dup ", "SELF-1", "new", "TREE", "78", "SIB", "OWN"}
    assert set(contacts) == {"Primary@Example.com", "a@x", "d@x", "e@x", "f@x", "leaf@x", "g@x", "kept@x", "n@x"}
    assert accounts["new"]["name"] == "One"
    assert contacts["d@x"]["parentcustomerid"]["id"] == contacts["e@x"]["parentcustomerid"]["id"] == accounts["new"]["accountid"]
    assert accounts["TREE"]["primarycontactid"]["id"] == contacts["leaf@x"]["contactid"]
    assert accounts["OWN"]["parentaccountid"]["id"] == accounts["OWN"]["accountid"]
    assert accounts["SELF-1"]["parentaccountid"]["id"] == "self" and accounts["OWN"]["name"] == "own"
    traces = {r["idx"]: r["LookupTraces"] and json.loads(r["LookupTraces"]) for r in with_traces(out).collect()}
    assert traces[0][0]["ResolvedId"] == "t1" and traces[0][0]["AttributeName"] == "ParentCustomerId"
    assert traces[5][0]["WasCreated"] and traces[5][0]["NestedTraces"][0]["Depth"] == 1
    assert traces[6][0]["NestedTraces"] is None and traces[7] is None
    assert (traces[3][0]["WasCreated"], traces[4][0]["WasCreated"]) == (True, False)


def test_a_failing_owner_gives_way(spark):
    bad = lookup("account", {"accountnumber": "X"}, True, NestedLookups={"primarycontactid": lookup("contact", {"emailaddress1": "no@x"})})
    good = lookup("account", {"accountnumber": "X"}, True, CreateAttributes={"name": "good"})
    later = lookup("account", {"accountnumber": "Y"}, True, NestedLookups={"primarycontactid": lookup("contact", {"emailaddress1": "made@x"})})
    maker = lookup("contact", {"emailaddress1": "made@x"}, True)
    out = run(
        spark,
        {
            "Payloads": [
                payload("contact", {"emailaddress1": "1@x"}, {}, Lookups={"parentcustomerid": bad}),
                payload("contact", {"emailaddress1": "2@x"}, {}, Lookups={"parentcustomerid": good}),
                payload("contact", {"emailaddress1": "3@x"}, {}, Lookups={"parentcustomerid": later}),
                payload(keys={"accountnumber": "Z"}, attrs={}, Lookups={"primarycontactid": maker}),
            ]
        },
    )
    assert out.results.where("ErrorCategory <> 'None'").count() == 0
    accounts = table(out, "account", "accountnumber")
    assert accounts["X"]["name"] == "good" and accounts["Y"]["primarycontactid"]["id"] == accounts["Z"]["primarycontactid"]["id"]


def test_conflicts_are_tried_once_more(spark):
    targets = make_targets(spark, ACCOUNTS, CONTACTS)
    empty = make_targets(spark)
    frame = spark.createDataFrame([(1, "T1"), (2, "GONE")], "message_id int, number string")
    from weftline.sources.tables import payloads_from_table

    rows = payloads_from_table(frame, CATALOG, "account", {"accountnumber": F.col("number")}, {})
    first = R.decide_action(R.resolve_keys(rows, R.match_keys(rows, empty, CATALOG, R.key_shapes(rows))))
    assert {r["action"] for r in first.collect()} == {"create"}
    again = by(R.reresolve_conflicts(first, targets, CATALOG).collect(), "message_id")
    assert (again[1]["action"], again[1]["final_id"]) == ("update", "t1") and again[2]["action"] == "create"


def test_sinks(spark, tmp_path):
    out = run(spark, {"Payloads": [payload(), None]})
    path = str(tmp_path / "results")
    sinks.write_results(with_traces(out), path)
    lines = sorted((json.loads(r["value"]) for r in spark.read.text(path).collect()), key=lambda d: d["ErrorCategory"])
    assert list(lines[0]) == ["Id", "Created", "EntityLogicalName", "UpsertKey", "ErrorMessage", "ErrorCategory", "ValidationErrors", "LookupTraces"]
    assert lines[0]["ErrorCategory"] == "None" and lines[1]["ValidationErrors"] == ["Payload must not be null."]
    body = json.loads(sinks.response_bodies(out.results).first()["body"])
    assert [r["ErrorCategory"] for r in body] == ["None", "Validation"]
    root = str(tmp_path / "tables")
    sinks.write_entities(out.tables, root, 3)
    sinks.write_entities({"account": spark.range(1)}, root, 3)  # a finished version stays
    assert sinks.read_version(spark, root + "/account").count() == 5
    assert sinks.read_version(spark, root + "/account", before=3) is None


def test_one_key_with_a_third_of_all_rows(spark):
    """A hot key is folded on the map side and never numbered or sorted in one task."""
    n = 6000
    frame = spark.range(n).select(
        F.col("id").alias("message_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("number"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
    )
    from weftline.plans.upsert import upsert_rows
    from weftline.sources.tables import payloads_from_table

    rows = payloads_from_table(frame, CATALOG, "account", {"accountnumber": F.col("number")}, {"name": F.col("name")})
    out = upsert_rows(rows, make_targets(spark), CATALOG)
    assert out.results.count() == n and out.results.where("Created").count() == n - n // 3 + 1
    hot = out.tables["account"].where("accountnumber = 'HOT'").collect()
    assert [r["name"] for r in hot] == [f"n{n - 3}"]
    plan = out.tables["account"]._jdf.queryExecution().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_rows_without_key_or_id_are_spread(spark):
    """Invalid rows and rows without a given id must not meet in one task."""
    frame = spark.range(4000).select(
        F.col("id").alias("message_id"), F.lit(0).alias("idx"), F.lit(None).cast("string").alias("entity_name"),
        F.lit(None).cast("string").alias("identity"),
    )
    found = spark.createDataFrame([("a", "x", 1)], "entity_name string, identity string, n int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = R._join_if_set(frame, found, "identity")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 1000


def test_random_lookup_trees_keep_their_promises(spark):
    """Whatever the trees look like: one creator per record, and no reference without a record."""
    import random

    rng = random.Random(11)

    def tree(depth):
        entity = rng.choice(["account", "contact"])
        key = {"accountnumber": f"A{rng.randrange(90)}"} if entity == "account" else {"emailaddress1": f"m{rng.randrange(90)}@x"}
        node = lookup(entity, key, rng.random() < 0.7)
        if depth < 3 and rng.random() < 0.7:
            names = rng.sample(["primarycontactid", "parentaccountid", "parentcustomerid"], rng.randint(1, 2))
            node["NestedLookups"] = {n: tree(depth + 1) for n in names}
        return node

    payloads = [
        payload("contact", {"emailaddress1": f"own{i}@y"}, {}, Lookups={"parentcustomerid": tree(0), "accountid": tree(0)})
        for i in range(60)
    ]
    accounts = [{"accountid": f"a{i}", "accountnumber": f"A{i}"} for i in range(0, 90, 4)]
    out = run(spark, {"Payloads": payloads}, accounts=accounts, contacts=[])
    traces = out.traces.collect()
    makers = [t["ResolvedId"] for t in traces if t["WasCreated"]]
    assert makers and len(makers) == len(set(makers))
    ids = {r["accountid"] for r in out.tables["account"].collect()} | {r["contactid"] for r in out.tables["contact"].collect()}
    assert {t["ResolvedId"] for t in traces} <= ids
    known = {a["accountid"] for a in accounts}
    assert {t["ResolvedId"] for t in traces} <= known | set(makers)
    for entity, column in (("account", "primarycontactid"), ("account", "parentaccountid"), ("contact", "parentcustomerid")):
        for row in out.tables[entity].collect():
            assert row[column] is None or row[column]["id"] in ids
    results = by(out.results.collect(), "idx")
    top = {(t["idx"], t["AttributeName"]) for t in traces if t["Depth"] == 0}
    for i, row in results.items():
        assert (row["ErrorCategory"] == "None") == ((i, "parentcustomerid") in top and (i, "accountid") in top), i
    # A failed payload names a lookup of its own tree.
    assert all("Lookup" in r["ErrorMessage"] or "lookup" in r["ErrorMessage"] for r in results.values() if r["ErrorMessage"])
    assert any(r["ErrorMessage"] for r in results.values()) and any(not r["ErrorMessage"] for r in results.values())


def test_what_has_no_place_is_an_error_of_its_row(spark):
    """No value is lost and none ends the batch: unknown columns, narrow columns, references elsewhere, no table."""
    targets = make_targets(spark, accounts=[{"accountid": "t1", "accountnumber": "T1", "name": "old"}])
    targets["account"] = targets["account"].drop("address1_line1").withColumn("revenue", F.col("revenue").cast("decimal(10,2)"))
    del targets["contact"]
    to = {"EntityLogicalName": "account", "KeyAttributes": {"accountnumber": "T1"}}
    body = {
        "Payloads": [
            payload(keys={"accountnumber": "A"}, attrs={"address1_line1": "street"}),
            payload(keys={"accountnumber": "B"}, attrs={"revenue": 123456789012}),
            payload(keys={"accountnumber": "C"}, attrs={"revenue": 12.5}),
            payload("contact", keys={"emailaddress1": "a@b"}, attrs={"firstname": "x"}),
            payload(keys={"accountnumber": "D"}, attrs={}, Lookups={"address1_utcoffset": to}),
            payload(keys={"accountnumber": "E"}, attrs={}, Lookups={"name": to}),
            payload(keys={"accountnumber": "F"}, attrs={}, Lookups={"nosuch": to}),
            payload(keys={"accountnumber": "G"}, attrs={}, Lookups={"parentaccountid": to}),
        ]
    }
    out = upsert_batch(make_messages(spark, body), targets, CATALOG)
    rows = by(out.results.collect(), "idx")
    assert [rows[i]["ErrorCategory"] for i in range(8)] == [
        "Permanent", "Permanent", "None", "Permanent", "Permanent", "Permanent", "Permanent", "None",
    ]
    assert rows[0]["ErrorMessage"] == "Field 'address1_line1' has no column to write to."
    assert rows[1]["ErrorMessage"] == "Field 'revenue' does not fit its column."
    assert rows[3]["ErrorMessage"] == "Entity 'contact' has no table to write to."
    # A reference under a wrong name is refused when it is written, not when the payload is checked.
    assert rows[4]["ErrorMessage"] == "Field 'address1_utcoffset' cannot hold a reference." and rows[4]["ValidationErrors"] is None
    assert rows[5]["ErrorMessage"] == "Field 'name' cannot hold a reference."
    assert rows[6]["ErrorMessage"] == "Field 'nosuch' has no column to write to."
    assert {r["accountnumber"] for r in out.tables["account"].collect()} == {"T1", "C", "G"}


def test_given_ids_match_in_any_case_and_new_ids_are_free(spark):
    upper = "C9F16D4F-0000-0000-0000-00000000000A"
    targets = make_targets(spark, accounts=[{"accountid": upper, "accountnumber": "T1"}])
    change = lambda key, **more: make_messages(spark, {"Payloads": [payload(keys={"accountnumber": key}, attrs={"name": "n"}, **more)]})
    out = upsert_batch(change("T1", Id=upper.lower()), targets, CATALOG)
    assert out.results.first()["ErrorCategory"] == "None"
    assert [(r["accountid"], r["name"]) for r in out.tables["account"].collect()] == [(upper, "n")]
    # A record created under a key gets another key; the same key again makes another record.
    targets = make_targets(spark)
    made = upsert_batch(change("A"), targets, CATALOG)
    first = made.results.first()["Id"]
    moved = {**targets, "account": made.tables["account"].withColumn("accountnumber", F.lit("B"))}
    again = upsert_batch(change("A"), moved, CATALOG)
    ids = [r["accountid"] for r in again.tables["account"].collect()]
    assert len(ids) == len(set(ids)) == 2 and first in ids


def test_many_key_sets_in_one_scan(spark):
    from weftline.operators import resolve as R

    names = ["accountnumber", "name", "address1_city", "telephone1", "websiteurl", "emailaddress1", "address1_line1", "address1_postalcode", "address1_country"]
    catalog = Catalog.from_rows([("account", "accountid", "guid"), *[("account", n, "string") for n in names]])
    target = spark.createDataFrame([("id1", *[n.upper() for n in names]), ("id2", *[n for n in names[:-1]], None)], ["accountid", *names])
    sets = [s for k in range(1, 10) for s in combinations(sorted(names), k)]
    assert len(sets) > 300
    want = [("account", ",".join(f"{n}={n}" for n in s)) for s in sets]
    found = R.match_keys(spark.createDataFrame(want, "entity_name string, identity string"), {"account": target}, catalog, [("account", s) for s in sets])
    got = {r["identity"]: r["match_count"] for r in found.collect()}
    assert got == {i: 1 if "address1_country" in i else 2 for _, i in want}


def test_reference_ids_keep_their_colons(spark):
    from weftline.functions.values import typed

    row = spark.range(1).select(typed(F.lit("account:urn:7"), "reference").alias("r")).first()["r"]
    assert (row["entity"], row["id"]) == ("account", "urn:7")


def lookup_of(entity, keys, create=None, nested=None):
    node = {"EntityLogicalName": entity, "KeyAttributes": keys, "CreateIfNotExists": True}
    if create is not None:
        node["CreateAttributes"] = create
    if nested is not None:
        node["NestedLookups"] = nested
    return node


def test_records_that_lookups_create_are_refused_like_own_rows(spark):
    narrow = {"account": make_targets(spark)["account"].withColumn("revenue", F.col("revenue").cast("decimal(10,2)")), "contact": make_targets(spark)["contact"]}
    cases = [
        # A value too wide, an attribute without a column, a nested reference without a place, a good one.
        lookup_of("account", {"accountnumber": "W"}, {"revenue": 123456789012}),
        lookup_of("account", {"accountnumber": "D"}, {"description": "gone?"}),
        lookup_of("account", {"accountnumber": "P"}, {}, {"name": lookup_of("contact", {"emailaddress1": "made@x"}, {})}),
        lookup_of("account", {"accountnumber": "G"}, {"revenue": 12}),
    ]
    body = {"Payloads": [payload("contact", {"emailaddress1": f"c{i}"}, {}, Lookups={"parentcustomerid": c}) for i, c in enumerate(cases)]}
    out = upsert_batch(make_messages(spark, body), narrow, CATALOG)
    rows = by(out.results.collect(), "idx")
    assert [rows[i]["ErrorMessage"] for i in range(4)] == [
        "Lookup resolution for 'parentcustomerid': Field 'revenue' does not fit its column.",
        "Lookup resolution for 'parentcustomerid': Field 'description' has no column to write to.",
        "Lookup resolution for 'parentcustomerid': Field 'name' cannot hold a reference.",
        None,
    ]
    assert [rows[i]["ErrorCategory"] for i in range(4)] == ["Permanent"] * 3 + ["None"]
    assert [r["accountnumber"] for r in out.tables["account"].collect()] == ["G"]
    # The nested lookup had run before its parent was refused; what it made stays.
    assert {r["emailaddress1"] for r in out.tables["contact"].collect()} == {"made@x", "c3"}


def test_lookups_create_nothing_without_a_table(spark):
    targets = {"contact": make_targets(spark)["contact"]}
    body = {"Payloads": [payload("contact", {"emailaddress1": "c"}, {}, Lookups={"parentcustomerid": lookup_of("account", {"accountnumber": "N"})})]}
    out = upsert_batch(make_messages(spark, body), targets, CATALOG)
    assert out.results.first()["ErrorMessage"] == "Lookup resolution for 'parentcustomerid': Entity 'account' has no table to write to."
    assert out.tables["contact"].count() == 0


def test_references_without_a_place_are_write_errors(spark):
    good = lookup_of("account", {"accountnumber": "A"})
    body = {
        "Payloads": [
            payload("contact", {"emailaddress1": "a"}, {}, Lookups={"firstname": good}),
            payload("contact", {"emailaddress1": "b"}, {}, Lookups={"nosuch": good}),
            payload("contact", {"emailaddress1": "c"}, {"nosuch": 1}, Lookups={"nosuch": good}),
        ]
    }
    out = run(spark, body)
    rows = by(out.results.collect(), "idx")
    assert [(rows[i]["ErrorCategory"], rows[i]["ErrorMessage"]) for i in range(3)] == [
        ("Permanent", "Field 'firstname' cannot hold a reference."),
        ("Permanent", "Field 'nosuch' has no column to write to."),
        ("Validation", "Field 'nosuch' is not defined on entity 'contact'."),
    ]


def test_ids_of_lookup_creates_are_free(spark):
    first = run(spark, {"Payloads": [payload("contact", {"emailaddress1": "a"}, {}, Lookups={"parentcustomerid": lookup_of("account", {"accountnumber": "K"})})]})
    made = first.tables["account"].first()["accountid"]
    # The record has another key by now, in another spelling of its id; its old key is created again.
    accounts = [{"accountid": made.upper(), "accountnumber": "other"}]
    again = run(spark, {"Payloads": [
        payload("contact", {"emailaddress1": "b"}, {}, Lookups={"parentcustomerid": lookup_of("account", {"accountnumber": "K"})}),
        payload("account", {"accountnumber": "K"}, {"name": "own"}),
    ]}, accounts=accounts)
    table = again.tables["account"].collect()
    assert len(table) == 2 and len({r["accountid"].lower() for r in table}) == 2
    fresh = next(r for r in table if r["accountnumber"] == "K")
    contact = by(again.tables["contact"].collect(), "emailaddress1")["b"]
    assert fresh["name"] == "own" and contact["parentcustomerid"]["id"] == fresh["accountid"]


def test_conflicts_at_commit_are_decided_once_more(spark):
    base = make_targets(spark, accounts=[{"accountid": "gone", "accountnumber": "G"}, {"accountid": "kept", "accountnumber": "K"}])
    now = make_targets(spark, accounts=[{"accountid": "kept", "accountnumber": "K"}, {"accountid": "came", "accountnumber": "T1"}, {"accountid": "4277868e-8ca2-4b2b-5f11-76fe6d40d036", "accountnumber": "I"}])
    to = lambda key, create=True: {"EntityLogicalName": "account", "KeyAttributes": {"accountnumber": key}, "CreateIfNotExists": create}
    body = {
        "Payloads": [
            payload(keys={"accountnumber": "T1"}, attrs={"name": "a"}),
            payload(keys={"accountnumber": "G"}, attrs={"name": "b"}),
            payload(keys={"accountnumber": "K"}, attrs={"name": "c"}),
            payload(keys={"accountnumber": "new"}, attrs={"name": "d"}),
            payload(keys={"accountnumber": "I"}, attrs={"name": "e"}, Id="4277868e-8ca2-4b2b-5f11-76fe6d40d036"),
            payload("contact", {"emailaddress1": "x"}, {}, Lookups={"parentcustomerid": to("T1")}),
            payload("contact", {"emailaddress1": "y"}, {}, Lookups={"parentcustomerid": to("G", False)}),
            payload("contact", {"emailaddress1": "z"}, {}, Lookups={"parentcustomerid": to("made")}),
        ]
    }
    out = upsert_batch(make_messages(spark, body), base, CATALOG, fresh=lambda: now)
    rows = by(out.results.collect(), "idx")
    assert [(rows[i]["Created"], rows[i]["ErrorCategory"]) for i in range(8)] == [
        (False, "None"), (True, "None"), (False, "None"), (True, "None"), (False, "None"), (True, "None"), (False, "Permanent"), (True, "None"),
    ]
    accounts = by(out.tables["account"].collect(), "accountnumber")
    assert {k: (r["accountid"] if k in ("T1", "K", "I") else None, r["name"]) for k, r in accounts.items()} == {
        "T1": ("came", "a"), "K": ("kept", "c"), "I": ("4277868e-8ca2-4b2b-5f11-76fe6d40d036", "e"), "G": (None, "b"), "new": (None, "d"), "made": (None, None),
    }
    contacts = by(out.tables["contact"].collect(), "emailaddress1")
    assert contacts["x"]["parentcustomerid"]["id"] == "came" and contacts["z"]["parentcustomerid"]["id"] == accounts["made"]["accountid"]
    # Nothing was committed since: nothing is asked again.
    assert upsert_batch(make_messages(spark, body), now, CATALOG, fresh=lambda: None).results.count() == 8


def test_lookups_of_typed_rows_are_settled_by_compiled_code(spark):
    """Typed rows settle their lookups as bags of a message are, odd values included, without lambdas; joins move no nodes."""
    lookups = [
        Lookup("parentaccountid", "Account", {"accountnumber": F.col("n"), "REVENUE": F.col("d")}, create=True,
           create_attrs={"name": F.col("n"), "NumberOfEmployees": F.col("n"), "Revenue": F.col("d")},
           nested=[
               Lookup("primarycontactid", "contact", {"emailaddress1": F.col("n")}, create=True, create_attrs={"gendercode": F.col("n")},
                  nested=[Lookup("accountid", "account", {"revenue": F.col("d"), "AccountNumber": F.upper("n")}, create=True,
                             nested=[Lookup("parentaccountid", "account", {"accountnumber": F.col("n")})])]),
               Lookup("name", "account", {"accountid": F.col("n")}, max_depth=1),
           ]),
        Lookup("primarycontactid", "contact", {"birthdate": F.col("n"), "nosuch": F.col("d")}, create=True),
        Lookup("x", "unknown", {"a": F.col("n")}, create=True),
        Lookup("y", "contact", {}, create=True, create_attrs={"firstname": F.col("n")}),
    ]
    frame = spark.createDataFrame([(1, "A ,=", 1.5), (2, None, None), (3, "Male", 0.0)], "message_id int, n string, d double")
    rows = payloads_from_table(frame, CATALOG, "contact", {"emailaddress1": F.col("n")}, {}, lookups, options=Options(max_lookup_depth=3))
    targets = make_targets(spark, ACCOUNTS, CONTACTS)
    settled = L.explode_lookups(rows, CATALOG, targets)
    order = lambda df: sorted(map(str, df.collect()))
    from_bags = L.explode_lookups(rows.drop("settled_nodes"), CATALOG, targets)
    assert settled.columns == from_bags.columns and order(settled) == order(from_bags)
    errors = {r["ord"]: r["error"] for r in settled.where("message_id = 1").collect()}
    assert errors[".0000000.0000000.0000000"].startswith("Cyclic lookup detected for 'accountid' (account:accountnumber=A \\,\\=,revenue=1.5)")
    assert errors[".0000000.0000000.0000000.0000000"].endswith("exceeded maximum depth of 3.")
    assert "lambda" not in settled._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    rows = payloads_from_table(frame, CATALOG, "contact", {"emailaddress1": F.col("n")}, {}, lookups[:1])
    profile = profile_of("contact", {"emailaddress1": F.col("n")}, lookups[:1])
    decision = decide(rows, targets, CATALOG, profile=profile)
    assert not {"nodes", "settled_nodes", "lookup_names", "misplaced"} & set(decision.writes.columns)
    assert "create_values" not in decision.outcomes.columns


def test_stages_of_long_expressions_are_left_to_small_methods(spark):
    """A method of more than 8000 bytes of bytecode is never compiled by the JVM."""
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
