"""Validation texts, conversions, keys."""

import pytest
from conftest import CATALOG, make_messages, payload
from pyspark.sql import functions as F

from weftline import Catalog, Options
from weftline.functions import keys as K
from weftline.functions import values as V
from weftline.operators.validate import validate_and_convert, validate_batch
from weftline.sources.messages import explode_payloads, parse_batches
from weftline.sources.tables import Lookup, payloads_from_table


def check(spark, *payloads, options=Options()):
    rows = validate_and_convert(
        explode_payloads(parse_batches(make_messages(spark, {"Payloads": list(payloads)}))), CATALOG, options
    )
    return rows.orderBy("idx").collect()


def test_structural_and_kind_errors(spark):
    rows = check(
        spark,
        None,
        {"EntityLogicalName": " ", "KeyAttributes": {}, "Attributes": None},
        payload(entity="nope"),
        payload(attrs={"nofield": 1, "name": 5, "adx_identity_x": 1, "primarycontactid": "x", "entityimage": "AA"}),
        payload(entity="contact", keys={"emailaddress1": "a@b.c"}, attrs={"adx_identity_passwordhash": "h"}),
        payload(entity="contact", keys={"adx_identity_passwordhash": "u"}, attrs={}),
        payload(keys={"zip": 1, "revenue": "x", "name": "n"}, attrs={"name": "m", "industrycode": True}),
        payload(attrs={"NAME": "x", "address1_utcoffset": None, "creditonhold": "true", "revenue": True}),
        payload(attrs={"address1_utcoffset": 1.5, "lastonholdtime": "15.06.2024"}),
        payload(keys={"accountnumber": "A", "address1_utcoffset": 2.5}, attrs={"name": "x"}),
        payload(keys={"Name": "k"}, attrs={"name": "v"}),
        payload(attrs={"industrycode": "NotARealIndustry", "accountid": "zzz"}),
        payload(attrs={"accountid": "zzz"}),
    )
    got = [r["errors"] for r in rows]
    bad = lambda f, t: f"Field '{f}' has invalid type. Expected '{t}'."
    assert got[0] == ["Payload must not be null."]
    assert got[1] == [
        "KeyAttributes must contain at least one entry for the main entity.",
        "EntityLogicalName is required.",
        "Attributes are required.",
    ]
    assert got[2] == ["Entity 'nope' does not exist in the early-bound model."]
    assert got[3] == [
        "Field 'nofield' is not defined on entity 'account'.",
        bad("name", "string"),
        "Field 'adx_identity_x' is not defined on entity 'account'.",
        bad("primarycontactid", "EntityReference"),
        bad("entityimage", "Byte[]"),
    ]
    assert got[4] == ["Field 'adx_identity_passwordhash' is not writable through this endpoint."]
    assert got[5] == ["KeyAttribute 'adx_identity_passwordhash' is not usable through this endpoint."]
    assert got[6] == [
        bad("industrycode", "OptionSetValue (account_industrycode)"),
        "KeyAttribute 'zip' is not defined on entity 'account'.",
        "KeyAttribute 'revenue' has invalid type. Expected 'Money'.",
        "KeyAttribute 'name' must not also be present in Attributes.",
    ]
    assert got[7] == [bad("creditonhold", "bool"), bad("revenue", "Money")]
    assert got[8] == ["Field 'address1_utcoffset' could not be converted to 'int'."]
    assert got[9] == ["Field 'address1_utcoffset' could not be converted to 'int'."]
    # Keys that differ by case only pass, and the key value wins.
    assert got[10] is None and rows[10]["values"] == {"name": "k"}
    assert got[11] == [bad("industrycode", "OptionSetValue (account_industrycode)")]
    assert got[12] == ["Field 'accountid' could not be converted to 'guid'."]


def test_lookup_errors_carry_their_path(spark):
    rows = check(
        spark,
        payload(
            Lookups={
                "a": None,
                "b": {"EntityLogicalName": "", "KeyAttributes": {}},
                "c": {
                    "EntityLogicalName": "account",
                    "KeyAttributes": {"zip": 1},
                    "CreateAttributes": {"zap": 1, "name": 5},
                    "NestedLookups": {
                        "d": {"EntityLogicalName": "nope", "KeyAttributes": {"x": 1}},
                        "e": {"EntityLogicalName": "contact", "KeyAttributes": {"adx_identity_passwordhash": 1}},
                    },
                },
                "f": {"EntityLogicalName": "account", "KeyAttributes": {"name": 5}},
            }
        ),
    )
    assert rows[0]["errors"] == [
        "Lookups.a: Lookup definition must not be null.",
        "Lookups.b: EntityLogicalName is required.",
        "Lookups.b: KeyAttributes must contain at least one entry.",
        "Lookups.c.KeyAttributes: Field 'zip' is not defined on entity 'account'.",
        "Lookups.c.CreateAttributes: Field 'zap' is not defined on entity 'account'.",
        "Lookups.c.d: Entity 'nope' does not exist in the early-bound model.",
        "Lookups.c.e.KeyAttributes: Field 'adx_identity_passwordhash' is not writable through this endpoint.",
    ]


def test_first_bad_payload_of_a_batch(spark):
    frame = validate_and_convert(
        explode_payloads(parse_batches(make_messages(spark, {"Payloads": [payload(), None, payload(entity="x")]}))), CATALOG
    )
    assert validate_batch(frame).first()["errors"] == ["Payload[1]: Payload must not be null."]


def test_conversions(spark):
    attrs = {
        "name": {"q": [1, "x"]},
        "industrycode": " accounting ",
        "revenue": 1234.5,
        "exchangerate": 2,
        "address1_latitude": 52.5,
        "versionnumber": 3_000_000_000,
        "numberofemployees": -7,
        "creditonhold": False,
        "lastonholdtime": "2024-06-15T12:30:00+02:00",
        "createdon": "2024-06-15T10:30:00",
        "accountid": "{6F9619FF-8B86-D011-B42D-00C04FC964FF}",
        "address1_city": None,
    }
    row = check(spark, payload(attrs=attrs))[0]
    assert row["errors"] is None
    micros = str(1718447400000000)
    assert row["values"] == {
        "name": '{"q":[1,"x"]}', "industrycode": "1", "revenue": "1234.5000000000", "exchangerate": "2.0000000000",
        "address1_latitude": "52.5", "versionnumber": "3000000000", "numberofemployees": "-7", "creditonhold": "false",
        "lastonholdtime": micros, "createdon": micros, "accountid": "6f9619ff-8b86-d011-b42d-00c04fc964ff",
        "address1_city": None, "accountnumber": "EXT-001",
    }
    codes = check(spark, *[payload(attrs={"industrycode": v}) for v in (7, "7", "-3", "Accounting,accounting", "1,2", 1.0, "")])
    assert [r["values"]["industrycode"] if r["values"] else None for r in codes] == ["7", "7", "-3", "1", None, None, None]


def test_dates_that_stay_text(spark):
    texts = ["2024-01", "15.06.2024", "ACC-2024-01-15", "Jan 15 2024", "2024-13-45", "2024-06-15T10:30:00", "2024-06-15 10:30:00Z", "2024-01-15 Europe/Paris"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["s"] for r in frame.select("i", F.unix_seconds(V.timestamp_of(F.col("t"))).alias("s")).orderBy("i").collect()]
    assert got == [None] * 5 + [1718447400] * 2 + [None]


@pytest.mark.parametrize(
    "entity,keys,expected",
    [
        ("Account", {"AccountNumber": "ACCT-1001"}, "account:accountnumber=ACCT-1001"),
        ("contact", {"lastname": "Doe", "emailaddress1": "a@b.c"}, "contact:emailaddress1=a@b.c,lastname=Doe"),
        ("account", {"key": "a\\b,c=d:e"}, "account:key=a\\\\b\\,c\\=d\\:e"),
        ("account", {"a": "1,b=2"}, "account:a=1\\,b\\=2"),
        ("account", {"b": "2", "a": "1"}, "account:a=1,b=2"),
        ("account", {"d": "2024-01-15"}, "account:d=2024-01-15T00\\:00\\:00.0000000Z"),
        ("account", {"g": "6F9619FF-8B86-D011-B42D-00C04FC964FF"}, "account:g=6f9619ff-8b86-d011-b42d-00c04fc964ff"),
        ("account", {"t": True, "f": False, "n": None, "i": 42}, "account:f=False,i=42,n=null,t=True"),
        ("account", {"a_b": "1", "ab": "2"}, "account:ab=2,a_b=1"),
        ("account", {}, None),
        (" ", {"a": "1"}, None),
    ],
)
def test_signatures(spark, entity, keys, expected):
    import json

    from weftline.functions.json_text import bag

    frame = spark.createDataFrame([(entity, json.dumps(keys))], "e string, k string")
    assert frame.select(K.signature(F.col("e"), bag(F.col("k"))).alias("s")).first()["s"] == expected


def test_untyped_values(spark):
    from weftline.functions.json_text import bag

    text = (
        '{"n":null,"b":true,"g":"6F9619FF-8B86-D011-B42D-00C04FC964FF","d":"2025-06-15T10:30:00Z","s":"hello",'
        '"i":42,"l":3000000000,"m":1.5,"a":[1,2],"o":{"x":1}}'
    )
    frame = spark.createDataFrame([(text,)], "t string").select(F.explode(bag(F.col("t"))).alias("k", "v"))
    got = {r["k"]: r["s"] for r in frame.select("k", V.normalized_kind(F.col("v.kind"), F.col("v.raw")).alias("s")).collect()}
    assert got == {
        "n": "null", "b": "bool", "g": "guid", "d": "datetime", "s": "string", "i": "int", "l": "long",
        "m": "decimal", "a": "array", "o": "object",
    }


def test_table_rows_are_checked_by_type(spark):
    frame = spark.createDataFrame(
        [(1, "A", "x", 5, "nope", 1.5)], "message_id int, number string, name string, offset int, kind string, money double"
    )
    rows = payloads_from_table(
        frame, CATALOG, "account", {"accountnumber": F.col("number")},
        {"name": F.col("offset"), "address1_utcoffset": F.col("name"), "industrycode": F.col("kind"), "revenue": F.col("money"), "zip": F.col("name")},
    ).first()
    assert rows["errors"] == [
        "Field 'name' has invalid type. Expected 'string'.",
        "Field 'address1_utcoffset' has invalid type. Expected 'int'.",
        "Field 'industrycode' has invalid type. Expected 'OptionSetValue (account_industrycode)'.",
        "Field 'zip' is not defined on entity 'account'.",
    ]
    good = payloads_from_table(
        frame, CATALOG, "account", {"accountnumber": F.col("number")},
        {"revenue": F.col("money"), "numberofemployees": F.col("offset").cast("byte"), "lastonholdtime": F.lit("2024-06-15")},
        lookups=[Lookup("primarycontactid", "contact", {"emailaddress1": F.col("name")})],
    ).first()
    assert good["errors"] is None and good["sig"] == "account:accountnumber=A"
    assert good["values"] == {
        "revenue": "1.5000000000", "numberofemployees": "5", "lastonholdtime": "1718409600000000", "accountnumber": "A",
    }
    assert good["nodes"][0]["sig"] == "contact:emailaddress1=x"


def test_options_and_catalog_are_checked(spark):
    with pytest.raises(ValueError):
        Options(max_lookup_depth=11)
    with pytest.raises(ValueError):
        Options(max_request_bytes=10)
    with pytest.raises(ValueError):
        Catalog.from_rows([("a", "x", "choice", "missing")])
    again = Catalog.from_frames(
        CATALOG.attribute_frame(spark), spark.createDataFrame([("account_industrycode", "Accounting", 1), ("contact_gendercode", "Male", 1)], "option_set string, name string, code int")
    )
    assert again.entities["account"]["revenue"].type == "money"
    derived = Catalog.from_schemas({"t": spark.createDataFrame([], "tid string, n int, r struct<entity:string,id:string>, a array<int>").schema})
    assert [s.type for s in derived.entities["t"].values()] == ["string", "int", "reference", "choices"]
