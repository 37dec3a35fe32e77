"""Account documents: checks, three phases, statuses."""

from conftest import CATALOG, by, make_messages, make_targets

from weftline import Options
from weftline.operators import documents as D
from weftline.plans.account_documents import upsert_account_documents
from weftline.sources.documents import parse_account_documents, read_account_documents


def contact(i, **change):
    return {"Email": f"c{i}@x.com", "FirstName": f"F{i}", "LastName": f"L{i}", **change}


def document(number="DOC-000001", **change):
    return {"AccountNumber": number, "Name": "Acme", **change}


def errors_of(spark, *bodies, options=Options()):
    rows = D.validate_account_documents(parse_account_documents(make_messages(spark, *bodies), options))
    return by(rows.collect(), "message_id")


def test_guards_and_checks(spark):
    no_name = document()
    del no_name["Name"]
    got = errors_of(
        spark,
        document(Contacts=[contact(1), contact(2)]),
        no_name,
        document(Name=None, AccountNumber=" "),
        document(Contacts=[None, contact(1, Email=" "), contact(2, LastName=""), contact(3, FirstName=None)]),
        document(Contacts=[contact(1, Email="A@x.com"), contact(2, Email=" a@X.com "), contact(3, IsPrimary=True), contact(4, IsPrimary=True)]),
        document(Contacts=[contact(1, IsPrimary="yes")]),
        document(City=5),
        document(Contacts=[contact(i) for i in range(4)]),
        document(Contacts=None),
        "null",
        document(Contacts=[5]),
        document(Contacts={}),
        options=Options(max_batch_items=3 + 1),
    )
    bad = (400, "Invalid request: The body is not a valid account document.")
    status = {i: (r["guard_status"], r["guard_error"]) for i, r in got.items()}
    assert all(status[i] == bad for i in (1, 5, 6, 10, 11))
    assert status[9] == (400, "Invalid request: Request body must contain a JSON object.")
    assert got[0]["errors"] == got[7]["errors"] == got[8]["errors"] == []
    assert got[2]["errors"] == ["AccountNumber is required.", "Name is required."]
    assert got[3]["errors"] == [
        "Contacts[0]: must not be null.",
        "Contacts[1]: Email is required (used as the contact key).",
        "Contacts[2]: LastName is required.",
        "Contacts[3]: FirstName is required.",
    ]
    assert got[4]["errors"] == [
        "Contacts[1]: duplicate Email ' a@X.com ' — contact keys must be unique per request.",
        "Exactly one contact may be marked IsPrimary (found 2).",
    ]
    few = errors_of(spark, document(Contacts=[contact(i) for i in range(4)]), options=Options(max_batch_items=3))
    assert few[0]["guard_error"] == "Invalid request: Contacts count (4) exceeds the maximum of 3."


def test_mapping(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"accountnumber":"A1","NAME":"N","City":"C","Street":"S","PostalCode":"P","Country":"L","Phone":"T","Email":"E",'
        '"Website":"W","Contacts":[{"Email":"m","FirstName":"f","LastName":"l","JobTitle":null,"Phone":"1","IsPrimary":true}]}'
    )
    documents = read_account_documents(spark, str(tmp_path))
    account = D.map_accounts(documents).first()
    assert account["values"] == {
        "name": "N", "address1_city": "C", "address1_line1": "S", "address1_postalcode": "P", "address1_country": "L",
        "telephone1": "T", "emailaddress1": "E", "websiteurl": "W", "accountnumber": "A1",
    }
    assert account["sig"] == "account:accountnumber=A1"
    person = D.map_contacts(documents).first()
    assert person["values"] == {"firstname": "f", "lastname": "l", "telephone1": "1", "emailaddress1": "m"}
    link = D.map_primary_links(documents).first()
    assert (link["contact_idx"], link["idx"]) == (1, 2)


def test_three_phases(spark):
    targets = make_targets(
        spark,
        [{"accountid": "a1", "accountnumber": "OLD", "name": "x"}, {"accountid": "d1", "accountnumber": "DUP"}, {"accountid": "d2", "accountnumber": "DUP"}],
        [{"contactid": "k1", "emailaddress1": "two@x.com"}, {"contactid": "k2", "emailaddress1": "two@x.com"}, {"contactid": "k3", "emailaddress1": "c9@x.com"}],
    )
    out = upsert_account_documents(
        make_messages(
            spark,
            document("NEW", Contacts=[contact(1), contact(9, IsPrimary=True)]),
            document("OLD", Contacts=[contact(5), contact(6, Email="two@x.com", IsPrimary=True)]),
            document("DUP", Contacts=[contact(7, IsPrimary=True)]),
            document("BAD", Name=""),
            document("PLAIN"),
        ),
        targets,
        CATALOG,
    )
    rows = by(out.results.collect(), "message_id", "idx")
    assert {k: r["ErrorCategory"] for k, r in rows.items()} == {
        (0, 0): "None", (0, 1): "None", (0, 2): "None", (0, 3): "None",
        (1, 0): "None", (1, 1): "None", (1, 2): "Permanent", (1, 3): "Permanent",
        (2, 0): "Permanent", (4, 0): "None",
    }
    assert rows[1, 3]["ErrorMessage"] == "Primary contact link skipped: the primary contact upsert did not succeed (Permanent)."
    assert rows[1, 3]["UpsertKey"] == "account:accountnumber=OLD" and rows[1, 3]["ValidationErrors"] is None
    assert (rows[0, 0]["Created"], rows[0, 3]["Created"], rows[0, 3]["Id"]) == (True, False, rows[0, 0]["Id"])
    status = by(out.status.collect(), "message_id")
    assert [status[i]["status"] for i in range(5)] == [200, 500, 500, 400, 200]
    assert out.refused.first()["details"] == ["Name is required."]
    accounts, contacts = by(out.tables["account"].collect(), "accountnumber"), by(out.tables["contact"].collect(), "contactid")
    assert accounts["NEW"]["primarycontactid"]["id"] == "k3" and accounts["OLD"]["primarycontactid"] is None
    assert contacts["k3"]["parentcustomerid"] == (("account", accounts["NEW"]["accountid"]))
    assert out.tables["contact"].count() == 5
