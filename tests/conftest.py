import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weftline import Catalog, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


CATALOG = Catalog.from_rows(
    [
        ("account", "accountid", "guid"),
        *[
            ("account", c, "string")
            for c in (
                "accountnumber", "name", "address1_city", "emailaddress1", "telephone1", "websiteurl",
                "address1_line1", "address1_postalcode", "address1_country", "description",
            )
        ],
        ("account", "address1_utcoffset", "int"),
        ("account", "numberofemployees", "int"),
        ("account", "versionnumber", "long"),
        ("account", "revenue", "money"),
        ("account", "creditlimit", "money"),
        ("account", "exchangerate", "decimal"),
        ("account", "address1_latitude", "double"),
        ("account", "creditonhold", "bool"),
        ("account", "lastonholdtime", "datetime"),
        ("account", "createdon", "datetime"),
        ("account", "industrycode", "choice", "account_industrycode"),
        ("account", "primarycontactid", "reference"),
        ("account", "parentaccountid", "reference"),
        ("account", "entityimage", "binary", None, False),
        ("contact", "contactid", "guid"),
        *[("contact", c, "string") for c in ("emailaddress1", "firstname", "lastname", "jobtitle", "telephone1")],
        ("contact", "gendercode", "choice", "contact_gendercode"),
        ("contact", "birthdate", "datetime"),
        ("contact", "parentcustomerid", "reference"),
        ("contact", "accountid", "reference"),
        ("contact", "adx_identity_passwordhash", "string", None, False),
    ],
    [
        ("account_industrycode", "Accounting", 1),
        ("contact_gendercode", "Male", 1),
        ("contact_gendercode", "Female", 2),
    ],
)


@pytest.fixture(scope="session")
def catalog():
    return CATALOG


REFERENCE = "struct<entity:string,id:string>"
ACCOUNT_DDL = (
    "accountid string, accountnumber string, name string, address1_city string, address1_line1 string, "
    "address1_utcoffset int, revenue decimal(38,10), creditonhold boolean, createdon timestamp, industrycode int, "
    "numberofemployees int, "
    f"primarycontactid {REFERENCE}, parentaccountid {REFERENCE}"
)
CONTACT_DDL = (
    "contactid string, emailaddress1 string, firstname string, lastname string, telephone1 string, jobtitle string, "
    f"gendercode int, parentcustomerid {REFERENCE}, accountid {REFERENCE}"
)


def make_targets(spark, accounts=(), contacts=()):
    def fill(rows, ddl):
        names = [c.split()[0] for c in ddl.replace("(38,10)", "").split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)

    return {"account": fill(accounts, ACCOUNT_DDL), "contact": fill(contacts, CONTACT_DDL)}


def make_messages(spark, *bodies):
    rows = [(i, b if isinstance(b, str) or b is None else json.dumps(b), None) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "message_id bigint, body string, correlation_id string")


def payload(entity="account", keys=None, attrs=None, **more):
    return {
        "EntityLogicalName": entity,
        "KeyAttributes": {"accountnumber": "EXT-001"} if keys is None else keys,
        "Attributes": {"name": "Test Account"} if attrs is None else attrs,
        **more,
    }


def by(rows, *names):
    return {tuple(r[n] for n in names) if len(names) > 1 else r[names[0]]: r for r in rows}
