"""Account documents: one account with its contacts per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.functions import json_text as J
from weftline.functions.text import message
from weftline.operators.guards import readable, too_large
from weftline.sources.messages import read_messages

# Members of an account document and of a contact in it.
ACCOUNT_MEMBERS = (
    "AccountNumber", "Name", "City", "Street", "PostalCode", "Country", "Phone", "Email", "Website",
)
CONTACT_MEMBERS = ("Email", "FirstName", "LastName", "Phone", "JobTitle")
_REQUIRED_ACCOUNT = ("AccountNumber", "Name")
_REQUIRED_CONTACT = ("Email", "FirstName", "LastName")

CONTACTS_DDL = (
    "array<struct<absent:boolean,"
    + ",".join(f"{n}:string" for n in CONTACT_MEMBERS)
    + ",IsPrimary:boolean>>"
)


def read_account_documents(
    spark: SparkSession, path: str, options: Options = Options(), **read_options: str
) -> DataFrame:
    return parse_account_documents(read_messages(spark, path, **read_options), options)


def _texts_ok(members: Column, names: tuple[str, ...], required: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for name in names:
        kind = J.kind_of_member(members, name.lower())
        ok = ok & F.coalesce(kind.isin("string", "null"), F.lit(name not in required))
    return ok


def _contact_ok(members: Column) -> Column:
    primary = J.kind_of_member(members, "isprimary")
    return F.when(members.isNull(), True).otherwise(
        _texts_ok(members, CONTACT_MEMBERS, _REQUIRED_CONTACT) & F.coalesce(primary == "bool", F.lit(True))
    )


def parse_account_documents(messages: DataFrame, options: Options = Options()) -> DataFrame:
    """Parse and guard account documents: size, JSON, member types, number of contacts."""
    m = F.col("_m")
    contacts_kind = J.kind_of_member(m, "contacts")
    body = readable(F.col("body"), options)
    parsed = messages.withColumn("_m", J.document(body)).withColumn(
        "_contacts", F.when(contacts_kind == "array", J.bags(J.raw_of(m, "contacts")))
    )
    well_formed = (
        m.isNotNull()
        & ~J.nests_deeper_than(body, options.max_json_depth)
        & _texts_ok(m, ACCOUNT_MEMBERS, _REQUIRED_ACCOUNT)
        & F.coalesce(
            F.when(contacts_kind == "array", F.col("_contacts").isNotNull()).otherwise(contacts_kind == "null"),
            F.lit(True),
        )
        & F.coalesce(F.forall("_contacts", _contact_ok), F.lit(True))
    )
    count = F.coalesce(F.size("_contacts"), F.lit(0))
    error = (
        F.when(
            too_large(F.col("body"), options.max_request_bytes),
            F.lit(f"Request body exceeds the maximum allowed size of {options.max_request_bytes} bytes."),
        )
        .when(J.is_null_document(F.coalesce("body", F.lit("null"))), "Invalid request: Request body must contain a JSON object.")
        .when(~F.coalesce(well_formed, F.lit(False)), "Invalid request: The body is not a valid account document.")
        .when(
            count > options.max_batch_items,
            message("Invalid request: Contacts count (", count, f") exceeds the maximum of {options.max_batch_items}."),
        )
    )
    status = F.when(too_large(F.col("body"), options.max_request_bytes), 413).when(F.col("guard_error").isNotNull(), 400)
    described = F.transform(
        "_contacts",
        lambda c: F.struct(
            c.isNull().alias("absent"),
            *[J.raw_of(c, n.lower()).alias(n) for n in CONTACT_MEMBERS],
            F.coalesce(J.raw_of(c, "isprimary") == "true", F.lit(False)).alias("IsPrimary"),
        ),
    )
    return (
        parsed.withColumn("guard_error", error)
        .withColumn("guard_status", status.cast("int"))
        .select(
            "message_id",
            "correlation_id",
            "guard_status",
            "guard_error",
            *[J.raw_of(m, n.lower()).alias(n) for n in ACCOUNT_MEMBERS],
            F.when(F.col("guard_status").isNull(), F.coalesce(described, F.array().cast(CONTACTS_DDL)))
            .cast(CONTACTS_DDL)
            .alias("Contacts"),
        )
    )
