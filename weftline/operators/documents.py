"""Account documents: checks, and the changes each document stands for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import keys as K
from weftline.functions.json_text import BAG_DDL
from weftline.functions.text import collected, is_blank, message, trimmed
from weftline.operators.lookup_tree import NODE_DDL

# Document member -> column.
ACCOUNT_COLUMNS = {
    "Name": "name",
    "City": "address1_city",
    "Street": "address1_line1",
    "PostalCode": "address1_postalcode",
    "Country": "address1_country",
    "Phone": "telephone1",
    "Email": "emailaddress1",
    "Website": "websiteurl",
}
CONTACT_COLUMNS = {"FirstName": "firstname", "LastName": "lastname", "Phone": "telephone1", "JobTitle": "jobtitle"}


def validate_account_documents(documents: DataFrame) -> DataFrame:
    """Add ``errors``: everything wrong with a document, in reading order."""
    mails = F.transform("Contacts", lambda c: F.when(~is_blank(c["Email"]), F.lower(trimmed(c["Email"]))))

    def of(c: Column, i: Column) -> Column:
        at = F.concat(F.lit("Contacts["), i.cast("string"), F.lit("]: "))
        present = ~c["absent"]
        mail = F.lower(trimmed(c["Email"]))
        return collected(
            F.when(c["absent"], message(at, "must not be null.")),
            F.when(present & is_blank(c["Email"]), message(at, "Email is required (used as the contact key).")),
            F.when(
                present & ~is_blank(c["Email"]) & (F.array_position(F.col("_mails"), mail) <= i),
                message(at, "duplicate Email '", c["Email"], "' — contact keys must be unique per request."),
            ),
            F.when(present & is_blank(c["FirstName"]), message(at, "FirstName is required.")),
            F.when(present & is_blank(c["LastName"]), message(at, "LastName is required.")),
        )

    primaries = F.size(F.filter("Contacts", lambda c: c["IsPrimary"]))
    return (
        documents.withColumn("_mails", mails)
        .withColumn(
            "errors",
            F.concat(
                collected(
                    F.when(is_blank(F.col("AccountNumber")), F.lit("AccountNumber is required.")),
                    F.when(is_blank(F.col("Name")), F.lit("Name is required.")),
                ),
                F.flatten(F.transform("Contacts", of)),
                collected(
                    F.when(
                        primaries > 1,
                        message("Exactly one contact may be marked IsPrimary (found ", primaries, ")."),
                    )
                ),
            ),
        )
        .drop("_mails")
    )


def _text_map(columns: Mapping[str, Column]) -> Column:
    return F.create_map(*[part for name, value in columns.items() for part in (F.lit(name), value)])


def _supplied(columns: Mapping[str, Column]) -> Column:
    """Optional members: null means not supplied."""
    return F.map_filter(_text_map(columns), lambda _, v: v.isNotNull())


def _change_rows(
    frame: DataFrame, idx: Column, entity: str, key: str, key_value: Column, values: Column, *extra: str
) -> DataFrame:
    bag = F.create_map(F.lit(key), F.struct(F.lit("text").alias("kind"), key_value.alias("raw"))).cast(BAG_DDL)
    keys = F.create_map(F.lit(key), key_value)
    return frame.select(
        "message_id",
        idx.cast("int").alias("idx"),
        F.lit(False).alias("is_null"),
        F.lit(entity).alias("entity"),
        F.lit(entity).alias("entity_name"),
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("source"),
        F.array().cast(NODE_DDL).alias("nodes"),
        K.signature(F.lit(entity), bag).alias("sig"),
        F.lit(None).cast("array<string>").alias("errors"),
        keys.alias("key_values"),
        F.map_concat(values, keys).alias("values"),
        K.identity(keys).alias("identity"),
        F.array(F.lit(key)).alias("key_names"),
        *extra,
    )


def map_accounts(documents: DataFrame) -> DataFrame:
    """One account change per document."""
    values = _supplied({column: F.col(member) for member, column in ACCOUNT_COLUMNS.items()})
    return _change_rows(documents, F.lit(0), "account", "accountnumber", F.col("AccountNumber"), values)


def map_contacts(documents: DataFrame) -> DataFrame:
    """One contact change per contact, keyed by e-mail. With ``account_id`` it points to the account."""
    rows = documents.select("*", F.posexplode("Contacts").alias("_i", "c"))
    values = _supplied({column: F.col(f"c.{member}") for member, column in CONTACT_COLUMNS.items()})
    if "account_id" in documents.columns:
        parent = F.create_map(F.lit("parentcustomerid"), F.concat(F.lit("account:"), F.col("account_id")))
        values = F.map_concat(values, parent)
    return _change_rows(rows, F.col("_i") + 1, "contact", "emailaddress1", F.col("c.Email"), values)


def map_primary_links(documents: DataFrame) -> DataFrame:
    """One row per document with a primary contact: which of its contact rows that is."""
    marks = F.transform("Contacts", lambda c: c["IsPrimary"])
    place = F.array_position(marks, F.lit(True))
    return documents.where(place > 0).select(
        "message_id",
        "AccountNumber",
        place.cast("int").alias("contact_idx"),
        (F.size("Contacts") + 1).alias("idx"),
    )
