"""Account documents to linked account and contact rows: three passes over all documents."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.catalog import Catalog
from weftline.config import Options
from weftline.functions.text import message
from weftline.operators import documents as D
from weftline.operators import merge as M
from weftline.operators import results as S
from weftline.operators.resolve import Profile
from weftline.plans.upsert import changes_of, decide, results_of
from weftline.session import configure, cut_lineage
from weftline.sources.documents import parse_account_documents


@dataclass
class DocumentOutcome:
    results: DataFrame
    tables: dict[str, DataFrame]
    status: DataFrame
    refused: DataFrame


def _links(documents: DataFrame, accounts: DataFrame, contacts: DataFrame) -> DataFrame:
    """Primary links with both ids, or with the category of the contact that failed."""
    wanted = D.map_primary_links(documents)
    linked = wanted.join(accounts, "message_id").join(
        contacts.select(
            "message_id",
            F.col("idx").alias("contact_idx"),
            F.col("final_id").alias("contact_id"),
            F.col("error").alias("contact_error"),
            "category",
        ),
        ["message_id", "contact_idx"],
    )
    failed = F.col("contact_error").isNotNull()
    return linked.select(
        "message_id",
        "idx",
        F.lit("account").alias("entity"),
        F.lit("account").alias("entity_name"),
        "sig",
        F.col("account_id").alias("final_id"),
        F.lit(False).alias("created"),
        F.col("account_action").alias("action"),
        F.when(
            failed,
            message("Primary contact link skipped: the primary contact upsert did not succeed (", F.col("category"), ")."),
        ).alias("error"),
        F.when(failed, F.col("category")).alias("category"),
        F.create_map(
            F.lit("accountnumber"),
            F.col("AccountNumber"),
            F.lit("primarycontactid"),
            F.concat(F.lit("contact:"), F.col("contact_id")),
        ).alias("values"),
    )


def upsert_account_documents(
    messages: DataFrame,
    targets: Mapping[str, DataFrame],
    catalog: Catalog,
    options: Options = Options(),
    salt: str = "",
) -> DocumentOutcome:
    """Accounts first, then the contacts of accounts that were written, then the primary links.

    A failed account ends its document: only the account's result is reported.
    """
    configure(messages.sparkSession)
    documents = cut_lineage(D.validate_account_documents(parse_account_documents(messages, options)))
    good = documents.where(F.col("guard_status").isNull() & (F.size("errors") == 0))

    by_number = Profile([("account", ("accountnumber",))], 0, False)
    by_mail = Profile([("contact", ("emailaddress1",))], 0, False)
    accounts = decide(D.map_accounts(good), targets, catalog, options, salt, by_number)
    written = accounts.writes.where(F.col("error").isNull()).select(
        "message_id", "sig", F.col("final_id").alias("account_id"), F.col("action").alias("account_action")
    )
    contacts = decide(
        D.map_contacts(good.join(written.select("message_id", "account_id"), "message_id")),
        targets,
        catalog,
        options,
        salt,
        by_mail,
    )
    links = _links(good, written, contacts.writes)
    refusal = F.when(F.col("error").isNull(), M.write_refusals(links, targets, catalog))
    links = cut_lineage(
        links.withColumn("category", F.when(refusal.isNotNull(), "Permanent").otherwise(F.col("category"))).withColumn(
            "error", F.coalesce("error", refusal)
        )
    )

    made = links.where(F.col("error").isNull())
    skipped = links.where(F.col("error").isNotNull()).select(
        "message_id", "idx", "entity", "sig", "error", "category",
        F.lit(None).cast("array<string>").alias("errors"),
    )
    skipped_results = S.error_results(skipped).withColumn("ValidationErrors", F.lit(None).cast("array<string>"))
    results = (
        results_of(accounts)
        .unionByName(results_of(contacts))
        .unionByName(S.success_results(made))
        .unionByName(skipped_results)
    )
    link_changes = made.select(
        "entity_name",
        F.col("final_id").alias("id"),
        F.struct(F.lit(3).alias("phase"), "message_id", "idx", F.lit("").alias("ord")).alias("seq"),
        (F.col("action") == "update").alias("exists"),
        "values",
    )
    changes = changes_of(accounts, 1).unionByName(changes_of(contacts, 2)).unionByName(link_changes)
    refused = documents.where(F.col("guard_status").isNotNull() | (F.size("errors") > 0)).select(
        "message_id",
        "correlation_id",
        F.coalesce("guard_error", F.lit("Validation failed.")).alias("error"),
        F.when(F.col("guard_status").isNull(), F.col("errors")).alias("details"),
    )
    heads = documents.select(
        "message_id",
        "correlation_id",
        F.coalesce("guard_status", F.when(F.size("errors") > 0, F.lit(400))).alias("guard_status"),
        F.coalesce("guard_error", F.when(F.size("errors") > 0, F.lit("Validation failed."))).alias("guard_error"),
    )
    return DocumentOutcome(
        results=results,
        tables=M.merge_entities(targets, M.fold_changes(changes), catalog),
        status=S.message_status(heads, results, options),
        refused=refused,
    )
