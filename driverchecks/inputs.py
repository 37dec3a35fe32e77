"""The driver tables, seen as what the jobs work on: change records, targets, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import Catalog
from weftline.session import configure, shuffle_partitions, spread_small_input


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table is one small file; before heavy work on its rows it is dealt out to all cores."""
    return spread_small_input(table(spark, sf, name))


def events(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return (spread_table if spread else table)(spark, sf, "events").withColumn("k", k)


# --- customers as an entity table ---------------------------------------------------------

CUSTOMER_CATALOG = Catalog.from_rows(
    [
        ("customer", "c_custkey", "guid"),
        ("customer", "c_name", "string"),
        ("customer", "c_nationkey", "int"),
        ("customer", "c_acctbal", "double"),
        ("customer", "c_mktsegment", "string"),
    ],
    ids={"customer": "c_custkey"},
)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").withColumn("c_custkey", F.col("c_custkey").cast("string"))


def customer_key(number: Column) -> Column:
    return F.format_string("Customer#%09d", number.cast("bigint"))


def customer_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as changes of customers; which columns an event supplies depends on its type."""
    of = F.col("event_type")
    return events(spark, sf, spread=True).select(
        F.col("event_id").alias("message_id"),
        customer_key(F.col("user_id") + 30 * F.col("k")).alias("c_name"),
        F.when(of == "click", F.col("k") % 25).cast("int").alias("c_nationkey"),
        F.when(of == "purchase", F.col("value")).alias("c_acctbal"),
        F.when(of == "signup", F.concat(F.lit("SEG"), (F.col("k") % 5).cast("string"))).alias("c_mktsegment"),
        F.when(of == "click", F.array(F.lit("c_nationkey")))
        .when(of.isin("purchase", "error"), F.array(F.lit("c_acctbal")))
        .when(of == "signup", F.array(F.lit("c_mktsegment")))
        .otherwise(F.array().cast("array<string>"))
        .alias("present"),
    )


def customer_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes as JSON messages, ten payloads each."""
    attribute = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('"c_nationkey":'), (F.col("k") % 25).cast("string")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('"C_AcctBal":'), F.col("value").cast("string")))
        .when(F.col("event_type") == "error", F.lit('"c_acctbal":null'))
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit('"c_mktsegment":"SEG'), (F.col("k") % 5).cast("string"), F.lit('"')),
        )
        .otherwise("")
    )
    payload = F.concat(
        F.lit('{"EntityLogicalName":"customer","KeyAttributes":{"c_name":"'),
        customer_key(F.col("user_id") + 30 * F.col("k")),
        F.lit('"},"Attributes":{'),
        attribute,
        F.lit("}}"),
    )
    return as_messages(events(spark, sf).select("event_id", payload.alias("payload")))


def as_messages(payloads: DataFrame, per_message: int = 10) -> DataFrame:
    """Payload texts in messages of ``per_message``, in event order.

    Parsing follows right behind the exchange and costs far more than the bytes say by which partitions
    would be put together, so their number is fixed.
    """
    message = F.floor(F.col("event_id") / per_message).alias("message_id")
    payloads = payloads.select("event_id", "payload", message).repartition(shuffle_partitions(payloads), "message_id")
    texts = F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", "payload"))), lambda p: p["payload"]
    )
    return (
        payloads.groupBy("message_id")
        .agg(F.concat(F.lit('{"Payloads":['), F.array_join(texts, ","), F.lit("]}")).alias("body"))
        .withColumn("correlation_id", F.lit(None).cast("string"))
    )


# --- events as payloads with faults -------------------------------------------------------

EVENT_CATALOG = Catalog.from_rows(
    [
        ("event", "eventid", "guid"),
        ("event", "number", "long"),
        ("event", "kind", "choice", "event_kind"),
        ("event", "amount", "money"),
        ("event", "k", "int"),
        ("event", "happened", "datetime"),
        ("event", "details", "string"),
        ("event", "large", "bool"),
        ("event", "tags", "choices"),
        ("event", "owner", "reference"),
    ],
    [
        ("event_kind", "Click", 1),
        ("event_kind", "Error", 2),
        ("event_kind", "Purchase", 4),
        ("event_kind", "Signup", 8),
        ("event_kind", "View", 16),
    ],
)


def event_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON payloads. Every 25th has a wrong type, every 50th a broken message instead."""
    n = F.col("event_id")
    k_text = (
        F.when(n % 25 == 24, F.lit('"not-a-number"'))
        .when(n % 25 == 12, F.lit("1.5"))
        .when(n % 25 == 13, F.lit("null"))
        .otherwise(F.col("k").cast("string"))
    )
    extra = (
        F.when(n % 25 == 5, F.lit(',"nosuchfield":1'))
        .when(n % 25 == 6, F.lit(',"adx_identity_x":1,"owner":"x"'))
        .when(n % 25 == 7, F.lit(',"number":1'))
        .when(n % 25 == 8, F.lit(',"tags":[1,"x"]'))
        .when(n % 25 == 9, F.lit(',"tags":[1,2]'))
        .otherwise("")
    )
    payload = F.when(n % 25 == 20, F.lit("null")).otherwise(
        F.concat(
            F.lit('{"entityLogicalName":"Event","KeyAttributes":{"Number":'),
            n.cast("string"),
            F.lit('},"Attributes":{"kind":"'),
            F.col("event_type"),
            F.lit('","amount":'),
            F.col("value").cast("string"),
            F.lit(',"k":'),
            k_text,
            F.lit(',"happened":"'),
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit('+02:00","details":'),
            F.col("props"),
            F.lit(',"large":'),
            (F.col("value") > 50).cast("string"),
            extra,
            F.lit("}}"),
        )
    )
    messages = as_messages(events(spark, sf).select("event_id", payload.alias("payload")))
    broken = F.col("message_id") % 50 == 49
    return messages.withColumn(
        "body",
        F.when(broken, F.lit('{"Payloads": [{"broken json'))
        .when(F.col("message_id") % 50 == 48, F.lit('{"payloads":[]}'))
        .otherwise(F.col("body")),
    )


# --- events as results, failures and a request log -----------------------------------------


def event_results(spark: SparkSession, sf: str) -> DataFrame:
    of, k = F.col("event_type"), F.col("k")
    category = (
        F.when((of == "signup") & (k % 10 == 0), "Validation")
        .when((of == "purchase") & (k % 10 == 0), "Throttling")
        .when((of == "error") & (k < 10), "Transient")
        .when((of == "error") & (k < 14), "Permanent")
        .when((of == "error") & (k == 14), "Cancellation")
        .otherwise("None")
    )
    return events(spark, sf).select(
        F.floor(F.col("event_id") / 10).alias("message_id"), "event_id", category.alias("ErrorCategory")
    )


FAILURE_TYPES = [
    "TimeoutException", "HttpRequestException", "FaultException", "ProtocolException", "InvalidOperationException",
    "AggregateException", "OperationCanceledException", "ArgumentException", "PayloadValidationException",
    "BrokenCircuitException", "Exception",
]
FAILURE_CODES = [
    -2147015902, -2147204783, -2147220173, -2147086191, -2147015895, -2147220970, 0, 1, 2, 3, 4, 5,
]
FAILURE_MESSAGES = [
    "Combined limit reached", "Rate Limit hit", "too many requests", "HTTP 429", "The response is empty",
    "Failed to connect to the store", "A record already exists", "It Does Not Exist", "plain failure",
    "another failure", "timed out", "no access",
]
RETRY_HINTS = ["42", "00:00:17", "00:10:00", "0", "soon", "1.00:00:00", "00:00:01.5"]


def failures(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a failure log: four exceptions per operation, the first one is the outermost."""
    pick = lambda items, at: F.get(F.array(*[F.lit(i) for i in items]), at.cast("int"))
    n, k = F.col("event_id"), F.col("k")
    return events(spark, sf).select(
        F.floor(n / 4).alias("op_id"),
        (n % 4).cast("int").alias("node_id"),
        F.when(n % 4 != 0, 0).cast("int").alias("parent_id"),
        pick(["create", "update", "query"], F.floor(n / 4) % 3).alias("op_kind"),
        pick(FAILURE_TYPES, (k + n) % 11).alias("exc_type"),
        F.when(k % 5 != 0, pick(FAILURE_CODES, k % 12)).cast("int").alias("fault_code"),
        pick(FAILURE_MESSAGES, F.least((k * 7 + F.col("user_id")) % 48, F.lit(11))).alias("message"),
        pick(RETRY_HINTS, (k + F.col("user_id")) % 7).alias("retry_after"),
    )


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as requests: user is the thread, value the time, type and k make the status."""
    of, k = F.col("event_type"), F.col("k")
    status = (
        F.when(of == "error", F.when(k < 50, 500))
        .when((of == "click") | ((of == "view") & (k < 95)) | ((of == "signup") & (F.col("user_id") % 3 == 0)), 429)
        .otherwise(200)
    )
    return (
        events(spark, sf)
        .select(
            F.col("user_id").alias("thread_id"),
            F.col("event_id").alias("request_index"),
            F.col("ts").cast("timestamp").alias("ts"),
            status.cast("int").alias("status_code"),
            F.col("value").alias("response_ms"),
            "event_type",
        )
        .withColumn("success", F.coalesce(F.col("status_code") == 200, F.lit(False)))
        .withColumn("error", F.when(~F.col("success"), F.concat(F.lit("failed: "), F.col("event_type"))))
    )


# --- customers as account documents ---------------------------------------------------------

ACCOUNT_CATALOG = Catalog.from_rows(
    [
        ("account", "accountid", "guid"),
        *[
            ("account", c, "string")
            for c in (
                "accountnumber", "name", "address1_city", "address1_line1", "address1_postalcode",
                "address1_country", "telephone1", "emailaddress1", "websiteurl",
            )
        ],
        ("account", "primarycontactid", "reference"),
        ("contact", "contactid", "guid"),
        *[("contact", c, "string") for c in ("emailaddress1", "firstname", "lastname", "telephone1", "jobtitle")],
        ("contact", "parentcustomerid", "reference"),
    ]
)


def account_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """A document per customer with up to four contacts, some of them faulty."""
    n = F.col("c_custkey")
    count = (n % 5).cast("int")

    def contact(i: Column) -> Column:
        mail = F.when(
            (n % 17 == 0) & (i == 1), F.concat(F.lit(" C"), n.cast("string"), F.lit(".0@EXAMPLE.com"))
        ).otherwise(F.concat(F.lit("c"), n.cast("string"), F.lit("."), i.cast("string"), F.lit("@example.com")))
        primary = (i == F.when(count > 0, n % count).otherwise(-1)) | ((n % 23 == 0) & (i == 1))
        text = F.concat(
            F.lit('{"Email":"'), mail,
            F.lit('","FirstName":"F'), i.cast("string"),
            F.lit('","LastName":"'), F.when((n % 29 == 0) & (i == 0), F.lit(" ")).otherwise(F.col("c_mktsegment")),
            F.lit('","JobTitle":'), F.when(i == 2, F.lit("null")).otherwise(F.lit('"T"')),
            F.lit(',"IsPrimary":'), primary.cast("string"),
            F.lit("}"),
        )
        return F.when((n % 31 == 0) & (i == 2), F.lit("null")).otherwise(text)

    contacts = F.transform(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")), contact)
    body = F.concat(
        F.lit('{"accountNumber":"'), F.col("c_name"), F.lit('"'),
        F.when(n % 19 == 0, F.lit("")).otherwise(F.concat(F.lit(',"Name":"N '), F.col("c_mktsegment"), F.lit('"'))),
        F.lit(',"City":'),
        F.when(n % 2 == 0, F.lit("null")).otherwise(F.concat(F.lit('"City '), F.col("c_nationkey").cast("string"), F.lit('"'))),
        F.lit(',"Contacts":['), F.array_join(contacts, ","), F.lit("]}"),
    )
    return spread_table(spark, sf, "customer").select(
        n.alias("message_id"), body.alias("body"), F.lit(None).cast("string").alias("correlation_id")
    )


def account_targets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Two of three customers are accounts already, some of them twice; suppliers are contacts."""
    reference = "struct<entity:string,id:string>"
    base = table(spark, sf, "customer")
    n = F.col("c_custkey")
    copies = F.when(n % 3 == 0, F.array().cast("array<int>")).when(n % 37 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    account = base.select("*", F.explode(copies).alias("copy")).select(
        F.concat(F.lit("a"), n.cast("string"), F.lit("-"), F.col("copy").cast("string")).alias("accountid"),
        F.upper("c_name").alias("accountnumber"),
        F.lit("old").alias("name"),
        F.lit("Old City").alias("address1_city"),
        F.lit("Old Street").alias("address1_line1"),
        F.lit(None).cast(reference).alias("primarycontactid"),
    )
    contact = base.where(n % 4 == 3).select(
        F.concat(F.lit("k"), n.cast("string")).alias("contactid"),
        F.concat(F.lit("c"), n.cast("string"), F.lit(".0@example.com")).alias("emailaddress1"),
        F.lit("Old").alias("firstname"),
        F.lit("Old").alias("lastname"),
        F.lit("Old").alias("jobtitle"),
        F.lit(None).cast(reference).alias("parentcustomerid"),
    )
    return {"account": account, "contact": contact}
