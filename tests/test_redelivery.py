"""Messages that wait in state are tried again on an idle stream."""

from conftest import CATALOG, by, make_messages, make_targets, payload

from weftline import Options
from weftline.sources import sinks
from weftline.sources.messages import stream_messages
from weftline.streaming.redelivery import start_redelivering_stream, stop_when_settled
from weftline.streaming.upsert_stream import StreamTargets, dead_letters


def test_idle_stream_tries_again_until_it_gives_up(spark, tmp_path):
    root, queue = str(tmp_path / "tables"), str(tmp_path / "queue")
    where = StreamTargets(root, ("account", "contact"))
    sinks.write_entities(make_targets(spark, [{"accountid": "t1", "accountnumber": "T1", "name": "old"}]), root, 0)
    late = payload("contact", {"emailaddress1": "a@x"}, {}, Lookups={"parentcustomerid": {"EntityLogicalName": "account", "KeyAttributes": {"accountnumber": "LATE"}}})
    bodies = [
        {"Payloads": [payload(keys={"accountnumber": "T1"}, attrs={"name": "new"})]},
        {"Payloads": [late]},
        "broken",
        {"Payloads": [payload(keys={"accountnumber": "LATE"}, attrs={"name": "x"})]},
    ]
    # Everything is there before the stream starts; nothing comes later.
    make_messages(spark, *bodies).coalesce(1).write.parquet(queue)
    stream = stream_messages(spark, "parquet", {"path": queue}, make_messages(spark).schema)
    query = start_redelivering_stream(stream, where, CATALOG, str(tmp_path / "checkpoint"), Options(max_deliveries=3), wait_seconds=0.5)
    stop_when_settled(query, 240)
    assert [(r["message_id"], r["attempt"], r["reason"]) for r in dead_letters(spark, where).collect()] == [(2, 3, "Message is not a valid JSON batch.")]
    accounts = by(sinks.read_version(spark, root + "/account").collect(), "accountnumber")
    contacts = sinks.read_version(spark, root + "/contact").collect()
    assert accounts["T1"]["name"] == "new"
    assert [c["parentcustomerid"]["id"] for c in contacts] == [accounts["LATE"]["accountid"]]
    tried = spark.read.option("basePath", root + "/_results").parquet(root + "/_results")
    assert {(r["message_id"], r["count"]) for r in tried.groupBy("message_id").count().collect()} == {(0, 1), (1, 2), (3, 1)}
