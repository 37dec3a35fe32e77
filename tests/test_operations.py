"""Status precedence, failure triage, request-log reports, streaming."""

import math
import random

import pytest
from conftest import CATALOG, by, make_messages, make_targets, payload
from pyspark.sql import functions as F

from weftline import Options
from weftline.operators import reports as P
from weftline.operators import results as S
from weftline.operators import triage as T
from weftline.sources import sinks
from weftline.sources.messages import stream_messages
from weftline.streaming.upsert_stream import StreamTargets, dead_letters, start_upsert_stream


def test_status_precedence(spark):
    cases = {
        1: (["None"], 200, None),
        2: (["Throttling", "Permanent"], 500, None),
        3: (["Throttling", "Validation"], 429, 300),
        4: (["Throttling"], 429, 300),
        5: (["Validation", "None"], 400, None),
        6: (["Cancellation"], 500, None),
        7: (["Transient", "Validation"], 500, None),
    }
    rows = [(m, c) for m, (categories, _, _) in cases.items() for c in categories]
    got = by(S.batch_status(spark.createDataFrame(rows, "message_id int, ErrorCategory string")).collect(), "message_id")
    assert {m: (got[m]["status"], got[m]["retry_after"]) for m in cases} == {m: (s, r) for m, (_, s, r) in cases.items()}


FAILURE_DDL = (
    "op_id int, node_id int, parent_id int, op_kind string, exc_type string, fault_code int, message string, retry_after string"
)


def one(type_, message="", code=None, kind="update", hint=None, inner=()):
    rows = [(0, None, kind, type_, code, message, hint)]
    return rows + [(i + 1, 0, kind, t, c, m, h) for i, (t, m, c, h) in enumerate(inner)]


OPERATIONS = {
    # name: rows, category, conflict, retryable, delay
    "validation": (one("PayloadValidationException", "bad"), "Validation", False, False, None),
    "argument": (one("ArgumentNullException"), "Validation", False, False, None),
    "cancelled": (one("TaskCanceledException"), "Cancellation", False, False, None),
    "timeout": (one("TimeoutException"), "Transient", False, True, None),
    "timeout of a create": (one("TimeoutException", kind="create"), "Transient", False, False, None),
    "http": (one("HttpRequestException"), "Transient", False, True, None),
    "broken circuit": (one("BrokenCircuitException"), "Transient", False, False, None),
    "throttle fault": (one("FaultException", "neutral", -2147015902, kind="create", hint="42"), "Throttling", False, True, 42.0),
    "capped hint": (one("FaultException", "x", -2147015903, hint="00:10:00"), "Throttling", False, True, 300.0),
    "no hint": (one("FaultException", "x", -2147015898, hint="soon"), "Throttling", False, True, 300.0),
    "sql fault": (one("FaultException", "x", -2147204783), "Transient", False, False, None),
    "throttle text in fault": (one("FaultException", "Too Many Requests", 5), "Throttling", False, True, 300.0),
    "duplicate fault": (one("FaultException", "x", -2147220173), "Permanent", True, False, None),
    "exists text": (one("Exception", "Record ALREADY EXISTS"), "Permanent", True, False, None),
    "code without fault": (one("Exception", "x", -2147220173), "Permanent", False, False, None),
    "protocol": (one("ProtocolException", "HTTP 429"), "Throttling", False, True, 300.0),
    "protocol other": (one("ProtocolException", "x"), "Permanent", False, False, None),
    "empty response": (one("InvalidOperationException", "The response is empty"), "Transient", False, True, None),
    "empty of a create": (one("InvalidOperationException", "ThrowIfResponseIsEmpty", kind="create"), "Transient", False, False, None),
    "rate limit": (one("InvalidOperationException", "Rate limit exceeded"), "Throttling", False, True, 300.0),
    "aggregate": (one("AggregateException", inner=[("TimeoutException", "", None, None), ("TaskCanceledException", "", None, None)]), "Cancellation", False, True, None),
    "aggregate throttle": (one("AggregateException", inner=[("TaskCanceledException", "", None, None), ("FaultException", "", -2147015895, "00:00:05")]), "Throttling", False, True, 5.0),
    "aggregate empty": (one("AggregateException"), "Permanent", False, False, None),
    "inner conflict": (one("Exception", "outer", inner=[("FaultException", "", -2147220969, None)]), "Permanent", True, False, None),
}


def test_failure_triage(spark):
    names = list(OPERATIONS)
    rows = [(i, *row) for i, name in enumerate(names) for row in OPERATIONS[name][0]]
    frame = spark.createDataFrame(rows, FAILURE_DDL)
    category = by(T.classify_groups(frame).collect(), "op_id")
    conflict = by(T.key_conflicts(frame).collect(), "op_id")
    retry = by(T.retryable(frame).collect(), "op_id")
    delay = by(T.retry_delay(frame).collect(), "op_id")
    for i, name in enumerate(names):
        got = (category[i]["category"], conflict[i]["is_key_conflict"], retry[i]["retryable"], delay[i]["delay_seconds"])
        assert got == OPERATIONS[name][1:], name


def log_of(spark, rows):
    return spark.createDataFrame(
        rows, "thread_id int, request_index bigint, ts timestamp, status_code int, response_ms double, success boolean, error string"
    )


def test_empty_log(spark):
    log = log_of(spark, [])
    assert P.load_summary(log, 3, 0.0).first()["success_rate"] == 0
    assert tuple(P.latency_stats(log).first()) == (0, 0, 0)
    assert tuple(P.latency_percentiles(log).first()) == (0, 0, 0)


@pytest.mark.parametrize("shape", ["few", "spread", "one", "heavy"])
def test_percentiles_against_sorting(spark, shape, monkeypatch):
    rng = random.Random(7)
    values = {
        "few": [float(i) for i in range(1, 11)],
        "spread": [math.exp(rng.uniform(-30, 30)) for _ in range(5000)],
        "one": [5.0] * 1000,
        "heavy": [rng.choice([1.0, 1.0 + 1e-9, 2.0, 1e12]) for _ in range(3000)],
    }[shape]
    # Small limits, so that the narrowing really takes several steps.
    monkeypatch.setattr(P, "_BINS", 8)
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    expected = {p: ordered[max(math.ceil(p / 100 * len(ordered)) - 1, 0)] for p in (1, 50, 95, 99, 100)}
    assert P.nearest_rank(frame, "v", list(expected)) == expected


def test_throttling_windows_against_a_loop(spark):
    rng = random.Random(3)
    rows, expected, kept = [], {}, {}
    size, percent, consecutive = 5, 60, 3
    for thread in range(6):
        statuses = [429 if rng.random() < (0.2 + 0.13 * thread) else rng.choice([200, None]) for _ in range(83)]
        rows += [(thread, i * 3, None, s, 1.0, s == 200, None) for i, s in enumerate(statuses)]
        streak, kept[thread] = 0, len(statuses)
        for w in range(len(statuses) // size):
            share = 100 * sum(s == 429 for s in statuses[w * size : (w + 1) * size]) / size
            streak = streak + 1 if share >= percent else 0
            if streak == consecutive:
                expected[thread], kept[thread] = w, (w + 1) * size
                break
    numbered = P.request_numbers(log_of(spark, rows))
    windows = P.throttle_windows(numbered, size, percent)
    cuts = P.sustained_throttling(windows, consecutive)
    assert {r["thread_id"]: r["cut_window"] for r in cuts.collect()} == expected and expected
    left = P.until_sustained(numbered, cuts, size).groupBy("thread_id").count().collect()
    assert {r["thread_id"]: r["count"] for r in left} == kept


def test_failure_windows_against_a_loop(spark):
    rng = random.Random(5)
    calls = [(rng.choice("ab"), rng.randrange(0, 400), rng.random() < 0.5) for _ in range(700)]
    frame = spark.createDataFrame(calls, "service string, s bigint, counted_failure boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = by(P.failure_ratio_windows(frame, Options(failure_window_seconds=10)).collect(), "service", "second")
    for (service, second), row in got.items():
        inside = [f for s, t, f in calls if s == service and second - 10 <= t <= second]
        assert (row["calls"], row["failures"]) == (len(inside), sum(inside))
        assert row["flagged"] == (len(inside) >= 10 and sum(inside) >= 0.5 * len(inside))
    assert len(got) == len({(s, t) for s, t, _ in calls})
    rates = P.rate_breaches(frame, 5).collect()
    assert all(r["calls"] > 5 for r in rates) and rates


def test_report_file(spark, tmp_path):
    log = log_of(spark, [(0, 1, None, None, 2.5, False, "boom")])
    sinks.write_report(log, str(tmp_path / "r"))
    assert '"status_code":null' in spark.read.text(str(tmp_path / "r")).first()["value"]
    assert [tuple(r) for r in P.sample_errors(log).collect()] == [(0, 1, "boom")]
    assert [tuple(r) for r in P.status_breakdown(log).collect()] == [("(no status)", 1)]


def test_stream_with_redelivery_and_dead_letters(spark, tmp_path):
    root, queue, checkpoint = (str(tmp_path / n) for n in ("tables", "queue", "checkpoint"))
    where = StreamTargets(root, ("account", "contact"))
    targets = make_targets(spark, [{"accountid": "t1", "accountnumber": "T1", "name": "old"}])
    sinks.write_entities(targets, root, 0)
    schema = make_messages(spark).schema
    late = payload("contact", {"emailaddress1": "a@x"}, {}, Lookups={"parentcustomerid": {"EntityLogicalName": "account", "KeyAttributes": {"accountnumber": "LATE"}}})

    def deliver(*bodies, first_id):
        frame = make_messages(spark, *bodies).withColumn("message_id", F.col("message_id") + first_id)
        frame.coalesce(1).write.mode("append").parquet(queue)
        stream = stream_messages(spark, "parquet", {"path": queue}, schema)
        start_upsert_stream(stream, where, CATALOG, checkpoint, Options(max_deliveries=3)).awaitTermination()

    deliver({"Payloads": [payload(keys={"accountnumber": "T1"}, attrs={"name": "new"})]}, {"Payloads": [late]}, "broken", first_id=0)
    waiting = by(sinks.read_version(spark, root + "/_retry").collect(), "message_id")
    assert set(waiting) == {1, 2} and waiting[1]["attempt"] == 1
    assert waiting[2]["reason"] == "Message is not a valid JSON batch."
    # The account comes with the second batch and is there for the third.
    deliver({"Payloads": [payload(keys={"accountnumber": "LATE"}, attrs={"name": "x"})]}, first_id=10)
    assert {(r["message_id"], r["attempt"]) for r in sinks.read_version(spark, root + "/_retry").collect()} == {(1, 2), (2, 2)}
    deliver({"Payloads": [payload(keys={"accountnumber": "T1"}, attrs={"address1_city": "Oslo"})]}, first_id=20)
    assert {(r["message_id"], r["attempt"]) for r in dead_letters(spark, where).collect()} == {(2, 3)}
    assert sinks.read_version(spark, root + "/_retry").count() == 0
    accounts = by(sinks.read_version(spark, root + "/account").collect(), "accountnumber")
    contacts = sinks.read_version(spark, root + "/contact").collect()
    assert (accounts["T1"]["name"], accounts["T1"]["address1_city"]) == ("new", "Oslo")
    assert [c["parentcustomerid"]["id"] for c in contacts] == [accounts["LATE"]["accountid"]]
    assert sinks.finished_versions(spark, root + "/account") == [0, 1, 2, 3]
    # Replaying a finished batch changes nothing.
    from weftline.streaming.upsert_stream import process_batch

    process_batch(make_messages(spark, {"Payloads": [payload(keys={"accountnumber": "T1"}, attrs={"name": "again"})]}), 3, where, CATALOG)
    assert by(sinks.read_version(spark, root + "/account").collect(), "accountnumber")["T1"]["name"] == "new"


def test_percentiles_take_few_scans(spark, monkeypatch):
    rng = random.Random(9)
    values = [round(rng.lognormvariate(3, 2), 2) for _ in range(20_000)] + [1e300]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    scans = []
    plain = type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: scans.append(1) or plain(self))
    ordered = sorted(values)
    want = {p: ordered[max(math.ceil(p / 100 * len(ordered)) - 1, 0)] for p in (50, 95, 99)}
    assert P.nearest_rank(frame, "v", (50, 95, 99)) == want
    # Besides the scan for the ends of the range.
    assert len(scans) <= 3


def test_numbers_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(4)
    rows = [(1, rng.randrange(5), rng.choice([200, 429]), float(i % 7)) for i in range(400)]
    ddl = "thread_id int, request_index int, status_code int, response_ms double"
    seen = set()
    for _ in range(3):
        rng.shuffle(rows)
        numbered = P.request_numbers(spark.createDataFrame(rows, ddl).repartition(rng.randint(1, 6)))
        seen.add(tuple(tuple(r) for r in numbered.select("n", "request_index", "status_code", "response_ms").orderBy("n").collect()))
        assert sorted(r["n"] for r in numbered.collect()) == list(range(400))
    assert len(seen) == 1


def test_causes_of_any_depth(spark):
    rng = random.Random(6)
    aggregate, types = "AggregateException", ["TimeoutException", "ArgumentException", "Exception", "TaskCanceledException"]
    rows, want = [], {}
    for op in range(120):
        size = rng.choice([1, 4, 30])
        kinds = [aggregate if rng.random() < 0.7 else rng.choice(types) for _ in range(size)]
        parents = [None] + [i - 1 if op % 2 else rng.randrange(i) for i in range(1, size)]
        rows += [(op, i, parents[i], "update", kinds[i], None, "", None) for i in range(size)]
        held = [kinds[0] == aggregate]
        for i in range(1, size):
            held.append(held[parents[i]] and kinds[i] == aggregate)
        category = {t: c for t, c in zip(types, ("Transient", "Validation", "Permanent", "Cancellation"))}
        members = {category[kinds[i]] for i in range(1, size) if kinds[i] != aggregate and held[parents[i]]}
        want[op] = category[kinds[0]] if kinds[0] != aggregate else next((c for c in T.GROUP_ORDER if c in members), "Permanent")
    # A cycle and a parent that is not in the log hold nothing.
    rows += [(500, 0, None, "update", aggregate, None, "", None), (500, 1, 2, "update", aggregate, None, "", None), (500, 2, 1, "update", aggregate, None, "", None),
             (500, 3, 2, "update", "TimeoutException", None, "", None), (500, 4, 99, "update", "TimeoutException", None, "", None)]
    want[500] = "Permanent"
    found = T.classify_groups(spark.createDataFrame(rows, FAILURE_DDL)).collect()
    assert {r["op_id"]: r["category"] for r in found} == want


def test_percentiles_with_nan_and_infinities(spark):
    nan, inf = float("nan"), float("inf")
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "response_ms double")
    odd = frame([*map(float, range(1, 101)), nan, None])
    assert P.nearest_rank(odd, "response_ms", (50, 95, 99)) == {50: 50.0, 95: 95.0, 99: 99.0}
    wide = frame([-inf, -1.7e308, 0.0, 1.0, 1.7e308, inf, inf, nan])
    assert P.nearest_rank(wide, "response_ms", (10, 20, 43, 50, 70, 99)) == {10: -inf, 20: -1.7e308, 43: 1.0, 50: 1.0, 70: 1.7e308, 99: inf}
    assert P.nearest_rank(frame([nan, None]), "response_ms", (50,)) == {50: 0.0}


def test_requests_without_index_or_thread_are_numbered_too(spark):
    rows = [(1, 5), (1, None), (1, 5), (1, 70_000), (None, 1), (None, None), (2, 3)]
    log = spark.createDataFrame(rows, "thread_id int, request_index int")
    got = sorted((str(r["thread_id"]), r["n"], r["request_index"]) for r in P.request_numbers(log).collect())
    assert got == [("1", 0, None), ("1", 1, 5), ("1", 2, 5), ("1", 3, 70_000), ("2", 0, 3), ("None", 0, None), ("None", 1, 1)]
