"""SQL twins of ``further``. They state their own constants and formulas."""

from __future__ import annotations

import itertools


def _uuid(text: str) -> str:
    h = f"sha256({text})"
    return f"substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)||'-'||substr({h},21,12)"


_E = "e AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"
_NONE = "'00000000-0000-0000-0000-000000000000'"
_LOOKUP = "Lookup resolution for ''o_custkey'': "


def _changed(order: str) -> str:
    """Changes of customers, last supplied value per column in ``order``."""
    last = f"QUALIFY row_number() OVER (PARTITION BY key ORDER BY {order} DESC) = 1"
    return f"""{_E},
c AS (SELECT event_id, printf('Customer#%09d', user_id + 30 * k) AS key, event_type AS t, value, k, event_id % 1000 >= 500 AS late FROM e),
keys AS (SELECT DISTINCT key FROM c),
bal AS (SELECT key, CASE WHEN t = 'purchase' THEN value END AS v FROM c WHERE t IN ('purchase', 'error') {last}),
nat AS (SELECT key, CAST(k % 25 AS INTEGER) AS v FROM c WHERE t = 'click' {last}),
seg AS (SELECT key, 'SEG' || CAST(k % 5 AS VARCHAR) AS v FROM c WHERE t = 'signup' {last})"""


def _many_key_sets() -> str:
    columns = [f"k{i}" for i in range(1, 10)]
    sets = [c for size in (3, 4, 5, 6) for c in itertools.combinations(range(1, 10), size)][:300]
    value = lambda n: "[" + ", ".join(f"({n} * {2 * i + 3}) % {11 + 6 * i}" for i in range(len(columns))) + "]"
    text = "array_to_string(list_transform(s, lambda i: 'k' || i || '=' || v[i]), ',')"
    return f"""WITH sets AS (SELECT generate_subscripts({[list(c) for c in sets]}, 1) - 1 AS no, unnest({[list(c) for c in sets]}) AS s),
p AS (SELECT p_partkey, {value("p_partkey")} AS v FROM part),
t AS (SELECT p_partkey, {text} AS identity FROM p, sets),
q AS (SELECT event_id % 300 AS no, {value("(event_id % 2500 + 1)")} AS v FROM events),
w AS (SELECT DISTINCT {text} AS identity FROM q JOIN sets USING (no))
SELECT identity, count(*) AS match_count, min(p_partkey::VARCHAR) AS match_id FROM t JOIN w USING (identity) GROUP BY ALL"""


_MESSAGES = """['Combined limit reached', 'Rate Limit hit', 'too many requests', 'HTTP 429', 'The response is empty',
  'Failed to connect to the store', 'A record already exists', 'It Does Not Exist', 'plain failure', 'another failure', 'timed out', 'no access']"""

SQL: dict[str, str] = {
    "versioned_tables": "SELECT c_custkey::VARCHAR AS c_custkey, c_acctbal + 1 AS c_acctbal, c_acctbal AS before FROM customer",
    "report_rows": f"""WITH {_E}, l AS (SELECT user_id AS thread_id, event_id AS request_index, event_type, CAST(CASE WHEN event_type = 'error' THEN CASE WHEN k < 50 THEN 500 END
    WHEN event_type = 'click' OR (event_type = 'view' AND k < 95) OR (event_type = 'signup' AND user_id % 3 = 0) THEN 429 ELSE 200 END AS INTEGER) AS status_code FROM e)
SELECT thread_id, request_index, status_code, coalesce(status_code = 200, false) AS success,
  CASE WHEN NOT coalesce(status_code = 200, false) THEN 'failed: ' || event_type END AS error FROM l""",
    "dead_letter_rows": f"""WITH {_E}, r AS (SELECT CAST(event_id // 10 AS BIGINT) AS message_id, CASE
    WHEN event_type = 'signup' AND k % 10 = 0 THEN 'Validation' WHEN event_type = 'purchase' AND k % 10 = 0 THEN 'Throttling'
    WHEN event_type = 'error' AND k < 15 THEN 'Failed' ELSE 'None' END AS category FROM e),
s AS (SELECT message_id, count(*) FILTER (category <> 'None') AS failed, count(*) FILTER (category = 'Validation') AS bad FROM r GROUP BY ALL)
SELECT message_id, CASE WHEN message_id % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS batch,
  'Upsert failed for ' || failed || ' item(s) (' || bad || ' validation, ' || failed - bad || ' technical).' AS reason FROM s WHERE failed > 0 AND message_id % 3 = 2""",
    "typed_row_errors": """SELECT event_id, CASE WHEN event_id % 3 <> 0 AND event_id % 7 <> 0 AND event_id % 5 <> 0 THEN NULL ELSE array_to_string(list_filter([
  CASE WHEN event_id % 3 = 0 THEN 'Field ''k'' has invalid type. Expected ''int''.' END,
  CASE WHEN event_id % 7 = 0 THEN 'Field ''kind'' has invalid type. Expected ''OptionSetValue (event_kind)''.' END,
  CASE WHEN event_id % 5 = 0 THEN 'Field ''happened'' has invalid type. Expected ''datetime''.' END], lambda x: x IS NOT NULL), '; ') END AS error,
  'number=' || event_id AS identity FROM events""",
    "guard_contacts": """SELECT c_custkey AS message_id, CASE WHEN c_custkey % 19 = 0 OR c_custkey % 5 > 2 THEN 400 END AS status,
  CASE WHEN c_custkey % 19 = 0 THEN 'Invalid request: The body is not a valid account document.'
    WHEN c_custkey % 5 > 2 THEN 'Invalid request: Contacts count (' || c_custkey % 5 || ') exceeds the maximum of 2.' END AS error FROM customer""",
    "classify_nested_groups": f"""WITH RECURSIVE {_E},
f AS (SELECT event_id // 16 AS op, event_id % 16 AS node, CASE WHEN event_id % 16 > 0 THEN
    CASE WHEN event_id // 16 % 2 = 0 THEN (event_id % 16 - 1) // 2 ELSE event_id % 16 - 1 END END AS parent,
  (k * 3 + user_id) % 4 < 3 AS agg, ['Transient', 'Validation', 'Permanent', 'Cancellation'][k % 4 + 1] AS category,
  event_id // 16 % 3 = 0 AND regexp_matches(lower(({_MESSAGES})[least((k * 7 + user_id) % 48, 11) + 1]), 'rate limit|too many requests|429|throttl') AS throttled FROM e),
held AS (SELECT op, node FROM f WHERE parent IS NULL AND agg
  UNION ALL SELECT f.op, f.node FROM f JOIN held ON f.op = held.op AND f.parent = held.node WHERE f.agg),
members AS (SELECT f.op, min(list_position(['Cancellation', 'Throttling', 'Transient', 'Validation', 'Permanent'], category)) AS best
  FROM f JOIN held ON f.op = held.op AND f.parent = held.node WHERE NOT f.agg GROUP BY f.op),
whole AS (SELECT op, bool_or(throttled) AS throttled FROM f GROUP BY op)
SELECT CAST(f.op AS BIGINT) AS op_id, CASE WHEN NOT agg THEN category WHEN whole.throttled THEN 'Throttling'
  ELSE coalesce(['Cancellation', 'Throttling', 'Transient', 'Validation', 'Permanent'][best], 'Permanent') END AS category
FROM f JOIN whole USING (op) LEFT JOIN members ON members.op = f.op WHERE parent IS NULL""",
    "throttle_windows_repeated": f"""WITH {_E}, l AS (SELECT user_id % 5 AS thread_id, CASE WHEN event_type = 'error' THEN CASE WHEN k < 50 THEN 500 END
    WHEN event_type = 'click' OR (event_type = 'view' AND k < 95) OR (event_type = 'signup' AND user_id % 3 = 0) THEN 429 ELSE 200 END AS status_code,
  row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id // 50, ts) - 1 AS n FROM e),
w AS (SELECT thread_id, n // 30 AS window_no, count(*) AS requests, count(*) FILTER (status_code = 429) AS throttled FROM l GROUP BY ALL HAVING count(*) = 30)
SELECT CAST(thread_id AS BIGINT) AS thread_id, CAST(window_no AS BIGINT) AS window_no, requests, throttled,
  round_even(100.0 * throttled / requests, 2) AS throttled_percent, round_even(100.0 * throttled / requests, 2) >= 60 AS flagged FROM w""",
    "resolve_many_key_sets": _many_key_sets(),
    "write_refusals": f"""WITH {_E}, r AS (SELECT event_id, CASE
  WHEN event_type = 'error' THEN 'Field ''c_fax'' has no column to write to.'
  WHEN event_type = 'click' AND k * 3 > 127 THEN 'Field ''c_nationkey'' does not fit its column.' END AS error FROM e)
SELECT event_id, CASE WHEN error IS NULL THEN 'None' ELSE 'Permanent' END AS category, error FROM r""",
    "lookup_create_refusals": f"""WITH {_E}, r AS (SELECT event_id, CASE event_type
  WHEN 'error' THEN '{_LOOKUP}Field ''c_fax'' has no column to write to.'
  WHEN 'purchase' THEN '{_LOOKUP}Field ''c_mktsegment'' cannot hold a reference.'
  WHEN 'signup' THEN '{_LOOKUP}Entity ''ghost'' has no table to write to.'
  WHEN 'click' THEN CASE WHEN k * 3 > 127 THEN '{_LOOKUP}Field ''c_level'' does not fit its column.' END END AS error FROM e)
SELECT event_id, CASE WHEN error IS NULL THEN 'None' ELSE 'Permanent' END AS category, error,
  CASE WHEN error IS NULL THEN 'New#' || event_id END AS points_to FROM r""",
    "lookup_free_ids": f"""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN {_uuid("'customer:c_name=free#' || user_id || ':#1'")}
  ELSE {_uuid("'customer:c_name=free#' || user_id")} END AS resolved_id,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS was_created FROM events""",
    "given_ids_any_case": f"""SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN {_NONE} ELSE 'Cust-' || c_custkey END AS id, false AS created,
  CASE WHEN c_custkey IS NULL THEN 'Permanent' ELSE 'None' END AS category,
  CASE WHEN c_custkey IS NULL THEN 'Entity ''customer'' with id ''cust-' || o_custkey * 2 || ''' does not exist.' END AS error
FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2""",
    "id_after_key_change": f"""WITH o AS (SELECT o_orderkey AS n, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey * 2 END AS number,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey * 7 % 2000 + 1 END AS given FROM orders),
g AS (SELECT o.*, t.c_custkey AS there FROM o LEFT JOIN customer t ON t.c_custkey = given),
a AS (SELECT *, last_value(there IGNORE NULLS) OVER (PARTITION BY number ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS as_of FROM g),
f AS (SELECT a.*, m.c_custkey AS found, CASE WHEN given IS NULL THEN coalesce(as_of, m.c_custkey) END AS hit FROM a LEFT JOIN customer m ON m.c_custkey = number),
w AS (SELECT *, given IS NULL AND hit IS NULL AS makes FROM f)
SELECT n AS o_orderkey, CASE WHEN given IS NOT NULL THEN CASE WHEN there IS NULL THEN {_NONE} ELSE there::VARCHAR END
    WHEN hit IS NOT NULL THEN hit::VARCHAR ELSE {_uuid("'customer:c_name=' || lower(printf('Customer#%09d', number))")} END AS id,
  makes AND row_number() OVER (PARTITION BY number, makes ORDER BY n) = 1 AS created,
  CASE WHEN given IS NOT NULL AND there IS NULL THEN 'Permanent' ELSE 'None' END AS category,
  CASE WHEN given IS NOT NULL AND there IS NULL THEN 'Entity ''customer'' with id ''' || given || ''' does not exist.' END AS error FROM w""",
    "conflict_pass": f"""WITH {_E}, x AS (SELECT event_id, printf('Customer#%09d', user_id + 30 * k) AS key, k % 40 AS nation FROM e),
p AS (SELECT * FROM customer WHERE c_custkey % 41 <> 0),
r AS (SELECT x.*, c_custkey FROM x LEFT JOIN p ON c_name = key)
SELECT event_id, coalesce(c_custkey::VARCHAR, {_uuid("'customer:c_name=' || lower(key)")}) AS id,
  c_custkey IS NULL AND row_number() OVER (PARTITION BY key ORDER BY event_id) = 1 AS created, 'None' AS category,
  CASE WHEN nation < 25 THEN nation::VARCHAR ELSE {_uuid("'nation:n_name=nation_' || nation")} END AS nation_id,
  nation >= 25 AND row_number() OVER (PARTITION BY nation ORDER BY event_id) = 1 AS nation_created,
  (SELECT count(*) FROM p) + (SELECT count(DISTINCT key) FROM r WHERE c_custkey IS NULL) AS customers_after FROM r""",
    "stream_redelivery": """WITH m AS (SELECT CAST(event_id // 10 AS BIGINT) AS message_id, count(*) AS n, count(*) FILTER (event_id % 100 = 35) AS bad FROM events GROUP BY ALL),
f AS (SELECT m.*, CASE WHEN message_id % 50 = 49 THEN 'broken' WHEN message_id % 10 = 7 AND message_id + 1 IN (SELECT message_id FROM m) THEN 'late'
  WHEN message_id % 10 = 7 THEN 'lost' WHEN bad > 0 THEN 'bad' ELSE 'good' END AS kind FROM m)
SELECT message_id, CASE WHEN kind IN ('broken', 'lost', 'bad') THEN 'dead' ELSE 'done' END AS fate,
  CAST(CASE kind WHEN 'good' THEN 1 WHEN 'late' THEN 2 ELSE 3 END AS BIGINT) AS deliveries,
  CASE kind WHEN 'broken' THEN 'Message is not a valid JSON batch.'
    WHEN 'lost' THEN 'Upsert failed for ' || n || ' item(s) (0 validation, ' || n || ' technical).'
    WHEN 'bad' THEN 'Upsert failed for ' || bad || ' item(s) (' || bad || ' validation, 0 technical).' END AS reason FROM f""",
    "bucketed_merge": f"""WITH {_changed("late DESC, event_id")}
SELECT coalesce(CAST(c_custkey AS VARCHAR), {_uuid("'customer:c_name=' || lower(keys.key)")}) AS c_custkey, coalesce(c_name, keys.key) AS c_name,
  CAST(CASE WHEN nat.key IS NOT NULL THEN nat.v ELSE c_nationkey END AS INTEGER) AS c_nationkey,
  CASE WHEN bal.key IS NOT NULL THEN bal.v ELSE c_acctbal END AS c_acctbal,
  CASE WHEN seg.key IS NOT NULL THEN seg.v ELSE c_mktsegment END AS c_mktsegment
FROM customer FULL JOIN keys ON c_name = keys.key
LEFT JOIN bal ON bal.key = keys.key LEFT JOIN nat ON nat.key = keys.key LEFT JOIN seg ON seg.key = keys.key""",
}
