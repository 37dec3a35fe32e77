"""The same queries as DuckDB SQL over the driver tables."""

from __future__ import annotations

from driverchecks.inputs import FAILURE_CODES, FAILURE_MESSAGES, FAILURE_TYPES, RETRY_HINTS
# Fixed values, stated apart from the code they test: types and codes of failures.
_CANCELLATION_TYPES = ("OperationCanceledException", "TaskCanceledException")
_FAULT_TYPE = "FaultException"
_KEY_CONFLICT_CODES = (-2147220173, -2147086190, -2147220969, -2147086191)
_THROTTLING_CODES = (-2147015902, -2147015903, -2147015898, -2147015895)
_TRANSIENT_CODES = (-2147204783, -2147204784, -2147220970)
_TRANSIENT_TYPES = ("TimeoutException", "TimeoutRejectedException", "BrokenCircuitException", "HttpRequestException")
_VALIDATION_TYPES = (
    "PayloadValidationException", "ArgumentException", "ArgumentNullException", "ArgumentOutOfRangeException",
)


def _uuid(text: str) -> str:
    h = f"sha256({text})"
    return (
        f"substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)||'-'||substr({h},21,12)"
    )


def _escape(text: str) -> str:
    return rf"regexp_replace({text}, '([\\,=:])', '\\\1', 'g')"


_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
_E = f"e AS (SELECT *, {_K} AS k FROM events)"
_NAME = "printf('Customer#%09d', user_id + 30 * k)"

# Changes of customers as events make them: last supplied value per column.
_CUSTOMER_CHANGES = f"""{_E},
c AS (SELECT event_id, {_NAME} AS key, event_type AS t, value, k FROM e),
keys AS (SELECT DISTINCT key FROM c),
bal AS (SELECT key, CASE WHEN t = 'purchase' THEN value END AS v FROM c WHERE t IN ('purchase', 'error')
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1),
nat AS (SELECT key, CAST(k % 25 AS INTEGER) AS v FROM c WHERE t = 'click'
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1),
seg AS (SELECT key, 'SEG' || CAST(k % 5 AS VARCHAR) AS v FROM c WHERE t = 'signup'
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1)"""

_UPSERTED = f"""WITH {_CUSTOMER_CHANGES}
SELECT coalesce(CAST(c_custkey AS VARCHAR), {_uuid("'customer:c_name=' || lower(keys.key)")}) AS c_custkey,
       coalesce(c_name, keys.key) AS c_name,
       CAST(CASE WHEN nat.key IS NOT NULL THEN nat.v ELSE c_nationkey END AS INTEGER) AS c_nationkey,
       CASE WHEN bal.key IS NOT NULL THEN bal.v ELSE c_acctbal END AS c_acctbal,
       CASE WHEN seg.key IS NOT NULL THEN seg.v ELSE c_mktsegment END AS c_mktsegment
FROM customer FULL JOIN keys ON c_name = keys.key
LEFT JOIN bal ON bal.key = keys.key LEFT JOIN nat ON nat.key = keys.key LEFT JOIN seg ON seg.key = keys.key"""

_CUSTOMER_RESULTS = f"""r AS (
SELECT event_id AS message_id,
       coalesce(CAST(c_custkey AS VARCHAR), {_uuid("'customer:c_name=' || lower(c.key)")}) AS id,
       c_custkey IS NULL AND row_number() OVER (PARTITION BY c.key ORDER BY event_id) = 1 AS created,
       'customer:c_name=' || c.key AS upsert_key, 'None' AS category
FROM c LEFT JOIN customer ON c_name = c.key)"""

# --- events with faults ---------------------------------------------------------------------

_EVENT_ERRORS = f"""CASE
 WHEN n = 20 THEN 'Payload must not be null.'
 WHEN n = 24 THEN 'Field ''k'' has invalid type. Expected ''int''.'
 WHEN n = 12 THEN 'Field ''k'' could not be converted to ''int''.'
 WHEN n = 5 THEN 'Field ''nosuchfield'' is not defined on entity ''Event''.'
 WHEN n = 6 THEN 'Field ''adx_identity_x'' is not defined on entity ''Event''.; Field ''owner'' has invalid type. Expected ''EntityReference''.'
 WHEN n = 8 THEN 'Field ''tags'' contains an invalid multi-select option value.' END"""
_EVENT_MESSAGES = f"""{_E},
x AS (SELECT *, event_id % 25 AS n, CAST(event_id // 10 AS BIGINT) AS message_id,
             CAST(row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS BIGINT) AS idx
      FROM e),
p AS (SELECT *, {_EVENT_ERRORS} AS error FROM x WHERE message_id % 50 NOT IN (48, 49))"""

_MALFORMED = "Invalid request: The body is not a valid JSON batch."
_NO_ITEMS = "Invalid request: Payloads must contain at least one item."

_RESULT_CATEGORIES = f"""{_E},
r AS (SELECT CAST(event_id // 10 AS BIGINT) AS message_id, CASE
  WHEN event_type = 'signup' AND k % 10 = 0 THEN 'Validation'
  WHEN event_type = 'purchase' AND k % 10 = 0 THEN 'Throttling'
  WHEN event_type = 'error' AND k < 10 THEN 'Transient'
  WHEN event_type = 'error' AND k < 14 THEN 'Permanent'
  WHEN event_type = 'error' AND k = 14 THEN 'Cancellation'
  ELSE 'None' END AS category FROM e)"""
_STATUS = """CASE WHEN bool_or(category IN ('Transient', 'Permanent', 'Cancellation')) THEN 500
  WHEN bool_or(category = 'Throttling') THEN 429 WHEN bool_or(category = 'Validation') THEN 400 ELSE 200 END"""
_COUNTS = """count(*) AS total, count(*) FILTER (category <> 'None') AS failed,
  count(*) FILTER (category = 'Validation') AS validation_failed,
  count(*) FILTER (category NOT IN ('None', 'Validation')) AS technical_failed"""


# --- failures -------------------------------------------------------------------------------


def _list(items) -> str:
    return "[" + ", ".join(f"'{i}'" if isinstance(i, str) else str(i) for i in items) + "]"


def _in(items) -> str:
    return "(" + ", ".join(f"'{i}'" if isinstance(i, str) else str(i) for i in items) + ")"


_THROTTLE = "regexp_matches(lower(message), 'rate limit|too many requests|429|throttl')"
_IS_FAULT = f"exc_type = '{_FAULT_TYPE}'"
_THROTTLED = f"(({_IS_FAULT} AND coalesce(fault_code IN {_in(_THROTTLING_CODES)}, false)) OR {_THROTTLE})"
_EMPTY_RESPONSE = "regexp_matches(lower(message), 'response is empty|throwifresponseisempty')"
_FAILURES = f"""{_E},
f AS (SELECT CAST(event_id // 4 AS BIGINT) AS op_id, CAST(event_id % 4 AS BIGINT) AS node_id,
  CASE WHEN event_id % 4 <> 0 THEN 0 END AS parent_id,
  (['create', 'update', 'query'])[(event_id // 4) % 3 + 1] AS op_kind,
  ({_list(FAILURE_TYPES)})[(k + event_id) % 11 + 1] AS exc_type,
  CASE WHEN k % 5 <> 0 THEN ({_list(FAILURE_CODES)})[k % 12 + 1] END AS fault_code,
  ({_list(FAILURE_MESSAGES)})[least((k * 7 + user_id) % 48, 11) + 1] AS message,
  ({_list(RETRY_HINTS)})[(k + user_id) % 7 + 1] AS retry_after FROM e),
g AS (SELECT *, CASE
  WHEN exc_type IN {_in(_VALIDATION_TYPES)} THEN 'Validation'
  WHEN exc_type IN {_in(_CANCELLATION_TYPES)} THEN 'Cancellation'
  WHEN exc_type IN {_in(_TRANSIENT_TYPES)} THEN 'Transient'
  WHEN {_IS_FAULT} THEN CASE WHEN fault_code IN {_in(_THROTTLING_CODES)} THEN 'Throttling'
     WHEN fault_code IN {_in(_TRANSIENT_CODES)} THEN 'Transient'
     WHEN fault_code IS NOT NULL AND {_THROTTLE} THEN 'Throttling' ELSE 'Permanent' END
  WHEN exc_type = 'ProtocolException' AND {_THROTTLE} THEN 'Throttling'
  WHEN exc_type = 'InvalidOperationException' AND {_EMPTY_RESPONSE} THEN 'Transient'
  WHEN exc_type = 'InvalidOperationException' AND contains(lower(message), 'rate limit') THEN 'Throttling'
  ELSE 'Permanent' END AS category, {_THROTTLED} AS throttled FROM f)"""

# --- request log ------------------------------------------------------------------------------

_LOG = f"""{_E},
l0 AS (SELECT user_id AS thread_id, event_id AS request_index, ts, value AS response_ms, event_type,
  CAST(CASE WHEN event_type = 'error' THEN CASE WHEN k < 50 THEN 500 END
    WHEN event_type = 'click' OR (event_type = 'view' AND k < 95) OR (event_type = 'signup' AND user_id % 3 = 0) THEN 429
    ELSE 200 END AS INTEGER) AS status_code FROM e),
l AS (SELECT *, coalesce(status_code = 200, false) AS success,
  CAST(row_number() OVER (PARTITION BY thread_id ORDER BY request_index) - 1 AS BIGINT) AS n FROM l0)"""
_WINDOWS = f"""{_LOG},
w AS (SELECT thread_id, n // 30 AS window_no, count(*) AS requests, count(*) FILTER (status_code = 429) AS throttled
  FROM l GROUP BY ALL HAVING count(*) = 30),
wp AS (SELECT *, round_even(100.0 * throttled / requests, 2) AS throttled_percent FROM w),
wf AS (SELECT *, throttled_percent >= 60 AS flagged FROM wp),
runs AS (SELECT *, window_no - row_number() OVER (PARTITION BY thread_id ORDER BY window_no) AS island
  FROM wf WHERE flagged),
cut AS (SELECT thread_id, min(first_no) + 1 AS cut_window FROM (
  SELECT thread_id, island, min(window_no) AS first_no FROM runs GROUP BY ALL HAVING count(*) >= 2) GROUP BY ALL)"""
_WHOLE_SECOND = "CAST(floor(epoch(ts)) AS BIGINT) // 3600"

# --- lookups ------------------------------------------------------------------------------------

_REGIONS = "['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST', 'ATLANTIS']"


def _nested(depth: int) -> str:
    too_deep = (
        "'Lookup resolution for ''n_regionkey'' exceeded maximum depth of 2.'"
        if depth == 2
        else f"CASE WHEN ({_REGIONS})[nation % 6 + 1] NOT IN (SELECT r_name FROM region) THEN "
        "'Lookup resolution for ''n_regionkey'': entity ''region'' not found and CreateIfNotExists is false.' END"
    )
    return f"""o AS (SELECT o_orderkey, o_custkey * 2 AS number, (o_custkey * 2) % 40 AS nation,
  printf('Customer#%09d', o_custkey * 2) AS cname FROM orders),
j AS (SELECT o.*, c_custkey, n_nationkey,
  CASE WHEN c_custkey IS NULL AND n_nationkey IS NULL THEN {too_deep} END AS error
  FROM o LEFT JOIN customer ON c_name = cname LEFT JOIN nation ON n_name = 'NATION_' || nation)"""


_NATION_ID = "coalesce(CAST(n_nationkey AS VARCHAR), " + _uuid("'nation:n_name=nation_' || nation") + ")"
_CUSTOMER_ID = "coalesce(CAST(c_custkey AS VARCHAR), " + _uuid("'customer:c_name=' || lower(cname)") + ")"

# --- account documents ----------------------------------------------------------------------------

_DOCS = f"""d AS (SELECT *, c_custkey AS n, c_custkey % 5 AS contacts FROM customer),
ct AS (SELECT d.n, d.c_name, d.c_mktsegment, CAST(i AS INTEGER) AS i,
   CASE WHEN n % 17 = 0 AND i = 1 THEN ' C' || n || '.0@EXAMPLE.com' ELSE 'c' || n || '.' || i || '@example.com' END AS email,
   (n % 29 = 0 AND i = 0) AS no_last, (n % 31 = 0 AND i = 2) AS absent,
   ((i = n % contacts) OR (n % 23 = 0 AND i = 1)) AND NOT (n % 31 = 0 AND i = 2) AS is_primary
   FROM d, unnest(range(contacts)) AS u(i)),
ce AS (SELECT n, i, concat_ws('; ',
   CASE WHEN absent THEN 'Contacts[' || i || ']: must not be null.' END,
   CASE WHEN NOT absent AND n % 17 = 0 AND i = 1 THEN
     'Contacts[1]: duplicate Email ''' || email || ''' — contact keys must be unique per request.' END,
   CASE WHEN NOT absent AND no_last THEN 'Contacts[' || i || ']: LastName is required.' END) AS err FROM ct),
pc AS (SELECT n, count(*) FILTER (is_primary) AS primaries, min(i) FILTER (is_primary) AS first_primary FROM ct GROUP BY n),
de AS (SELECT d.n, d.n % 19 = 0 AS malformed,
   concat_ws('; ', nullif((SELECT string_agg(err, '; ' ORDER BY i) FROM ce WHERE ce.n = d.n AND err <> ''), ''),
     CASE WHEN primaries > 1 THEN 'Exactly one contact may be marked IsPrimary (found ' || primaries || ').' END) AS errors
   FROM d LEFT JOIN pc ON pc.n = d.n),
good AS (SELECT d.*, first_primary, CASE WHEN n % 3 <> 0 THEN CASE WHEN n % 37 = 1 THEN 2 ELSE 1 END ELSE 0 END AS copies
   FROM d JOIN de USING (n) LEFT JOIN pc USING (n) WHERE NOT malformed AND errors = ''),
ok AS (SELECT *, CASE WHEN copies = 1 THEN 'a' || n || '-0' ELSE {_uuid("'account:accountnumber=' || lower(c_name)")} END AS account_id
   FROM good WHERE copies < 2),
kc AS (SELECT ok.n, ok.c_name, ok.c_mktsegment, ok.account_id, ct.i, ct.email, ct.is_primary,
   n % 4 = 3 AND ct.i = 0 AS known,
   CASE WHEN n % 4 = 3 AND ct.i = 0 THEN 'k' || n ELSE {_uuid("'contact:emailaddress1=' || email")} END AS contact_id
   FROM ok JOIN ct USING (n))"""

_BAD_DOCUMENT = "Invalid request: The body is not a valid account document."
_AMBIGUOUS = (
    "'Multiple ''account'' records (2+) found for KeyAttributes ''account:accountnumber=' || c_name || '''.'"
)


def oracle_sql() -> dict[str, str]:
    return {
        "upsert_customers": _UPSERTED,
        "upsert_customers_from_json": _UPSERTED,
        "upsert_customers_typed": _UPSERTED,
        "upsert_results": f"WITH {_CUSTOMER_CHANGES}, {_CUSTOMER_RESULTS} SELECT * FROM r",
        "last_present_wins": f"""WITH {_E},
v AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM e WHERE event_type <> 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
w AS (SELECT user_id, CASE WHEN event_type = 'click' THEN k END AS v FROM e WHERE event_type IN ('view', 'click')
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT u.user_id, v.v AS value, v.user_id IS NOT NULL AS value_supplied, w.v AS k, w.user_id IS NOT NULL AS k_supplied
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN v USING (user_id) LEFT JOIN w USING (user_id)""",
        "fold_changes": f"""WITH {_CUSTOMER_CHANGES}
SELECT 'c_name=' || lower(keys.key) AS identity, nat.v AS c_nationkey, bal.v AS c_acctbal, seg.v AS c_mktsegment,
  bal.key IS NOT NULL AS acctbal_supplied
FROM keys LEFT JOIN bal ON bal.key = keys.key LEFT JOIN nat ON nat.key = keys.key LEFT JOIN seg ON seg.key = keys.key""",
        "key_signature": f"""SELECT c_custkey, 'customer:c_name=' || {_escape("c_name || '=' || n_name")} ||
  ',c_nation=' || c_nationkey || ',none=null,rich=' || CASE WHEN c_acctbal > 5000 THEN 'True' ELSE 'False' END ||
  ',seg\\:ment=' || {_escape("c_mktsegment || ',' || chr(92)")} AS signature
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "key_signature_dates": """SELECT o_orderkey, 'order:day=' || strftime(o_orderdate, '%Y-%m-%dT00\\:00\\:00.0000000Z') ||
  ',month=' || strftime(o_orderdate, '%Y-%m') || ',stamp=' || strftime(o_orderdate, '%Y-%m-%dT10\\:30\\:00.0000000Z') AS signature
FROM orders""",
        "identity_key": f"""WITH i AS (SELECT p_partkey, 'p_brand=' || lower(p_brand) || ',p_name=' || lower(p_name) ||
  CASE WHEN p_size > 25 THEN ',p_type=' || lower(p_type) ELSE ',p_type' END AS identity FROM part)
SELECT p_partkey, identity, {_uuid("'part:' || identity")} AS new_id FROM i""",
        "resolve_unique": f"""WITH o AS (SELECT o_orderkey, printf('Customer#%09d', o_custkey + (o_orderkey % 3) * 500) AS name FROM orders)
SELECT o_orderkey, CAST(CASE WHEN c_custkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS match_count,
  CAST(c_custkey AS VARCHAR) AS match_id, CASE WHEN c_custkey IS NULL THEN 'create' ELSE 'update' END AS action,
  coalesce(CAST(c_custkey AS VARCHAR), {_uuid("'customer:c_name=' || lower(name)")}) AS final_id
FROM o LEFT JOIN customer ON c_name = name""",
        "resolve_ambiguous": """WITH m AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL),
l AS (SELECT p_brand, p_size FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT l.*, n, 'part:p_brand=' || l.p_brand || ',p_size=' || l.p_size AS signature FROM l JOIN m USING (p_brand, p_size))
SELECT signature, n AS match_count, CASE WHEN n > 1 THEN 'Multiple ''part'' records (' || least(n, 3) ||
  '+) found for KeyAttributes ''' || signature || '''.' END AS error, count(*) AS rows FROM s GROUP BY ALL""",
        "resolve_given_ids": """WITH o AS (SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey * 2 AS VARCHAR) END AS given FROM orders)
SELECT o_orderkey, 'update' AS action, coalesce(given, CAST(o_custkey AS VARCHAR)) AS final_id,
  CASE WHEN given IS NOT NULL AND c_custkey IS NULL THEN 'Entity ''customer'' with id ''' || given || ''' does not exist.' END AS error
FROM o LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = given""",
        "reresolve_conflicts": """SELECT o_orderkey, 'update' AS action, CAST(c_custkey AS VARCHAR) AS final_id, CAST(NULL AS VARCHAR) AS error
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey >= 12""",
        "lookup_one_level": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS nation_id,
  CASE WHEN c_custkey % 7 = 0 THEN 'Permanent' ELSE 'None' END AS category,
  CASE WHEN c_custkey % 7 = 0 THEN 'Lookup resolution for ''c_nationkey'': entity ''nation'' not found and CreateIfNotExists is false.' END AS error
FROM customer""",
        "lookup_create_missing": f"""WITH {_E}, x AS (SELECT event_id, printf('Customer#%09d', user_id * 20 + k) AS name FROM e)
SELECT event_id, coalesce(CAST(c_custkey AS VARCHAR), {_uuid("'customer:c_name=' || lower(name)")}) AS resolved_id,
  c_custkey IS NULL AND row_number() OVER (PARTITION BY name ORDER BY event_id) = 1 AS was_created,
  'Lookups.o_custkey' AS path, CAST(0 AS BIGINT) AS depth
FROM x LEFT JOIN customer ON c_name = name""",
        "lookup_created_records": f"""WITH {_E}, x AS (SELECT event_id, printf('Customer#%09d', user_id * 20 + k) AS name FROM e)
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT {_uuid("'customer:c_name=' || lower(name)")}, name, 'E' || min(event_id) FROM x
WHERE name NOT IN (SELECT c_name FROM customer) GROUP BY name""",
        "lookup_nested_depth_3": f"""WITH {_nested(3)}
SELECT o_orderkey, CASE WHEN error IS NULL THEN 'None' ELSE 'Permanent' END AS category, error FROM j""",
        "lookup_nested_depth_2": f"""WITH {_nested(2)}
SELECT o_orderkey, CASE WHEN error IS NULL THEN 'None' ELSE 'Permanent' END AS category, error FROM j""",
        "lookup_nested_records": f"""WITH {_nested(3)},
made AS (SELECT * FROM j WHERE error IS NULL AND c_custkey IS NULL)
SELECT 'customer' AS entity, c_name AS name, CAST(c_nationkey AS VARCHAR) AS parent_id FROM customer
UNION ALL SELECT DISTINCT 'customer', cname, {_NATION_ID} FROM made
UNION ALL SELECT 'nation', n_name, CAST(n_regionkey AS VARCHAR) FROM nation
UNION ALL SELECT DISTINCT 'nation', 'NATION_' || nation,
  CAST((SELECT r_regionkey FROM region WHERE r_name = ({_REGIONS})[nation % 6 + 1]) AS VARCHAR) FROM made WHERE n_nationkey IS NULL""",
        "lookup_trace_trees": f"""WITH {_nested(3)},
c AS (SELECT *, {_CUSTOMER_ID} AS cid, {_NATION_ID} AS nid,
   CAST((SELECT r_regionkey FROM region WHERE r_name = ({_REGIONS})[nation % 6 + 1]) AS VARCHAR) AS rid,
   error IS NULL AND c_custkey IS NULL AND row_number() OVER (PARTITION BY cname ORDER BY o_orderkey) = 1 AS made FROM j),
m AS (SELECT *, made AND n_nationkey IS NULL AND row_number() OVER (PARTITION BY nation, made ORDER BY o_orderkey) = 1 AS nmade FROM c)
SELECT o_orderkey, CASE WHEN error IS NULL THEN
 '[{{"AttributeName":"o_custkey","EntityLogicalName":"customer","ResolvedId":"' || cid || '","WasCreated":' || made || ',"Depth":0,"NestedTraces":' ||
 CASE WHEN NOT made THEN 'null' ELSE
 '[{{"AttributeName":"c_nationkey","EntityLogicalName":"nation","ResolvedId":"' || nid || '","WasCreated":' || nmade || ',"Depth":1,"NestedTraces":' ||
 CASE WHEN NOT nmade THEN 'null' ELSE
 '[{{"AttributeName":"n_regionkey","EntityLogicalName":"region","ResolvedId":"' || rid || '","WasCreated":false,"Depth":2,"NestedTraces":null}}]' END || '}}]' END || '}}]' END AS traces
FROM m""".replace("{{", "{").replace("}}", "}"),
        "guard_messages": f"""WITH d AS (SELECT doc_id, doc_id % 8 AS m, text,
  '{{"EntityLogicalName":"x","KeyAttributes":{{}},"Attributes":{{"t":"' || hex(encode(text)) || '"}}}}' AS payload FROM documents),
b AS (SELECT *, CASE m WHEN 0 THEN octet_length(encode(text)) WHEN 1 THEN length(hex(encode(text))) + 22
   WHEN 2 THEN length(payload) * 3 + 2 + 15 WHEN 3 THEN length(payload) + 13 + 22 WHEN 4 THEN length(payload) + 13 + 4
   WHEN 5 THEN length(payload) + 13 + 6 + 2 * (20 + doc_id % 20) + 1 WHEN 6 THEN 4 ELSE length(payload) + 15 END AS bytes FROM d),
s AS (SELECT *, CASE WHEN bytes > 20000 THEN 'Request body exceeds the maximum allowed size of 20000 bytes.'
   WHEN m = 6 THEN 'Invalid request: Request body must contain a JSON object.'
   WHEN m IN (0, 3, 4) OR (m = 5 AND 20 + doc_id % 20 + 1 > 32) THEN '{_MALFORMED}'
   WHEN m = 1 THEN '{_NO_ITEMS}'
   WHEN m = 2 THEN 'Invalid request: Payloads count (3) exceeds the maximum of 2.' END AS error FROM b)
SELECT doc_id, CAST(CASE WHEN bytes > 20000 THEN 413 WHEN error IS NOT NULL THEN 400 END AS INTEGER) AS status, error,
  CAST(CASE WHEN error IS NULL THEN 1 ELSE -1 END AS INTEGER) AS payloads FROM s""",
        "guard_depth": "SELECT page_id, 2 * (page_id % 40) > 32 AS too_deep FROM pages",
        "correlation_ids": """WITH m AS (
SELECT conv_id || '/' || turn AS message_id, text AS c FROM conversations
UNION ALL SELECT conv_id || '/' || turn || '/r', role FROM conversations)
SELECT message_id, CASE WHEN length(c) <= 64 AND regexp_full_match(c, '[\\x20-\\x7E]{1,64}') AND trim(c) <> '' THEN c
  ELSE substr(sha256('correlation:' || message_id), 1, 32) END AS correlation_id FROM m""",
        "validate_attributes": f"""WITH {_EVENT_MESSAGES}
SELECT message_id, idx, CASE WHEN n <> 20 THEN 'event:number=' || event_id END AS signature, error FROM p""",
        "validate_batches": f"""WITH {_EVENT_MESSAGES}
SELECT message_id, 'Payload[' || idx || ']: ' || replace(error, '; Field', '|Payload[' || idx || ']: Field') AS errors
FROM p WHERE error IS NOT NULL QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY idx) = 1""",
        "coerce_values": f"""WITH {_EVENT_MESSAGES}
SELECT CASE WHEN n = 7 THEN event_id ELSE event_id END AS number,
  CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 8 ELSE 16 END AS INTEGER) AS kind,
  value AS amount, CASE WHEN n <> 13 THEN k END AS k, true AS k_supplied,
  CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS happened, replace(props, ' ', '') AS details, value > 50 AS large,
  CASE WHEN n = 9 THEN '[1,2]' END AS tags
FROM p WHERE error IS NULL""",
        "message_status": f"""WITH {_EVENT_MESSAGES},
s AS (SELECT message_id, count(*) AS total, count(error) AS failed FROM p GROUP BY ALL)
SELECT message_id, CAST(CASE WHEN failed > 0 THEN 400 ELSE 200 END AS INTEGER) AS status, total, failed,
  failed AS validation_failed, CAST(0 AS BIGINT) AS technical_failed, CAST(NULL AS VARCHAR) AS error FROM s
UNION ALL SELECT DISTINCT message_id, 400, 0, 0, 0, 0,
  CASE message_id % 50 WHEN 49 THEN '{_MALFORMED}' ELSE '{_NO_ITEMS}' END FROM x WHERE message_id % 50 IN (48, 49)""",
        "convert_texts": """WITH t AS (SELECT *, l_orderkey * 7 + l_linenumber AS n FROM lineitem),
d AS (SELECT *, md5(CAST(n AS VARCHAR)) AS h FROM t)
SELECT CAST(n AS BIGINT) AS n, CASE WHEN n % 6 <> 5 THEN substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) END AS guid,
  CAST(CASE n % 3 WHEN 0 THEN CASE l_returnflag WHEN 'A' THEN 5 WHEN 'N' THEN 6 WHEN 'R' THEN 4 END
    WHEN 1 THEN l_linenumber END AS INTEGER) AS choice,
  CASE n % 4 WHEN 0 THEN CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT)
    WHEN 1 THEN CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + 34200 END AS stamp FROM d""",
        "normalize_untyped": f"""WITH {_E}, x AS (SELECT *, event_id % 6 AS m FROM e)
SELECT event_id, CASE m WHEN 0 THEN 'int' WHEN 1 THEN CASE WHEN event_id * 1000000000 <= 2147483647 THEN 'int' ELSE 'long' END
  WHEN 2 THEN 'decimal' WHEN 3 THEN 'datetime' WHEN 4 THEN 'string' ELSE 'object' END AS kind,
  CASE m WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN CAST(event_id * 1000000000 AS VARCHAR) WHEN 2 THEN '1.5'
  WHEN 3 THEN printf('2024-01-%02dT00:00:00.0000000Z', k % 28 + 1) WHEN 4 THEN event_type ELSE replace(props, ' ', '') END AS text
FROM x""",
        "batch_status": f"""WITH {_RESULT_CATEGORIES}, s AS (SELECT message_id, CAST({_STATUS} AS INTEGER) AS status, {_COUNTS} FROM r GROUP BY ALL)
SELECT message_id, status, CASE WHEN status = 429 THEN CAST(300 AS BIGINT) END AS retry_after, total, failed, validation_failed, technical_failed FROM s""",
        "batch_counts": f"WITH {_RESULT_CATEGORIES} SELECT message_id, {_COUNTS} FROM r GROUP BY message_id",
        "result_documents": f"""WITH {_CUSTOMER_CHANGES}, {_CUSTOMER_RESULTS}
SELECT CAST(message_id // 10 AS BIGINT) AS message_id, '[' || string_agg('{{"Id":"' || id || '","Created":' || created ||
  ',"EntityLogicalName":"customer","UpsertKey":"' || upsert_key ||
  '","ErrorMessage":null,"ErrorCategory":"None","ValidationErrors":null,"LookupTraces":null}}', ',' ORDER BY message_id) || ']' AS body
FROM r GROUP BY message_id // 10""",
        "error_documents": f"""WITH x AS (SELECT DISTINCT CAST(event_id // 10 AS BIGINT) AS message_id FROM events)
SELECT message_id, '{{"Error":"' || CASE message_id % 50 WHEN 49 THEN '{_MALFORMED}' ELSE '{_NO_ITEMS}' END ||
  '","CorrelationId":"' || substr(sha256('correlation:' || message_id), 1, 32) || '"}}' AS json
FROM x WHERE message_id % 50 IN (48, 49)""",
        "classify_errors": f"WITH {_FAILURES} SELECT op_id, node_id, category FROM g",
        "classify_groups": f"""WITH {_FAILURES},
s AS (SELECT op_id, max(category) FILTER (node_id = 0) AS own, bool_or(node_id = 0 AND exc_type = 'AggregateException') AS agg,
  bool_or(throttled) AS throttled,
  min(CASE category WHEN 'Cancellation' THEN 1 WHEN 'Throttling' THEN 2 WHEN 'Transient' THEN 3 WHEN 'Validation' THEN 4 ELSE 5 END)
    FILTER (node_id <> 0 AND exc_type <> 'AggregateException') AS rank FROM g GROUP BY op_id)
SELECT op_id, CASE WHEN NOT agg THEN own WHEN throttled THEN 'Throttling'
  ELSE coalesce((['Cancellation', 'Throttling', 'Transient', 'Validation', 'Permanent'])[rank], 'Permanent') END AS category FROM s""",
        "key_conflicts": f"""WITH {_FAILURES} SELECT op_id,
  bool_or(({_IS_FAULT} AND coalesce(fault_code IN {_in(_KEY_CONFLICT_CODES)}, false))
   OR regexp_matches(lower(message), 'already exists|does not exist|duplicate')) AS is_key_conflict FROM g GROUP BY op_id""",
        "retryable": f"""WITH {_FAILURES},
s AS (SELECT op_id, max(op_kind) FILTER (node_id = 0) AS op_kind, max(exc_type) FILTER (node_id = 0) AS t,
  max(message) FILTER (node_id = 0) AS message, bool_or(throttled) AS throttled,
  arg_min(exc_type, node_id) FILTER (node_id <> 0) AS inner_type FROM g GROUP BY op_id)
SELECT op_id, op_kind, CASE WHEN t IN ('ProtocolException', 'FaultException') THEN throttled
  WHEN t = 'InvalidOperationException' THEN throttled OR contains(lower(message), 'failed to connect to')
     OR (op_kind <> 'create' AND {_EMPTY_RESPONSE})
  WHEN t = 'AggregateException' THEN throttled OR (op_kind <> 'create' AND coalesce(inner_type IN ('TimeoutException', 'HttpRequestException'), false))
  WHEN t IN ('TimeoutException', 'HttpRequestException', 'TimeoutRejectedException') THEN op_kind <> 'create'
  ELSE false END AS retryable FROM s""",
        "retry_delay": f"""WITH {_FAILURES},
h AS (SELECT *, CASE WHEN {_IS_FAULT} THEN CASE retry_after WHEN '42' THEN 42.0 WHEN '00:00:17' THEN 17.0 WHEN '00:10:00' THEN 600.0
  WHEN '1.00:00:00' THEN 86400.0 WHEN '00:00:01.5' THEN 1.5 END END AS hint FROM g),
s AS (SELECT op_id, bool_or(throttled) AS throttled, arg_min(hint, node_id) FILTER (hint IS NOT NULL) AS hint FROM h GROUP BY op_id)
SELECT op_id, CASE WHEN throttled THEN CAST(least(coalesce(hint, 300.0), 300.0) AS DOUBLE) END AS delay_seconds FROM s""",
        "validate_documents": f"""WITH {_DOCS}
SELECT n AS message_id, CASE WHEN malformed THEN '{_BAD_DOCUMENT}' END AS guard_error, CASE WHEN NOT malformed THEN errors END AS errors FROM de""",
        "document_results": f"""WITH {_DOCS}
SELECT n AS message_id, CAST(0 AS BIGINT) AS idx, 'account' AS entity, 'account:accountnumber=' || c_name AS upsert_key,
  copies = 0 AS created, CASE WHEN copies > 1 THEN 'Permanent' ELSE 'None' END AS category,
  CASE WHEN copies > 1 THEN {_AMBIGUOUS} END AS error FROM good
UNION ALL SELECT n, i + 1, 'contact', 'contact:emailaddress1=' || email, NOT known, 'None', NULL FROM kc
UNION ALL SELECT n, contacts + 1, 'account', 'account:accountnumber=' || c_name, false, 'None', NULL FROM ok WHERE first_primary IS NOT NULL""",
        "document_accounts": f"""WITH {_DOCS},
old AS (SELECT 'a' || c_custkey || '-' || copy AS accountid, c_custkey AS n, upper(c_name) AS accountnumber FROM customer,
  unnest(range(CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 37 = 1 THEN 2 ELSE 1 END)) AS u(copy)),
lk AS (SELECT ok.*, contact_id FROM ok LEFT JOIN kc ON kc.n = ok.n AND kc.is_primary)
SELECT accountid, coalesce(lk.c_name, accountnumber) AS accountnumber, coalesce('N ' || c_mktsegment, 'old') AS name,
  CASE WHEN lk.n % 2 = 1 THEN 'City ' || c_nationkey ELSE 'Old City' END AS address1_city, 'Old Street' AS address1_line1,
  contact_id AS primary_contact
FROM old LEFT JOIN lk ON lk.account_id = accountid
UNION ALL SELECT account_id, c_name, 'N ' || c_mktsegment, CASE WHEN n % 2 = 1 THEN 'City ' || c_nationkey END, NULL, contact_id FROM lk WHERE copies = 0""",
        "document_contacts": f"""WITH {_DOCS},
old AS (SELECT 'k' || c_custkey AS contactid, 'c' || c_custkey || '.0@example.com' AS email FROM customer WHERE c_custkey % 4 = 3)
SELECT contactid, old.email AS emailaddress1, CASE WHEN kc.n IS NULL THEN 'Old' ELSE 'F0' END AS firstname,
  CASE WHEN kc.n IS NULL THEN 'Old' ELSE c_mktsegment END AS lastname, CASE WHEN kc.n IS NULL THEN 'Old' ELSE 'T' END AS jobtitle,
  account_id AS parent FROM old LEFT JOIN kc ON kc.contact_id = contactid
UNION ALL SELECT contact_id, email, 'F' || i, c_mktsegment, CASE WHEN i <> 2 THEN 'T' END, account_id FROM kc WHERE NOT known""",
        "document_status": f"""WITH {_DOCS}
SELECT n AS message_id, CAST(CASE WHEN copies > 1 THEN 500 ELSE 200 END AS INTEGER) AS status,
  CASE WHEN copies > 1 THEN 1 ELSE 1 + contacts + CASE WHEN first_primary IS NULL THEN 0 ELSE 1 END END AS total,
  CAST(CASE WHEN copies > 1 THEN 1 ELSE 0 END AS BIGINT) AS failed, CAST(NULL AS VARCHAR) AS error FROM good
UNION ALL SELECT n, 400, 0, 0, CASE WHEN malformed THEN '{_BAD_DOCUMENT}' ELSE 'Validation failed.' END FROM de WHERE malformed OR errors <> ''""",
        "redelivery": f"""WITH {_RESULT_CATEGORIES},
s AS (SELECT message_id, {_STATUS} AS status, {_COUNTS} FROM r GROUP BY ALL),
m AS (SELECT DISTINCT CAST(event_id // 10 AS BIGINT) AS message_id FROM events)
SELECT message_id, CASE WHEN message_id % 3 = 2 THEN 'dead' ELSE 'again' END AS fate, message_id % 3 + 1 AS attempt,
  'Upsert failed for ' || failed || ' item(s) (' || validation_failed || ' validation, ' || technical_failed || ' technical).' AS reason
FROM m JOIN s USING (message_id) WHERE status <> 200""",
        "load_summary": f"""WITH {_LOG}, t AS (SELECT count(*) AS n, count(*) FILTER (success) AS ok FROM l)
SELECT n AS total_requests, n * 3 AS total_payloads, ok AS successful_requests, n - ok AS failed_requests,
  round_even(ok / n * 100, 2) AS success_rate, round_even(n / 120.0, 2) AS requests_per_second,
  round_even(n * 3 / 120.0, 2) AS payloads_per_second FROM t""",
        "latency_stats": f"""WITH {_LOG} SELECT round_even(avg(response_ms), 2) AS avg_ms, round_even(min(response_ms), 2) AS min_ms, round_even(max(response_ms), 2) AS max_ms FROM l""",
        "latency_percentiles": f"""WITH {_LOG} SELECT quantile_disc(response_ms, 0.5) AS p50_ms, quantile_disc(response_ms, 0.95) AS p95_ms,
  quantile_disc(response_ms, 0.99) AS p99_ms FROM l""",
        "status_breakdown": f"""WITH {_LOG} SELECT coalesce(CAST(status_code AS VARCHAR), '(no status)') AS status, count(*) AS requests FROM l GROUP BY ALL""",
        "throttle_windows": f"WITH {_WINDOWS} SELECT * FROM wf",
        "sustained_throttling": f"WITH {_WINDOWS} SELECT thread_id, cut_window FROM cut",
        "until_sustained": f"""WITH {_WINDOWS}
SELECT l.thread_id, l.request_index, l.n FROM l LEFT JOIN cut USING (thread_id) WHERE cut_window IS NULL OR n // 30 <= cut_window""",
        "sample_errors": f"""WITH {_LOG} SELECT thread_id, request_index, 'failed: ' || event_type AS error FROM l WHERE NOT success
ORDER BY thread_id, request_index LIMIT 10""",
        "failure_ratio_windows": f"""WITH {_LOG},
s AS (SELECT event_type AS service, {_WHOLE_SECOND} AS second, count(*) AS n, count(*) FILTER (response_ms > 20) AS f FROM l GROUP BY ALL),
w AS (SELECT service, second, CAST(sum(n) OVER x AS BIGINT) AS calls, CAST(sum(f) OVER x AS BIGINT) AS failures FROM s
  WINDOW x AS (PARTITION BY service ORDER BY second RANGE BETWEEN 60 PRECEDING AND CURRENT ROW))
SELECT *, calls >= 10 AND failures >= 0.5 * calls AS flagged FROM w""",
        "rate_breaches": f"""WITH {_LOG} SELECT {_WHOLE_SECOND} AS second, count(*) AS calls FROM l GROUP BY ALL HAVING count(*) > 15""",
    }
