"""SQL twins of ``message_queries``. They state their own texts."""

from __future__ import annotations

from driverchecks.further_sql import _E, _uuid

_FAULTS = {
    1: "KeyAttributes must contain at least one entry for the main entity.; EntityLogicalName is required.; Attributes are required.",
    2: "Entity ''nosuch'' does not exist in the early-bound model.",
    3: "KeyAttribute ''zip'' is not defined on entity ''order''.",
    4: "Lookups.a: Lookup definition must not be null.",
    5: "Lookups.b: EntityLogicalName is required.; Lookups.b: KeyAttributes must contain at least one entry.",
    6: "Lookups.o_custkey.d: Entity ''nope'' does not exist in the early-bound model.",
    7: "Lookups.o_custkey.KeyAttributes: Field ''adx_identity_x'' is not writable through this endpoint.",
    8: "Lookups.o_custkey.CreateAttributes: Field ''zap'' is not defined on entity ''customer''.",
    9: "KeyAttribute ''o_orderkey'' must not also be present in Attributes.",
    10: "Field ''ADX_identity_X'' is not writable through this endpoint.",
    11: "Field ''o_custkey'' has invalid type. Expected ''EntityReference''.; Field ''o_comment'' has invalid type. Expected ''string''.",
    12: "KeyAttribute ''o_orderkey'' has invalid type. Expected ''long''.",
    13: "KeyAttribute ''adx_identity_x'' is not usable through this endpoint.",
    14: "Payload must not be null.",
}
_SIGNATURES = {1: "NULL", 2: "'nosuch:o_orderkey=1'", 3: "'order:zip=1'", 12: "'order:o_orderkey=x'", 13: "'order:adx_identity_x=1'", 14: "NULL"}


def _case(number: str, texts: dict[int, str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN {t}" for n, t in texts.items())


SQL: dict[str, str] = {
    "money_digits": f"""WITH {_E}, a AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '-' ELSE '' END || (k + 1) || lpad((event_id * 7919)::VARCHAR, 15, '0')
  || '.' || lpad((event_id * 104729 % 10000000000)::VARCHAR, 10, '0') AS amount FROM e)
SELECT event_id, CAST(CAST(amount AS DECIMAL(38,10)) AS VARCHAR) AS amount,
  '{{"z":[' || amount || ',"' || amount || '"],"a":0.5,"s":"\\"' || amount || '"}}' AS details, NULL::VARCHAR AS error FROM a""",
    "validate_lookups": f"""SELECT event_id, {_case("event_id % 16", _SIGNATURES)} ELSE 'order:o_orderkey=1' END AS signature,
  {_case("event_id % 16", {n: f"'{t}'" for n, t in _FAULTS.items()})} END AS error FROM events""",
    "guard_envelope": """WITH m AS (SELECT CAST(event_id // 10 AS BIGINT) AS message_id, count(*) AS n, bool_or(event_id % 10 = 4) AS has FROM events GROUP BY ALL),
b AS (SELECT *, message_id % 12 IN (9, 10) OR (has AND message_id % 12 IN (1, 2, 3, 4, 5, 6, 7, 11)) AS bad FROM m)
SELECT message_id, CASE WHEN bad THEN 400 END AS status, CASE WHEN bad THEN 'Invalid request: The body is not a valid JSON batch.' END AS error,
  CAST(CASE WHEN bad THEN -1 ELSE n END AS INTEGER) AS payloads FROM b""",
    "lookup_from_json": f"""WITH {_E}, c AS (SELECT event_id, user_id, k % 40 AS nation, row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS makes FROM e),
o AS (SELECT *, nation >= 25 AND row_number() OVER (PARTITION BY nation ORDER BY event_id) = 1 AS makes_nation FROM c WHERE makes)
SELECT event_id, 'Lookups.o_custkey' AS path, 0::BIGINT AS depth, {_uuid("'customer:c_name=new#' || user_id")} AS resolved_id, makes AS was_created FROM c
UNION ALL SELECT event_id, 'Lookups.o_custkey.c_nationkey', 1, CASE WHEN nation < 25 THEN nation::VARCHAR ELSE {_uuid("'nation:n_name=nation_' || nation")} END, makes_nation FROM o
UNION ALL SELECT event_id, 'Lookups.o_custkey.c_nationkey.n_regionkey', 2, (SELECT r_regionkey::VARCHAR FROM region WHERE r_name = 'AFRICA'), false FROM o WHERE makes_nation""",
    "lookup_cycles": """SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN 'Permanent' ELSE 'None' END AS category,
  CASE event_id % 4 WHEN 1 THEN 'Cyclic lookup detected for ''n_regionkey'' (customer:c_name=CYC#' || event_id || '). Resolution path: customer:c_name=Cyc#'
      || event_id || ' -> nation:n_name=Nat#' || event_id
    WHEN 2 THEN 'Cyclic lookup detected for ''n_regionkey'' (nation:n_name=Nat#' || event_id || '). Resolution path: customer:c_name=Cyc#'
      || event_id || ' -> nation:n_name=Nat#' || event_id END AS error FROM events""",
    "lookup_depth_overrides": """WITH d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 2 WHEN event_id % 5 = 0 THEN 3 WHEN event_id % 5 = 1 THEN 1
    WHEN event_id // 10 % 4 = 1 THEN 1 WHEN event_id // 10 % 4 = 2 THEN 2 ELSE 3 END AS top FROM events),
n AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 3 ELSE top END AS limit_ FROM d),
r AS (SELECT event_id, CASE WHEN limit_ = 1 THEN 'Lookup resolution for ''c_nationkey'' exceeded maximum depth of 1.'
  WHEN limit_ = 2 THEN 'Lookup resolution for ''n_regionkey'' exceeded maximum depth of 2.' END AS error FROM n)
SELECT event_id, CASE WHEN error IS NULL THEN 'None' ELSE 'Permanent' END AS category, error FROM r""",
}
