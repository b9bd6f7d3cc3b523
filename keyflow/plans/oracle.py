"""For each registered query, the SQL that gives the same rows in DuckDB on the same tables.

Written independently of the Spark side: plain windows, self joins and recursive queries where Spark uses block-wise
scans, time slots or state.
"""

from __future__ import annotations

EPOCH_US = 1_704_067_200_000_000
DAY_US = 86_400_000_000
STOP_US = EPOCH_US + 15 * DAY_US
END_US = EPOCH_US + 30 * DAY_US
NEVER = 9_223_372_036_854_775_807

# Common table expressions. Each may use the ones before it.
TABLES: dict[str, str] = {}

TABLES["log"] = r"""
SELECT event_id, user_id, event_type, 'events' AS topic, CAST(user_id % 12 AS INT) AS part, event_id AS off,
  CASE WHEN event_id % 29 = 0 THEN NULL
       WHEN event_id % 31 = 0 THEN '\xFF\xFE'::BLOB
       WHEN event_id % 37 = 0 THEN encode('')
       ELSE encode('u' || CAST(user_id AS VARCHAR)) END AS key,
  CASE WHEN event_id % 17 = 0 THEN NULL
       WHEN event_id % 19 = 0 THEN encode('')
       WHEN event_id % 23 = 0 THEN encode('{bad')
       ELSE encode(props) END AS value,
  CASE WHEN event_id % 10 = 0 THEN -1 WHEN event_id % 10 = 1 THEN 1 WHEN event_id % 10 = 2 THEN 99 ELSE 0 END AS ts_type,
  epoch_us(ts) // 1000 AS ts_ms, epoch_us(ts) AS read_us, CAST(round(value * 100) AS BIGINT) AS cents,
  [{'key': 'trace', 'value': CASE WHEN event_id % 5 <> 0 THEN encode('t1') END},
   {'key': 'trace', 'value': encode('t2')}, {'key': 'kind', 'value': encode(event_type)}] AS headers
FROM events"""

TABLES["records"] = """
SELECT *,
  CASE ts_type WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS ts_kind,
  CASE WHEN ts_type IN (0, 1) THEN ts_ms END AS ts_millis,
  CASE WHEN key IS NULL THEN CAST(part AS VARCHAR) WHEN TRY(decode(key)) IS NOT NULL THEN decode(key) ELSE base64(key) END AS key_str,
  CASE WHEN key IS NULL THEN 'partition' WHEN TRY(decode(key)) IS NOT NULL THEN 'raw' ELSE 'base64' END AS key_source,
  TRY(decode(value)) AS value_text
FROM log"""

TABLES["processed"] = """
SELECT *, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS outcome,
  CASE WHEN error IS NULL THEN CAST(1024 + CASE WHEN cents > 5000 THEN 2048 ELSE 0 END
    + CASE WHEN event_type = 'purchase' THEN 4096 ELSE 0 END AS BIGINT) ELSE CAST(0 AS BIGINT) END AS app_traits
FROM (SELECT *, CASE WHEN value IS NULL THEN 'record without a value'
    WHEN octet_length(value) = 0 THEN 'empty payload'
    WHEN NOT json_valid(value_text) THEN 'invalid JSON'
    WHEN key_source = 'base64' THEN 'binary key ' || key_str END AS error FROM records)"""

TABLES["attempts"] = """
SELECT topic, part, off, 1 AS attempt_no, key_str, event_type, read_us, start_us,
  CASE WHEN NOT (event_type = 'error' AND off % 50 = 0) THEN start_us + cents * 600000 END AS done_us,
  cents, cents * 100 AS proc_us, outcome, error, app_traits, outcome <> 'ok' AS dead_lettered
FROM (SELECT *, read_us + (off % 1000) * 100 AS start_us FROM processed)"""

TABLES["deliveries"] = """
SELECT * FROM attempts UNION ALL
SELECT * REPLACE (2 AS attempt_no, read_us + 3600000000 AS read_us, start_us + 3600000000 AS start_us,
  done_us + 3600000000 AS done_us) FROM attempts WHERE off % 13 = 0"""

TABLES["collapsed"] = """
SELECT topic, part, off, min(read_us) AS read_us, min(start_us) AS start_us, min(done_us) AS done_us
FROM deliveries GROUP BY ALL"""

TABLES["assignments"] = f"""
SELECT topic, part, epoch, {EPOCH_US} + epoch * 10 * {DAY_US} + part::BIGINT * 3600000000 AS assigned_us,
  {EPOCH_US} + (epoch + 1) * 10 * {DAY_US} + part::BIGINT * 3600000000 - 60000000
    + CASE WHEN part % 4 = 1 AND epoch = 0 THEN 3600000000 ELSE 0 END AS revoked_us
FROM (SELECT DISTINCT topic, part FROM records), (SELECT unnest([0, 1, 2])::BIGINT AS epoch)"""

TABLES["packets"] = f"""
SELECT topic, 'group-' || (part % 2) AS consumer_group, 'bill"ing' AS service, '' AS team, part, off,
  app_traits | CASE WHEN outcome <> 'ok' THEN 1 ELSE 0 END | CASE WHEN dead_lettered THEN 4 ELSE 0 END
  | CASE WHEN attempt_no > 1 THEN 16 ELSE 0 END | CASE WHEN off % 41 = 0 THEN 32 ELSE 0 END
  | CASE WHEN off % 997 = 0 THEN 2 ELSE 0 END AS traits,
  CAST(off % 50 AS BIGINT) AS queue_depth, proc_us * 1000 - 10000000 AS process_duration_ns,
  CASE WHEN dead_lettered THEN (off % 97) * 1000000 ELSE 0 END AS deadletter_duration_ns,
  CASE WHEN off % 11 = 0 THEN 0 ELSE read_us * 1000 END AS read_time_ns, start_us * 1000 AS process_start_time_ns
FROM deliveries WHERE done_us IS NOT NULL"""

TABLES["fetch_log"] = """
SELECT topic, part, off AS seq, read_us AS at_us, event_type <> 'error' AS ok,
  CASE WHEN event_type = 'error' THEN 'timeout ' || (off % 3) END AS err FROM records"""

TABLES["bw_entries"] = """
SELECT off // 100 AS seq, topic, part AS id, sum(coalesce(octet_length(value), 0))::BIGINT - 20 AS received_bytes,
  max(read_us) AS at_us, count(*) AS n FROM records GROUP BY ALL"""

TABLES["bw_partitions"] = """
SELECT seq, topic, 'group-' || (seq % 2) AS consumer_group, 'svc-' || (seq % 3) AS service, 'core' AS team, id, received_bytes, at_us,
  CASE WHEN id = 5 THEN 0 ELSE n * 7 END AS transmitted_bytes, CASE WHEN id = 7 THEN 0 ELSE n END AS messages,
  n * 3 AS compressed_bytes, CASE WHEN id % 4 = 0 THEN 0 ELSE n * 9 END AS uncompressed_bytes,
  ['lz4', 'unknown', 'zstd'][id % 3 + 1] AS compression
FROM bw_entries"""

TABLES["bw_packets"] = """
SELECT seq, topic, consumer_group, service, team, count(*) AS partitions, CASE WHEN seq % 4 = 0 THEN 3 ELSE 2 END AS brokers,
  CASE WHEN seq % 7 = 0 THEN 0 ELSE max(at_us) * 1000 END AS ts_unix_ns, 5000 + seq % 5 * 500 AS stats_interval_ms
FROM bw_partitions GROUP BY seq, topic, consumer_group, service, team"""

TABLES["snap_parts"] = """
SELECT off // 50 AS snap_id, part, min(off) AS lo, max(off) AS hi, count(*) AS n FROM records GROUP BY ALL"""

TABLES["snaps"] = """
SELECT snap_id, snap_id % 6 AS pick, sum(n)::BIGINT AS total, count(*) AS parts FROM snap_parts GROUP BY ALL"""

_KEYS = (
    "['concurrentKeys','perKeyBufferLen','pollTimeout','autoCommitInterval','drainTimeout','awaitAssignmentsTimeout',"
    "'commitIngestChannelLen','commitPartitionSliceLen','queryTimeout','acquireWorkerTimeoutCircuitBreaker',"
    "'workerShardsCount','rebalancePausePollingTimeout','acquireCommitGuardTimeout','rebalance.timeout.ms',"
    "'drain_timeout','no.such.key']"
)

TABLES["service_config"] = f"""
SELECT 'svc-' || (c_custkey // 5) AS service, {_KEYS}[c_custkey % 16 + 1] AS key,
  CASE c_custkey % 7 WHEN 0 THEN (amount * 10) || 'ms' WHEN 1 THEN CAST(amount * 10 AS VARCHAR)
    WHEN 2 THEN (amount % 90) || 's' WHEN 3 THEN CAST(['1','2','4','8','16','32','64','128'][amount % 8 + 1] AS VARCHAR)
    WHEN 4 THEN '0' WHEN 5 THEN CAST(amount % 400 AS VARCHAR) ELSE 'fast' END AS value
FROM (SELECT c_custkey, CAST(floor(abs(c_acctbal)) AS BIGINT) AS amount FROM customer)"""

TABLES["timeout_config"] = """
SELECT 'svc-' || o_orderkey AS service, key, value FROM (
  SELECT o_orderkey, 'drainTimeout' AS key, (amount % 60) || 's' AS value FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders)
  WHERE o_orderkey % 3 IN (0, 2)
  UNION ALL
  SELECT o_orderkey, 'rebalance.timeout.ms', CAST((amount % 70 + 1) * 1000 AS VARCHAR) FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders)
  WHERE o_orderkey % 3 IN (1, 2))"""

TABLES["config"] = "SELECT * FROM service_config UNION ALL SELECT * FROM timeout_config"

TABLES["rules"] = """
SELECT * FROM (VALUES ('concurrentKeys', 'int', 1, 5000), ('perKeyBufferLen', 'int', 1, 64),
  ('pollTimeout', 'duration', 20, 2000), ('autoCommitInterval', 'duration', 250, 15000),
  ('drainTimeout', 'duration', 2000, 55000), ('awaitAssignmentsTimeout', 'duration', 5000, 300000),
  ('commitIngestChannelLen', 'int', 1000, 200000), ('commitPartitionSliceLen', 'int', 50, 2000),
  ('queryTimeout', 'duration', 1000, 10000), ('acquireWorkerTimeoutCircuitBreaker', 'duration', 15000, 900000),
  ('workerShardsCount', 'power_of_two', 2, 64), ('rebalancePausePollingTimeout', 'duration', 10000, 600000),
  ('acquireCommitGuardTimeout', 'duration', 100, 30000)) AS t(key, kind, lo, hi)"""

_IN_TOPICS = "SELECT * REPLACE (CASE WHEN part % 3 = 2 THEN 'clicks' ELSE topic END AS topic) FROM {}"
TABLES["topic_work"] = _IN_TOPICS.format("deliveries")
TABLES["topic_attempts"] = _IN_TOPICS.format("attempts")
TABLES["topic_assignments"] = _IN_TOPICS.format("assignments")
TABLES["commits"] = f"""
SELECT topic, part, (reached + 21599999999) // 21600000000 * 21600000000 AS committed_us, max(off) AS committed_offset
FROM (SELECT *, max(coalesce(done_us, {NEVER})) OVER (PARTITION BY topic, part ORDER BY off) AS reached
  FROM (SELECT topic, part, off, min(done_us) AS done_us FROM topic_work GROUP BY ALL))
WHERE reached < {NEVER} GROUP BY ALL"""

# Which tables each one is built from.
NEEDS = {
    "topic_work": ["deliveries"],
    "topic_attempts": ["attempts"],
    "topic_assignments": ["assignments"],
    "commits": ["topic_work"],
    "log": [],
    "records": ["log"],
    "processed": ["records"],
    "attempts": ["processed"],
    "deliveries": ["attempts"],
    "collapsed": ["deliveries"],
    "assignments": ["records"],
    "packets": ["deliveries"],
    "fetch_log": ["records"],
    "bw_entries": ["records"],
    "bw_partitions": ["bw_entries"],
    "bw_packets": ["bw_partitions"],
    "snap_parts": ["records"],
    "snaps": ["snap_parts"],
    "service_config": [],
    "timeout_config": [],
    "config": ["service_config", "timeout_config"],
    "rules": [],
}

QUERIES: dict[str, tuple[list[str], str]] = {}


def sql(name: str, tables: str, text: str) -> None:
    QUERIES[name] = (tables.split(), text.strip())


def _with(tables: list[str], text: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for t in tables:
        add(t)
    if not wanted:
        return text
    recursive = "RECURSIVE " if text.startswith("RECURSIVE") else ""
    text = text.removeprefix("RECURSIVE").strip()
    ctes = ",\n".join(f"{t} AS ({TABLES[t].strip()})" for t in wanted)
    if text.startswith(","):
        return f"WITH {recursive}{ctes}{text}"
    return f"WITH {recursive}{ctes}\n{text}"


def oracle_sql() -> dict[str, str]:
    return {name: _with(tables, text) for name, (tables, text) in QUERIES.items()}


# ---- envelope, headers, traits, text -------------------------------------------------------------------------------

sql(
    "order_events",
    "",
    """
SELECT number, key, '{"orderId":"' || key || '","customerId":"' || ['north-1','north-2','south-1','west-7','east-3'][number % 5 + 1]
  || '","sku":"' || ['kettle','lamp','rope','shelf','spoon'][(number // 5) % 5 + 1]
  || '","quantity":' || (number % 5 + 1) || ',"unitPriceCents":' || (999 + (number % 50) * 10)
  || ',"currency":"GBP","placedAt":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS value
FROM (SELECT o_orderkey AS number, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 32) AS key, o_orderdate FROM orders)""",
)
sql(
    "envelope",
    "records",
    """
SELECT topic, part AS "partition", off AS "offset", hex(key) AS key_hex, hex(value) AS value_hex, ts_kind, ts_millis, key_str, key_source
FROM records""",
)
sql("decode_timestamp", "records", 'SELECT off AS "offset", ts_kind, ts_millis, ts_millis AS event_ms FROM records')
sql("normalise_key", "records", 'SELECT off AS "offset", key_str, key_source FROM records')
sql("value_text", "records", 'SELECT off AS "offset", value_text, TRY(decode(key)) AS key_as_text FROM records')
sql(
    "lossy_text",
    "records",
    """
SELECT off AS "offset", CASE WHEN key_source = 'base64' THEN chr(65533) || chr(65533) WHEN key IS NOT NULL THEN decode(key) END AS key_text
FROM records""",
)
sql(
    "truncate_utf8",
    "",
    """
SELECT doc_id,
  left(text, list_max(list_filter(range(0, least(length(text), 1024) + 1), lambda k: octet_length(encode(left(text, k))) <= 1024))) AS head,
  left(text, list_max(list_filter(range(0, least(length(text), 7) + 1), lambda k: octet_length(encode(left(text, k))) <= 7))) AS head7
FROM documents""",
)
sql(
    "payload_kind",
    "records",
    """
SELECT CASE WHEN value IS NULL THEN 'tombstone' WHEN octet_length(value) = 0 THEN 'empty' ELSE 'present' END AS kind, count(*) AS n
FROM records GROUP BY 1""",
)
sql("header_count", "records", 'SELECT off AS "offset", CAST(len(headers) AS INT) AS headers FROM records')
sql(
    "header_at",
    "records",
    """
SELECT off AS "offset", headers[1].key AS key0, hex(headers[1].value) AS value0, headers[3].key AS key2, hex(headers[3].value) AS value2,
  headers[4].key AS key3, hex(headers[4].value) AS value3 FROM records""",
)
sql(
    "header_find",
    "records",
    """
SELECT off AS "offset", len(list_filter(headers, lambda h: h.key = 'trace')) > 0 AS has_trace,
  hex(list_filter(headers, lambda h: h.key = 'trace')[1].value) AS trace,
  decode(list_filter(headers, lambda h: h.key = 'kind')[1].value) AS kind,
  len(list_filter(headers, lambda h: h.key = 'absent')) > 0 AS has_absent
FROM records""",
)
sql(
    "explode_headers",
    "records",
    """
SELECT off AS "offset", CAST(pos AS INT) AS header_pos, headers[pos + 1].key AS header_key, hex(headers[pos + 1].value) AS header_value
FROM (SELECT off, headers, unnest(range(0, len(headers))) AS pos FROM records)""",
)
sql(
    "trait_bits",
    "records",
    """
SELECT off AS "offset", CAST(1024 + 4611686018427387904 + CASE WHEN cents > 5000 THEN 35184372088832 ELSE 0 END AS BIGINT) AS traits
FROM records""",
)
sql(
    "decode_traits",
    "packets",
    """
SELECT part AS "partition", off AS "offset", process_start_time_ns, traits & 1 > 0 AS has_process_error, traits & 2 > 0 AS has_process_panic,
  traits & 4 > 0 AS has_dead_letter, traits & 8 > 0 AS has_commit_buffered, traits & 16 > 0 AS has_duplicate,
  traits & 32 > 0 AS has_used_overflow, traits & 64 > 0 AS has_orphaned, traits & 128 > 0 AS has_first_after_rebalance,
  traits - traits % 1024 AS app_bits FROM packets""",
)
_BITS = """SELECT * FROM (VALUES (0,'process_error'),(1,'process_panic'),(2,'dead_letter'),(3,'commit_buffered'),(4,'duplicate'),
  (5,'used_overflow'),(6,'orphaned'),(7,'first_after_rebalance'),(10,'validated'),(11,'high_value'),(12,'purchase')) AS b(bit, trait)"""
sql(
    "explode_traits",
    "packets",
    f"""
SELECT off AS "offset", process_start_time_ns, bit, trait FROM packets JOIN ({_BITS}) ON (traits >> bit) & 1 = 1""",
)
sql(
    "trait_counts",
    "packets",
    f"SELECT bit, trait, count(*) AS n FROM packets JOIN ({_BITS}) ON (traits >> bit) & 1 = 1 GROUP BY ALL",
)
sql(
    "parse_json",
    "records",
    """
SELECT off AS "offset", CASE WHEN json_valid(value_text) THEN CAST(json_extract(value_text, '$.k') AS INT) END AS k,
  CASE WHEN value IS NULL THEN 'null payload' WHEN octet_length(value) = 0 THEN 'empty payload' WHEN NOT json_valid(value_text) THEN 'invalid JSON' END AS parse_error
FROM records""",
)
sql(
    "utc_millis_text",
    "records",
    """SELECT off AS "offset", strftime(make_timestamp(read_us), '%Y-%m-%dT%H:%M:%S.%gZ') AS read_at FROM records""",
)


def _duration(us: str) -> str:
    """Duration text of whole microseconds, with the fraction cut by trimming decimal text."""
    sec = f"rtrim(rtrim(printf('%d.%06d', ({us}) % 60000000 // 1000000, ({us}) % 1000000), '0'), '.') || 's'"
    mins = f"(({us}) % 3600000000 // 60000000) || 'm' || {sec}"
    return f"""CASE WHEN ({us}) = 0 THEN '0s' WHEN ({us}) < 1000 THEN ({us}) || 'µs'
      WHEN ({us}) < 1000000 THEN rtrim(rtrim(printf('%d.%03d', ({us}) // 1000, ({us}) % 1000), '0'), '.') || 'ms'
      WHEN ({us}) < 60000000 THEN {sec} WHEN ({us}) < 3600000000 THEN {mins}
      WHEN ({us}) >= 3600000000 THEN (({us}) // 3600000000) || 'h' || {mins} END"""


sql(
    "format_duration",
    "attempts",
    f"""SELECT off AS "offset", {_duration("done_us - start_us")} AS spent, {_duration("proc_us")} AS handler FROM attempts""",
)
sql("parse_duration", "attempts", 'SELECT off AS "offset", done_us - start_us AS spent_us FROM attempts')
_FNV = (
    "list_reduce(list_prepend(2166136261::BIGINT, list_transform(range(1, length(key_str) + 1), lambda i: ord(key_str[i])::BIGINT)), "
    "lambda h, c: (xor(h, c) * 16777619) & 4294967295)"
)
sql(
    "key_shard",
    "records",
    f"""SELECT off AS "offset", key_str, {_FNV} AS hash, CAST({_FNV} & 15 AS INT) AS shard FROM records""",
)

# ---- processing ----------------------------------------------------------------------------------------------------

sql(
    "require_equal",
    "",
    """
SELECT o_orderkey AS number, CASE WHEN o_orderkey % 100 = 7 THEN 'error' ELSE 'ok' END AS outcome,
  CASE WHEN o_orderkey % 100 = 7 THEN 'record key differs from order id' END AS error FROM orders""",
)
sql(
    "process_rules",
    "processed",
    'SELECT topic, part AS "partition", off AS "offset", outcome, error, app_traits FROM processed',
)
sql(
    "process_udf",
    "records",
    """
SELECT topic, part AS "partition", off AS "offset",
  CASE WHEN value IS NULL OR octet_length(value) = 0 THEN 'error' WHEN value_text = '{bad' THEN 'panic' ELSE 'ok' END AS outcome,
  CASE WHEN value IS NULL THEN 'record without a value' WHEN octet_length(value) = 0 THEN 'empty payload'
       WHEN value_text = '{bad' THEN 'panic in process callback' END AS error,
  CASE WHEN octet_length(value) > 0 AND value_text <> '{bad' THEN 1024::BIGINT ELSE 0::BIGINT END AS app_traits
FROM records""",
)
sql(
    "process_batches",
    "records",
    """
SELECT topic, part AS "partition", off AS "offset",
  CASE WHEN value_text = '{bad' AND off % 16 = 0 THEN 'panic' WHEN value IS NULL OR octet_length(value) = 0 OR value_text = '{bad' THEN 'error' ELSE 'ok' END AS outcome,
  CASE WHEN value IS NULL THEN 'record without a value' WHEN octet_length(value) = 0 THEN 'empty payload'
       WHEN value_text = '{bad' AND off % 16 = 0 THEN 'panic in process callback' WHEN value_text = '{bad' THEN 'malformed' END AS error,
  CASE WHEN octet_length(value) > 0 AND value_text <> '{bad' THEN 1024::BIGINT + 2048 * (cents > 5000)::BIGINT ELSE 0::BIGINT END AS app_traits
FROM records""",
)
sql(
    "no_traits_on_failure",
    "processed",
    "SELECT outcome, count(*) AS n, count(*) FILTER (WHERE app_traits <> 0) AS with_traits FROM processed GROUP BY outcome",
)
sql(
    "framework_traits",
    "attempts",
    """
SELECT topic, part AS "partition", off AS "offset", app_traits | CASE WHEN outcome <> 'ok' THEN 5 ELSE 0 END
  | CASE WHEN off % 41 = 0 THEN 32 ELSE 0 END AS traits FROM attempts""",
)
sql(
    "split_outcomes_ok",
    "processed",
    """SELECT topic, part AS "partition", off AS "offset", app_traits FROM processed WHERE outcome = 'ok'""",
)
sql(
    "split_outcomes_dead",
    "processed",
    """SELECT topic, part AS "partition", off AS "offset", error AS reason FROM processed WHERE outcome <> 'ok'""",
)
sql(
    "dead_letter_report",
    "processed",
    """
SELECT topic, part AS "partition", error AS reason, count(*) AS n, min(off) AS first_offset, max(off) AS last_offset
FROM processed WHERE outcome <> 'ok' GROUP BY ALL""",
)
sql(
    "replay_candidates",
    "processed",
    """SELECT topic, part AS "partition", off AS "offset", error AS reason FROM processed WHERE outcome <> 'ok' AND NOT cents > 2000""",
)
sql(
    "latest_by_key",
    "records",
    """
SELECT topic, key_str, part AS "partition", off AS "offset", hex(value) AS value_hex
FROM (SELECT *, row_number() OVER (PARTITION BY topic, key_str ORDER BY part DESC, off DESC) AS rn FROM records)
WHERE rn = 1 AND value IS NOT NULL""",
)

# ---- idempotent sinks ----------------------------------------------------------------------------------------------

_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_LINE_SHOWN = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _pick_line(source: str, order: str) -> str:
    return f"""
SELECT {_LINE_SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM {source})
WHERE rn = 1"""


sql(
    "insert_if_absent",
    "",
    _pick_line(
        """(SELECT * FROM lineitem n WHERE l_shipdate >= '1998-01-01' AND NOT EXISTS (SELECT 1 FROM lineitem t
      WHERE t.l_shipdate < '1998-01-01' AND t.l_orderkey = n.l_orderkey AND t.l_linenumber = n.l_linenumber))""",
        _LINE_ORDER,
    ),
)
sql("upsert_latest", "", _pick_line("lineitem", _LINE_ORDER.replace(",", " DESC,") + " DESC"))
_PART = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}, 'n')"
sql(
    "content_key",
    "",
    "SELECT doc_id, sha256("
    + " || '|' || ".join(_PART.format(c) for c in ("lang", "source", "text"))
    + ") AS content_key FROM documents",
)

# ---- ordering ------------------------------------------------------------------------------------------------------

sql(
    "process_by_key",
    "records",
    """
SELECT topic, key_str, off AS "offset", count(*) OVER w AS seen, CAST(sum(cents) OVER w AS BIGINT) AS running_cents FROM records
WINDOW w AS (PARTITION BY topic, key_str ORDER BY part, off)""",
)
sql(
    "key_sequence",
    "records",
    """
SELECT topic, part AS "partition", off AS "offset", key_str, row_number() OVER (PARTITION BY topic, key_str ORDER BY part, off) AS key_seq
FROM records""",
)
sql(
    "ordering_violations",
    "attempts",
    f"""
SELECT topic, part AS "partition", key_str, off AS "offset", attempt_no, start_us, previous_offset, previous_done_us,
  off < previous_offset AS inversion, coalesce(previous_done_us, {NEVER}) > start_us AS overlap
FROM (SELECT *, lag(off) OVER w AS previous_offset, lag(done_us) OVER w AS previous_done_us FROM attempts
  WINDOW w AS (PARTITION BY topic, part, key_str ORDER BY start_us, off, attempt_no))
WHERE previous_offset IS NOT NULL AND (off < previous_offset OR coalesce(previous_done_us, {NEVER}) > start_us)""",
)
sql(
    "shard_report",
    "records",
    f"""
SELECT shard, CAST(sum(n) AS BIGINT) AS records, count(*) AS keys, max(n) AS largest_key
FROM (SELECT CAST({_FNV} & 15 AS INT) AS shard, key_str, count(*) AS n FROM records GROUP BY ALL) GROUP BY shard""",
)
sql(
    "key_fanout",
    "records",
    'SELECT topic, part AS "partition", count(DISTINCT key_str) AS keys, count(*) AS records FROM records GROUP BY ALL',
)

# ---- delivery ------------------------------------------------------------------------------------------------------

_RUNMAX = f"""SELECT *, max(coalesce(done_us, {NEVER})) OVER (PARTITION BY topic, part ORDER BY off) AS reached"""


def _watermark(source: str) -> str:
    """Ready = the highest offset whose running maximum of completion times is finite."""
    return f"""
SELECT topic, part AS "partition", coalesce(max(off) FILTER (WHERE reached < {NEVER}), -1) AS highest_ready_offset,
  max(off) AS max_offset_seen, count(*) FILTER (WHERE done_us IS NOT NULL AND reached = {NEVER}) AS gap_buffer_depth
FROM ({_RUNMAX} FROM {source}) GROUP BY topic, part"""


sql("commit_watermark_read", "collapsed", _watermark("collapsed"))
sql(
    "commit_watermark_integer",
    "attempts",
    """
, dense AS (SELECT topic, CAST(off % 12 AS INT) AS part, off // 12 AS off, done_us FROM attempts),
seen AS (SELECT topic, part, min(off) AS low, max(off) AS high FROM dense GROUP BY ALL),
fin AS (SELECT d.topic, d.part, off, off - low = row_number() OVER (PARTITION BY d.topic, d.part ORDER BY off) - 1 AS in_run
  FROM dense d JOIN seen s USING (topic, part) WHERE done_us IS NOT NULL)
SELECT topic, part AS "partition", coalesce(max(off) FILTER (WHERE in_run), -1) AS highest_ready_offset, max(high) AS max_offset_seen,
  count(*) FILTER (WHERE NOT in_run) AS gap_buffer_depth
FROM seen LEFT JOIN fin USING (topic, part) GROUP BY topic, part""",
)
sql(
    "commit_buffered",
    "collapsed",
    f"""
SELECT topic, part AS "partition", off AS "offset", done_us FROM ({_RUNMAX} FROM collapsed) WHERE reached > done_us""",
)
sql(
    "watermark_advance",
    "collapsed",
    f"""
SELECT topic, part AS "partition", off AS "offset", read_us, start_us, done_us, coalesce(reached > done_us, false) AS commit_buffered,
  CASE WHEN reached < {NEVER} THEN reached END AS watermark_advance_us,
  CASE WHEN reached < {NEVER} THEN reached - read_us END AS end_to_end_us
FROM ({_RUNMAX} FROM collapsed)""",
)
sql(
    "flag_duplicates",
    "deliveries",
    """
SELECT topic, part AS "partition", off AS "offset", attempt_no,
  row_number() OVER (PARTITION BY topic, part, off ORDER BY read_us, attempt_no) > 1 AS duplicate FROM deliveries""",
)
sql(
    "drop_redeliveries",
    "deliveries",
    """
SELECT topic, part AS "partition", off AS "offset", attempt_no, read_us, key_str FROM (SELECT *,
  row_number() OVER (PARTITION BY topic, part, off ORDER BY read_us, attempt_no) AS rn FROM deliveries) WHERE rn = 1""",
)
sql(
    "dedupe_by_id",
    "",
    _pick_line(
        "(SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'))", _LINE_ORDER
    ),
)
_COMMITTED = f"(SELECT topic, part, max(off) FILTER (WHERE reached < {NEVER}) AS ready FROM ({_RUNMAX} FROM attempts) GROUP BY ALL)"
sql(
    "redelivery_set",
    "attempts",
    f"""
SELECT r.topic, r.part AS "partition", off AS "offset", key_str FROM attempts r LEFT JOIN {_COMMITTED} c USING (topic, part)
WHERE off > coalesce(ready, -1)""",
)
_SEEN = f"""
seen AS (SELECT topic, part, off, min(read_us) AS read_us, min(CASE WHEN done_us <= {STOP_US} THEN done_us END) AS done_us
  FROM deliveries WHERE read_us <= {STOP_US} GROUP BY ALL)"""
sql(
    "redelivered_work",
    "deliveries",
    f"""
,{_SEEN}, mark AS (SELECT topic, part, max(off) FILTER (WHERE reached < {NEVER}) AS ready FROM ({_RUNMAX} FROM seen) GROUP BY ALL)
SELECT s.topic, s.part AS "partition", off AS "offset", read_us, done_us IS NOT NULL AS was_done
FROM seen s LEFT JOIN mark USING (topic, part) WHERE off > coalesce(ready, -1)""",
)
sql(
    "drain_report",
    "attempts",
    f"""
SELECT topic, part AS "partition", CASE WHEN done_us <= {STOP_US} THEN 'finished' WHEN done_us <= {STOP_US} + 20000000000 THEN 'drained'
  ELSE 'abandoned' END AS fate, count(*) AS n FROM attempts WHERE read_us <= {STOP_US} GROUP BY ALL""",
)
sql(
    "flag_orphaned",
    "attempts assignments",
    f"""
SELECT a.topic, a.part AS "partition", off AS "offset", CAST(epoch AS INT) AS epoch, coalesce(coalesce(done_us, {NEVER}) > revoked_us, false) AS orphaned
FROM attempts a LEFT JOIN assignments s ON a.topic = s.topic AND a.part = s.part AND read_us >= assigned_us AND read_us < revoked_us
QUALIFY row_number() OVER (PARTITION BY a.topic, a.part, off, attempt_no ORDER BY assigned_us DESC) = 1""",
)
sql(
    "first_after_rebalance",
    "attempts assignments",
    """
SELECT topic, part AS "partition", off AS "offset", CAST(epoch AS INT) AS epoch, read_us FROM (
  SELECT a.topic, a.part, off, epoch, read_us, row_number() OVER (PARTITION BY a.topic, a.part, epoch ORDER BY read_us, off, attempt_no) AS rn
  FROM attempts a JOIN assignments s ON a.topic = s.topic AND a.part = s.part AND read_us >= assigned_us AND read_us < revoked_us
    AND NOT EXISTS (SELECT 1 FROM assignments o WHERE o.topic = s.topic AND o.part = s.part AND o.assigned_us > s.assigned_us
      AND read_us >= o.assigned_us AND read_us < o.revoked_us))
WHERE rn = 1""",
)
_LAG = f"""SELECT e.topic, e.part, coalesce(ready, -1) AS committed_offset, end_offset, greatest(end_offset - coalesce(ready, -1) - 1, 0) AS lag
FROM (SELECT topic, part, max(off) + 1 AS end_offset FROM attempts GROUP BY ALL) e LEFT JOIN {_COMMITTED} c USING (topic, part)"""
sql("lag_report", "attempts", f'SELECT topic, part AS "partition", committed_offset, end_offset, lag FROM ({_LAG})')
sql(
    "run_verdict",
    "deliveries",
    """
, r AS (SELECT topic, part, off, bool_or(done_us IS NOT NULL) AS done, bool_or(done_us IS NOT NULL AND outcome = 'ok') AS good
  FROM deliveries GROUP BY ALL),
t AS (SELECT count(*) AS records, count(*) FILTER (WHERE good) AS processed, count(*) FILTER (WHERE done AND NOT good) AS dead_lettered,
  count(*) FILTER (WHERE NOT done) AS unfinished FROM r)
SELECT *, processed >= 1000 AS reached_expected, dead_lettered = 0 AS no_dead_letters,
  processed >= 1000 AND dead_lettered = 0 AND unfinished = 0 AS success FROM t""",
)
sql(
    "duplicate_rate",
    "deliveries",
    """
SELECT topic, part AS "partition", count(*) AS deliveries, count(*) FILTER (WHERE rn = 1) AS records, count(*) FILTER (WHERE rn > 1) AS duplicates,
  count(*) FILTER (WHERE rn > 1) * 1000000 // count(*) AS duplicates_per_million
FROM (SELECT *, row_number() OVER (PARTITION BY topic, part, off ORDER BY read_us, attempt_no) AS rn FROM deliveries) GROUP BY ALL""",
)

# ---- metrics -------------------------------------------------------------------------------------------------------

_LABELS = 'topic, consumer_group, service, team, part AS "partition"'
_COUNTERS = """count(*) AS processed, count(*) FILTER (WHERE traits & 1 > 0) AS errored, count(*) FILTER (WHERE traits & 2 > 0) AS panicked,
  count(*) FILTER (WHERE traits & 4 > 0) AS dead_lettered, count(*) FILTER (WHERE traits & 16 > 0) AS duplicate,
  count(*) FILTER (WHERE traits & 32 > 0) AS used_overflow"""
sql("message_counters", "packets", f"SELECT {_LABELS}, {_COUNTERS} FROM packets GROUP BY topic, consumer_group, service, team, part")
sql(
    "message_gauges",
    "packets",
    f"""
SELECT {_LABELS}, queue_depth, off AS current_offset FROM (SELECT *, row_number() OVER (PARTITION BY topic, consumer_group, service, team, part
  ORDER BY process_start_time_ns DESC, off DESC) AS rn FROM packets) WHERE rn = 1""",
)
_WAIT = (
    "CASE WHEN read_time_ns <> 0 AND process_start_time_ns <> 0 THEN process_start_time_ns - read_time_ns END"
)


def _label(ns: int) -> str:
    whole, fraction = divmod(ns, 10**9)
    return f"{whole}." + (f"{fraction:09d}".rstrip("0") or "0")


def _histogram(value: str, start: int, count: int) -> str:
    bounds = ", ".join(f"({k}, '{_label(start * 2**k)}', {start * 2**k}::BIGINT)" for k in range(count))
    return f"""
, v AS (SELECT topic, consumer_group, service, team, part, {value} AS ns FROM packets),
seen AS (SELECT * FROM v WHERE ns > 0),
bounds AS (SELECT * FROM (VALUES {bounds}, ({count}, '+Inf', {NEVER}::BIGINT)) AS b(bucket, le, bound))
SELECT {_LABELS}, bucket, le, count(*) FILTER (WHERE ns <= bound) AS cumulative, CAST(sum(ns) AS BIGINT) AS sum_ns, count(*) AS observations
FROM seen, bounds GROUP BY topic, consumer_group, service, team, part, bucket, le"""


sql("process_histogram", "packets", _histogram("process_duration_ns", 1_000_000, 15))
sql("dead_letter_histogram", "packets", _histogram("deadletter_duration_ns", 1_000_000, 15))
sql("queue_wait_histogram", "packets", _histogram(_WAIT, 100_000, 18))
sql(
    "queue_depth",
    "attempts",
    """
SELECT topic, part AS "partition", at_us, CAST(sum(sum(d)) OVER (PARTITION BY topic, part ORDER BY at_us) AS BIGINT) AS queue_depth
FROM (SELECT topic, part, read_us AS at_us, 1 AS d FROM attempts UNION ALL
      SELECT topic, part, done_us, -1 FROM attempts WHERE done_us IS NOT NULL) GROUP BY topic, part, at_us""",
)
_SWEEP = """
, ch AS (SELECT topic, key_str, at_us, sum(d) AS d FROM (SELECT topic, key_str, start_us AS at_us, 1 AS d FROM attempts UNION ALL
    SELECT topic, key_str, done_us, -1 FROM attempts WHERE done_us IS NOT NULL) GROUP BY ALL),
dp AS (SELECT *, sum(d) OVER (PARTITION BY topic, key_str ORDER BY at_us) AS depth FROM ch),
st AS (SELECT topic, at_us, sum(CASE WHEN depth > 0 AND depth - d <= 0 THEN 1 ELSE -1 END) AS change FROM dp
  WHERE (depth > 0) <> (depth - d > 0) GROUP BY ALL),
sw AS (SELECT topic, at_us, sum(change) OVER (PARTITION BY topic ORDER BY at_us) AS n,
  lead(at_us) OVER (PARTITION BY topic ORDER BY at_us) AS next_us FROM st)"""
sql(
    "inflight_keys",
    "attempts",
    _SWEEP
    + """
, ov AS (SELECT *, lag(n, 1, 0) OVER (PARTITION BY topic ORDER BY at_us) AS before FROM sw)
SELECT topic, CAST(max(n) AS BIGINT) AS peak_keys, CAST(coalesce(sum(CASE WHEN n > 20 THEN next_us - at_us END), 0) AS BIGINT) AS over_limit_us,
  count(*) FILTER (WHERE n > 20 AND before <= 20) AS times_over_limit FROM ov GROUP BY topic""",
)
sql(
    "flag_overflow",
    "attempts",
    _SWEEP
    + """
SELECT a.topic, a.part AS "partition", a.off AS "offset", coalesce(sw.n > 15, false) AS used_overflow
FROM attempts a ASOF LEFT JOIN sw ON a.topic = sw.topic AND a.start_us >= sw.at_us""",
)


def _long() -> str:
    labels = "topic, consumer_group, service, team, part"
    rows = [
        f"SELECT '{name}_total' AS metric, 'counter' AS type, {labels}, NULL::VARCHAR AS le, 0 AS sort, count(*) AS value, 0 AS scale FROM v WHERE {cond} GROUP BY ALL"
        for name, cond in (
            ("processed", "true"),
            ("errored", "traits & 1 > 0"),
            ("panicked", "traits & 2 > 0"),
            ("dead_lettered", "traits & 4 > 0"),
            ("duplicate", "traits & 16 > 0"),
            ("used_overflow", "traits & 32 > 0"),
        )
    ]
    rows += [
        f"SELECT '{name}', 'gauge', {labels}, NULL, 0, arg_max({col}, (process_start_time_ns, off)), 0 FROM v GROUP BY ALL"
        for name, col in (("queue_depth", "queue_depth"), ("current_offset", "off"))
    ]
    for name, col, start, n in (
        ("process_duration_seconds", "process_duration_ns", 1_000_000, 15),
        ("dead_letter_duration_seconds", "deadletter_duration_ns", 1_000_000, 15),
        ("queue_wait_duration_seconds", "wait_ns", 100_000, 18),
    ):
        rows.append(f"SELECT '{name}_sum', 'histogram', {labels}, NULL, 0, CAST(sum({col}) AS BIGINT), 9 FROM v WHERE {col} > 0 GROUP BY ALL")
        rows.append(f"SELECT '{name}_count', 'histogram', {labels}, NULL, 1, count(*), 0 FROM v WHERE {col} > 0 GROUP BY ALL")
        bounds = ", ".join(f"({k}, '{_label(start * 2**k)}', {start * 2**k}::BIGINT)" for k in range(n))
        rows.append(
            f"SELECT '{name}_bucket', 'histogram', {labels}, le, 2 + k, count(*) FILTER (WHERE {col} <= bound), 0 FROM v, "
            f"(VALUES {bounds}, ({n}, '+Inf', {NEVER}::BIGINT)) AS b(k, le, bound) WHERE {col} > 0 GROUP BY {labels}, k, le"
        )
    return f", v AS (SELECT *, {_WAIT} AS wait_ns FROM packets),\nlong AS (" + "\nUNION ALL\n".join(rows) + ")"


_GROUP = "topic, consumer_group, service, team"
_BROKERS = """SELECT DISTINCT topic, consumer_group, service, team, b.id AS broker_id, b.host AS broker_host
FROM (SELECT topic, consumer_group, service, team, unnest([{'id': '1', 'host': 'h1'}, {'id': '2', 'host': 'h2-' || (seq % 3)}]
  || CASE WHEN seq % 4 = 0 THEN [{'id': '3', 'host': 'h3'}] ELSE [] END) AS b FROM bw_packets)"""


def _bandwidth_long() -> str:
    """metric, type, labels, extra, value, scale of the bandwidth families."""
    rows = [
        f"SELECT '{name}_total' AS metric, 'counter' AS type, {_GROUP}, id AS part, '' AS extra, CAST(sum({col}) AS BIGINT) AS value, 0 AS scale "
        f"FROM bw_partitions WHERE {col} > 0 GROUP BY ALL"
        for name, col in (("received_bytes", "received_bytes"), ("transmitted_bytes", "transmitted_bytes"), ("received_messages", "messages"))
    ]
    rows += [
        f"""SELECT '{col}_total', 'counter', {_GROUP}, id, 'compression="' || compression || '"', CAST(sum({col}) AS BIGINT), 0
FROM bw_partitions WHERE {col} > 0 GROUP BY {_GROUP}, id, compression"""
        for col in ("compressed_bytes", "uncompressed_bytes")
    ]
    for name, value, scale, when in (
        ("broker_count", "arg_max(brokers, seq)", 0, "true"),
        ("partition_count", "arg_max(partitions, seq)", 0, "true"),
        ("stats_interval_seconds", "arg_max(stats_interval_ms, seq) * 1000000", 9, "true"),
        ("last_collection_timestamp_seconds", "arg_max(ts_unix_ns // 1000000000, seq)", 0, "ts_unix_ns <> 0"),
    ):
        rows.append(f"SELECT '{name}', 'gauge', {_GROUP}, NULL, '', CAST({value} AS BIGINT), {scale} FROM bw_packets WHERE {when} GROUP BY {_GROUP}")
    rows.append(
        f"""SELECT 'broker_info', 'gauge', {_GROUP}, NULL, 'broker_id="' || broker_id || '",broker_host="' || broker_host
  || '",broker_port="9092",broker_rack="r' || broker_id || '"', 1, 0 FROM ({_BROKERS})"""
    )
    return ",\nbw AS (" + "\nUNION ALL\n".join(rows) + ")"


_ALL_SERIES = """,
every AS (SELECT 'engine' AS subsystem, metric, type, topic, consumer_group, service, team, part, '' AS extra, le, sort, value, scale FROM long
UNION ALL SELECT 'bandwidth', metric, type, topic, consumer_group, service, team, part, extra, NULL, 0, value, scale FROM bw)"""
sql(
    "metrics_long",
    "packets bw_partitions bw_packets",
    _long()
    + _bandwidth_long()
    + _ALL_SERIES
    + """
SELECT subsystem, metric, type, topic, consumer_group, service, team, part AS "partition", extra, le, sort, value, scale FROM every""",
)
sql(
    "exposition",
    "packets bw_partitions bw_packets",
    _long()
    + _bandwidth_long()
    + _ALL_SERIES
    + r"""
, txt AS (SELECT *, CASE type WHEN 'gauge' THEN metric WHEN 'counter' THEN regexp_replace(metric, '_total$', '')
    ELSE regexp_replace(metric, '_(sum|count|bucket)$', '') END AS family,
  CASE WHEN scale = 0 THEN CAST(value AS VARCHAR) ELSE regexp_replace(rtrim(printf('%d.%09d', value // 1000000000, value % 1000000000), '0'), '\.$', '.0') END AS shown
  FROM every)
SELECT 'keyflow_' || subsystem || '_' || metric || '{' || CASE WHEN le IS NOT NULL THEN 'le="' || le || '",' ELSE '' END || 'topic="' || topic
  || '",consumer_group="' || consumer_group || '",service="' || replace(service, '"', '\"') || '",team="' || team || '"'
  || CASE WHEN part IS NOT NULL THEN ',partition="' || part || '"' ELSE '' END || CASE WHEN extra <> '' THEN ',' || extra ELSE '' END || '} ' || shown AS line FROM txt
UNION ALL SELECT DISTINCT '# TYPE keyflow_' || subsystem || '_' || family || ' ' || type FROM txt
UNION ALL SELECT '# EOF'""",
)
sql(
    "failure_rates",
    "packets",
    f"""
SELECT topic, consumer_group, service, team, "partition", processed, errored * 1000000 // processed AS errored_per_million,
  dead_lettered * 1000000 // processed AS dead_lettered_per_million, duplicate * 1000000 // processed AS duplicate_per_million
FROM (SELECT {_LABELS}, {_COUNTERS} FROM packets GROUP BY topic, consumer_group, service, team, part)""",
)

# ---- bandwidth -----------------------------------------------------------------------------------------------------

sql(
    "bandwidth_counters",
    "bw_partitions",
    """
SELECT * FROM (SELECT topic, consumer_group, service, team, id AS "partition", CAST(sum(received_bytes) FILTER (WHERE received_bytes > 0) AS BIGINT) AS received_bytes,
  CAST(sum(transmitted_bytes) FILTER (WHERE transmitted_bytes > 0) AS BIGINT) AS transmitted_bytes,
  CAST(sum(messages) FILTER (WHERE messages > 0) AS BIGINT) AS received_messages
FROM bw_partitions GROUP BY topic, consumer_group, service, team, id)
WHERE received_bytes IS NOT NULL OR transmitted_bytes IS NOT NULL OR received_messages IS NOT NULL""",
)
sql(
    "bandwidth_compression",
    "bw_partitions",
    """
SELECT topic, consumer_group, service, team, id AS "partition", compression, CAST(sum(compressed_bytes) FILTER (WHERE compressed_bytes > 0) AS BIGINT) AS compressed_bytes,
  CAST(sum(uncompressed_bytes) FILTER (WHERE uncompressed_bytes > 0) AS BIGINT) AS uncompressed_bytes
FROM bw_partitions GROUP BY topic, consumer_group, service, team, id, compression""",
)
sql(
    "topology_gauges",
    "bw_packets",
    """
SELECT topic, consumer_group, service, team, CAST(arg_max(brokers, seq) AS BIGINT) AS broker_count, arg_max(partitions, seq) AS partition_count,
  arg_max(stats_interval_ms, seq) / 1000.0::DOUBLE AS stats_interval_seconds,
  arg_max(ts_unix_ns // 1000000000, seq) FILTER (WHERE ts_unix_ns <> 0) AS last_collection_timestamp_seconds
FROM bw_packets GROUP BY topic, consumer_group, service, team""",
)
sql(
    "broker_info",
    "bw_packets",
    """
SELECT DISTINCT topic, consumer_group, service, team, b.id AS broker_id, b.host AS broker_host, '9092' AS broker_port, 'r' || b.id AS broker_rack, 1 AS value
FROM (SELECT topic, consumer_group, service, team, unnest([{'id': '1', 'host': 'h1'}, {'id': '2', 'host': 'h2-' || (seq % 3)}]
  || CASE WHEN seq % 4 = 0 THEN [{'id': '3', 'host': 'h3'}] ELSE [] END) AS b FROM bw_packets)""",
)
sql(
    "bandwidth_from_records",
    "records",
    """
SELECT topic, part AS "partition", ts_millis // 3600000 * 3600000 AS interval_start_ms,
  CAST(sum(coalesce(octet_length(key), 0) + coalesce(octet_length(value), 0) + 5 + 5 + 4 + 2 + octet_length(encode(event_type))
    + CASE WHEN off % 5 <> 0 THEN 2 ELSE 0 END) AS BIGINT) AS received_bytes, count(*) AS received_message_count,
  0::BIGINT AS compressed_bytes, 0::BIGINT AS uncompressed_bytes, '' AS compression
FROM records WHERE ts_millis IS NOT NULL GROUP BY topic, part, ts_millis // 3600000""",
)

# ---- snapshot ------------------------------------------------------------------------------------------------------

_TEXT = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S.%gZ')"
_WIDTH = 2 * DAY_US
_BEGIN = END_US - 15 * _WIDTH
sql(
    "throughput_windows",
    "topic_work",
    f"""
SELECT s.topic, b AS bucket, {_TEXT.format(f"{_BEGIN} + b::BIGINT * {_WIDTH}")} AS from_time, {_TEXT.format(f"{_BEGIN} + (b::BIGINT + 1) * {_WIDTH}")} AS to_time,
  count(done_us) AS processed_count, count(done_us) FILTER (WHERE outcome <> 'ok') AS dead_letter_count
FROM (SELECT topic, unnest(range(15))::INT AS b FROM (SELECT DISTINCT topic FROM topic_work)) s
LEFT JOIN topic_work d ON d.topic = s.topic AND done_us >= {_BEGIN} + b::BIGINT * {_WIDTH} AND done_us < {_BEGIN} + (b::BIGINT + 1) * {_WIDTH}
GROUP BY s.topic, b""",
)
sql(
    "window_latency",
    "topic_work",
    f"""
, c AS (SELECT topic, part, off, min(read_us) AS read_us, min(CASE WHEN done_us <= {END_US} THEN done_us END) AS done_us
  FROM topic_work WHERE read_us <= {END_US} GROUP BY ALL),
w AS ({_RUNMAX} FROM c),
e AS (SELECT topic, CAST(sum(reached - read_us) // count(*) AS BIGINT) AS avg_us, max(reached - read_us) AS max_us, min(reached - read_us) AS min_us
  FROM w WHERE reached >= {_BEGIN} AND reached < {END_US} GROUP BY topic),
h AS (SELECT topic, CAST(sum(done_us - start_us) // count(*) AS BIGINT) AS avg_us, max(done_us - start_us) AS max_us
  FROM topic_work WHERE done_us >= {_BEGIN} AND done_us < {END_US} GROUP BY topic)
SELECT t.topic, h.avg_us AS avg_process_us, h.max_us AS max_process_us, e.avg_us AS avg_end_to_end_us, e.max_us AS max_end_to_end_us, e.min_us AS min_end_to_end_us
FROM (SELECT DISTINCT topic FROM topic_work) t LEFT JOIN h USING (topic) LEFT JOIN e USING (topic)""",
)
_ASSIGNED = """SELECT topic, part, epoch, assigned_us, revoked_us > {0} AS assigned FROM (SELECT *, row_number() OVER
  (PARTITION BY topic, part ORDER BY assigned_us DESC) AS rn FROM topic_assignments WHERE assigned_us <= {0}) WHERE rn = 1"""
sql(
    "summary",
    "topic_work topic_assignments",
    f"""
, a AS (SELECT topic, count(*) FILTER (WHERE assigned) AS n, max(assigned_us) AS last_us FROM ({_ASSIGNED.format(STOP_US)}) GROUP BY topic),
d AS (SELECT topic, count(*) AS n, count(*) FILTER (WHERE outcome <> 'ok') AS dead FROM topic_work WHERE done_us <= {STOP_US} GROUP BY topic)
SELECT coalesce(a.topic, d.topic) AS topic_name, coalesce(a.n, 0) AS assigned_partition_count, coalesce(d.n, 0) AS total_processed,
  coalesce(d.dead, 0) AS total_dead_lettered, {_TEXT.format("last_us")} AS last_rebalance_time
FROM a FULL JOIN d ON a.topic = d.topic""",
)
sql("commit_log", "commits", 'SELECT topic, part AS "partition", committed_us, committed_offset FROM commits')
_OFFSETS = """
,{seen}, a AS ({assigned}), m AS ({marks}),
k AS (SELECT topic, part, max(committed_offset) AS committed_offset FROM commits WHERE committed_us <= {until} GROUP BY topic, part),
every AS (SELECT topic, "partition" AS part FROM m UNION SELECT topic, part FROM a UNION SELECT topic, part FROM k)
SELECT every.topic, every.part AS "partition", coalesce(committed_offset, -1) AS committed_offset,
  coalesce(highest_ready_offset, -1) AS highest_ready_offset, coalesce(max_offset_seen, -1) AS max_offset_seen,
  coalesce(gap_buffer_depth, 0) AS gap_buffer_depth, coalesce(assigned, false) AS assigned
FROM every LEFT JOIN m ON m.topic = every.topic AND m."partition" = every.part
LEFT JOIN a ON a.topic = every.topic AND a.part = every.part LEFT JOIN k ON k.topic = every.topic AND k.part = every.part"""
_TOPIC_SEEN = _SEEN.replace("deliveries", "topic_work")


def _offsets(until: int) -> str:
    return _OFFSETS.format(seen=_TOPIC_SEEN, assigned=_ASSIGNED.format(STOP_US), marks=_watermark("seen"), until=until).strip()


sql("partition_offsets", "topic_work topic_assignments commits", _offsets(STOP_US - DAY_US // 2))
_ACTIVE = f"SELECT DISTINCT topic, key_str FROM topic_attempts WHERE start_us <= {STOP_US} AND coalesce(done_us, {NEVER}) > {STOP_US}"
sql(
    "concurrency",
    "topic_attempts",
    f"""
SELECT topic, least(n, 5) AS guard_active, 5::BIGINT AS guard_capacity, greatest(n - 5, 0) AS overflow_active, 0::BIGINT AS overflow_capacity,
  0::BIGINT AS commit_ingest_active, 0::BIGINT AS commit_ingest_capacity
FROM (SELECT t.topic, count(k.key_str) AS n FROM (SELECT DISTINCT topic FROM topic_attempts) t LEFT JOIN ({_ACTIVE}) k ON t.topic = k.topic GROUP BY t.topic)""",
)
sql(
    "shards",
    "topic_attempts",
    f"""
SELECT s.topic, s.n AS shard, count(key_str) AS active_workers, 0::BIGINT AS pooled_workers
FROM (SELECT topic, unnest(range(16))::INT AS n FROM (SELECT DISTINCT topic FROM topic_attempts)) s
LEFT JOIN (SELECT topic, key_str, CAST({_FNV} & 15 AS INT) AS shard FROM ({_ACTIVE})) k ON s.n = k.shard AND s.topic = k.topic GROUP BY s.topic, s.n""",
)
_GOOD = "pick NOT IN (2, 3, 5)"
sql(
    "parse_snapshots",
    "snaps",
    f"""
SELECT snap_id, CASE pick WHEN 2 THEN 'malformed document' WHEN 3 THEN 'missing field: summary' WHEN 5 THEN 'missing field: throughput.totalDeadLettered' END AS error,
  CASE WHEN {_GOOD} THEN total END AS total_processed, CASE WHEN {_GOOD} THEN '4m5s' END AS max_end_to_end,
  CASE WHEN {_GOOD} THEN parts::INT END AS partitions FROM snaps""",
)
sql(
    "snapshot_partitions",
    "snap_parts",
    """
SELECT snap_id, part AS "partition", lo AS committed_offset, lo AS highest_ready_offset, hi AS max_offset_seen, n - 1 AS gap_buffer_depth,
  part % 2 = 0 AS assigned FROM snap_parts WHERE snap_id % 6 NOT IN (2, 3, 5)""",
)
sql(
    "snapshot_windows",
    "snaps",
    f"""
SELECT snap_id, 'a' AS from_time, 'b' AS to_time, total AS processed_count, 0::BIGINT AS dead_letter_count FROM snaps WHERE {_GOOD}
UNION ALL SELECT snap_id, 'b', 'c', 0, 1 FROM snaps WHERE {_GOOD}""",
)

# ---- operations ----------------------------------------------------------------------------------------------------

sql(
    "sustained_failures",
    "fetch_log",
    """
, r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY topic, part ORDER BY at_us, seq) AS run FROM fetch_log)
SELECT topic, part AS "partition", min(at_us) AS first_us, max(at_us) AS last_us, count(*) AS failures, arg_max(err, (at_us, seq)) AS err,
  'partition ' || topic || '[' || part || '] failing to fetch for 10m0s: ' || arg_max(err, (at_us, seq)) AS reason
FROM r WHERE NOT ok GROUP BY topic, part, run HAVING max(at_us) - min(at_us) >= 600000000""",
)
sql(
    "throttle",
    "",
    """
WITH RECURSIVE l AS (SELECT event_type AS logger, CAST(event_id % 5 AS INT) AS level, epoch_us(ts) AS at_us FROM events),
k AS (SELECT logger, level, min(at_us) AS at_us FROM l GROUP BY logger, level
  UNION ALL
  SELECT k.logger, k.level, min(l.at_us) FROM k JOIN l ON l.logger = k.logger AND l.level = k.level AND l.at_us >= k.at_us + 3600000000
  GROUP BY k.logger, k.level)
SELECT k.logger, k.level, k.at_us, count(*) - 1 AS suppressed FROM l ASOF JOIN k ON l.logger = k.logger AND l.level = k.level AND l.at_us >= k.at_us
GROUP BY ALL""",
)
sql("throttle_busy_key", "", QUERIES["throttle"][1])
sql(
    "throttle_tumbling",
    "",
    """
SELECT event_type AS logger, CAST(event_id % 5 AS INT) AS level, epoch_us(ts) // 3600000000 AS slot, min(epoch_us(ts)) AS at_us, count(*) AS n
FROM events GROUP BY 1, 2, 3""",
)
sql(
    "stalled_partitions",
    "attempts",
    f"""
, d AS (SELECT topic, part, max(done_us) AS last_done_us FROM attempts WHERE done_us <= {STOP_US} GROUP BY ALL), g AS ({_LAG})
SELECT topic, part AS "partition", lag, last_done_us, {STOP_US} - last_done_us AS quiet_us FROM g LEFT JOIN d USING (topic, part)
WHERE lag > 0 AND (last_done_us IS NULL OR {STOP_US} - last_done_us >= 600000000)""",
)
sql(
    "breaker_trips",
    "attempts",
    """
SELECT topic, part AS "partition", arg_min(off, (start_us, off, attempt_no)) AS first_offset, min(start_us) AS first_us,
  max(start_us - read_us) AS longest_wait_us, count(*) AS slow_dispatches FROM attempts WHERE start_us - read_us > 60000 GROUP BY topic, part""",
)
sql(
    "assignment_timeline",
    "assignments",
    """
SELECT topic, at_us, CAST(sum(d) AS BIGINT) AS change, CAST(sum(sum(d)) OVER (PARTITION BY topic ORDER BY at_us) AS BIGINT) AS assigned_partitions
FROM (SELECT topic, assigned_us AS at_us, 1 AS d FROM assignments UNION ALL SELECT topic, revoked_us, -1 FROM assignments) GROUP BY topic, at_us""",
)
sql(
    "assigned_at",
    "assignments",
    f"""
SELECT topic, part AS "partition", CAST(epoch AS INT) AS epoch, assigned_us, assigned
FROM ({_ASSIGNED.format(EPOCH_US + 20 * DAY_US + 5 * 3_600_000_000).replace("topic_assignments", "assignments")})""",
)
# Every duration in these tables is a whole number followed by ms or s, or plain 0.
_MS = """CASE WHEN regexp_full_match({0}, '[0-9]+ms') THEN CAST(replace({0}, 'ms', '') AS BIGINT)
  WHEN regexp_full_match({0}, '[0-9]+s') THEN CAST(replace({0}, 's', '') AS BIGINT) * 1000 WHEN {0} = '0' THEN 0 END"""
_INT = "CASE WHEN regexp_full_match({0}, '[0-9]+') THEN CAST({0} AS BIGINT) END"
sql(
    "config_violations",
    "config rules",
    f"""
, x AS (SELECT service, key, value, kind, lo, hi, CASE WHEN kind = 'duration' THEN {_MS.format("value")} ELSE {_INT.format("value")} END AS n
  FROM config JOIN rules USING (key)),
s AS (SELECT service, key, value, CASE WHEN n IS NULL AND kind = 'duration' THEN 'not a duration' WHEN n IS NULL THEN 'not an integer'
    WHEN n = 0 THEN NULL WHEN n < lo OR n > hi THEN 'out of range'
    WHEN kind = 'power_of_two' AND n NOT IN (2, 4, 8, 16, 32, 64) THEN 'not a power of two' END AS problem FROM x),
d AS (SELECT service, max({_MS.format("value")}) AS n FROM config WHERE key = 'drainTimeout' GROUP BY service),
b AS (SELECT service, max({_INT.format("value")}) AS n FROM config WHERE key = 'rebalance.timeout.ms' GROUP BY service),
p AS (SELECT coalesce(d.service, b.service) AS service, CASE WHEN coalesce(d.n, 0) = 0 THEN 20000 ELSE d.n END AS drain, coalesce(b.n, 60000) AS reb
  FROM d FULL JOIN b ON d.service = b.service)
SELECT * FROM s WHERE problem IS NOT NULL
UNION ALL SELECT service, key, value, 'not an integer' FROM config WHERE key = 'rebalance.timeout.ms' AND {_INT.format("value")} IS NULL
UNION ALL SELECT service, 'rebalance.timeout.ms', CAST(reb AS VARCHAR), 'must exceed the drain timeout of ' || drain || ' ms' FROM p WHERE reb <= drain""",
)
sql(
    "unknown_settings",
    "service_config rules",
    """
SELECT service, key, value FROM service_config WHERE key <> 'rebalance.timeout.ms' AND key NOT IN (SELECT key FROM rules)""",
)
sql(
    "stop_reasons",
    "",
    """
WITH c AS (SELECT 'svc-' || (o_custkey % 20) AS service, epoch_us(o_orderdate) AS at_us,
  ['graceful', 'breaker', 'poll failure', 'start-up', 'own reason', 'own reason'][o_orderkey % 6 + 1] AS class,
  CASE WHEN o_orderkey % 6 = 3 THEN CAST(-(o_orderkey % 8 + 1) AS INT) END AS code FROM orders)
SELECT service, class, code, CASE code WHEN -1 THEN 'already initialised' WHEN -2 THEN 'invalid configuration JSON'
  WHEN -3 THEN 'missing required config' WHEN -4 THEN 'failed to create adapter or connect to broker' WHEN -5 THEN 'invalid adapter or engine option'
  WHEN -6 THEN 'metrics endpoint failed to bind' END AS meaning, count(*) AS n, max(at_us) AS last_us
FROM c GROUP BY service, class, code""",
)
sql(
    "severity_counts",
    "",
    """
SELECT CAST(event_id % 5 AS INT) AS level, CASE event_id % 5 WHEN 1 THEN 'info' WHEN 2 THEN 'warn' WHEN 3 THEN 'error' ELSE 'unknown' END AS severity,
  count(*) AS n FROM events WHERE event_id % 5 >= 1 GROUP BY 1, 2""",
)

# ---- streams and the split fold must give what the plain batch query gives ------------------------------------------------

for _stream, _batch in (
    ("run_stream_ok", "split_outcomes_ok"),
    ("run_stream_dead", "split_outcomes_dead"),
    ("process_by_key_stream", "process_by_key"),
    ("fold_by_key", "process_by_key"),
):
    QUERIES[_stream] = QUERIES[_batch]
sql("commit_watermark_stream", "attempts", _watermark("attempts"))
sql(
    "stalled_partitions_stream",
    "attempts",
    """
, h AS (SELECT max(off) // 2 AS half FROM attempts),
f AS (SELECT topic, part, max(off) AS seen, min(off) FILTER (WHERE done_us IS NULL) AS first_open,
    min(off) FILTER (WHERE off < half AND (done_us IS NULL OR (part % 2 = 1 AND off % 7 = 3))) AS first_before
  FROM attempts, h GROUP BY topic, part)
SELECT topic, part AS "partition", first_open, coalesce(max(off) FILTER (WHERE off < first_open), -1) AS highest_ready_offset,
  max(seen) - coalesce(max(off) FILTER (WHERE off < first_open), -1) AS behind, count(*) FILTER (WHERE off > first_open AND done_us IS NOT NULL) AS held,
  CAST(1 AS BIGINT) AS batch_id
FROM attempts JOIN f USING (topic, part) WHERE first_open = first_before GROUP BY topic, part, first_open""",
)
sql(
    "message_metrics_stream",
    "packets",
    f"""
SELECT {_LABELS}, {_COUNTERS} FROM packets WHERE traits & 16 = 0 GROUP BY topic, consumer_group, service, team, part""",
)
sql("drop_redeliveries_stream", "records", 'SELECT topic, part AS "partition", off AS "offset", key_str FROM records')
sql("dedupe_by_id_stream", "records", "SELECT DISTINCT key_str, event_type FROM records")
sql("bandwidth_stream", "records", QUERIES["bandwidth_from_records"][1])
sql(
    "sustained_failures_stream",
    "fetch_log",
    """
, r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY topic, part ORDER BY at_us, seq) AS run FROM fetch_log),
f AS (SELECT *, min(at_us) OVER (PARTITION BY topic, part, run) AS first_us FROM r WHERE NOT ok)
SELECT topic, part AS "partition", first_us, min(at_us) AS reported_us, arg_min(err, (at_us, seq)) AS err
FROM f WHERE at_us - first_us >= 600000000 GROUP BY topic, part, run, first_us""",
)
sql("throttle_stream", "", QUERIES["throttle"][1].replace("k.at_us, count(*) - 1 AS suppressed", "k.at_us"))


# ---- the snapshot document: the sections above as text -------------------------------------------------------------


def _document() -> str:
    begin = STOP_US - 15 * _WIDTH

    def moved(name: str) -> str:
        """Text of a window query for the window that ends at the stop."""
        return QUERIES[name][1].replace(str(_BEGIN), str(begin)).replace(str(END_US), str(STOP_US))

    latency_tables, latency = moved("window_latency").split("\nSELECT t.topic", 1)
    offset_tables, offsets = _offsets(STOP_US).rsplit("\nSELECT every.topic", 1)
    summary_tables, summary_rows = QUERIES["summary"][1].split("\nSELECT", 1)
    summary_tables = summary_tables.replace(", a AS", "sa AS").replace("\nd AS", "\nsd AS")
    summary_rows = summary_rows.replace("a.", "sa.").replace("d.", "sd.").replace("FROM a FULL JOIN d", "FROM sa FULL JOIN sd")
    latency_tables = latency_tables.replace(", c AS", "lc AS").replace("FROM c)", "FROM lc)").replace("\nw AS", "\nlw AS").replace("FROM w ", "FROM lw ")
    active = _ACTIVE.replace("topic_attempts", "topic_work")
    window = """'{"fromTime":"' || from_time || '","toTime":"' || to_time || '","processedCount":' || processed_count
      || ',"deadLetterCount":' || dead_letter_count || '}'"""
    partition = """'{"partition":' || "partition" || ',"committedOffset":' || committed_offset || ',"highestReadyOffset":' || highest_ready_offset
      || ',"maxOffsetSeen":' || max_offset_seen || ',"gapBufferDepth":' || gap_buffer_depth || ',"assigned":' || assigned || '}'"""
    shard = """'{"shard":' || shard || ',"activeWorkers":' || active_workers || ',"pooledWorkers":0}'"""
    return f"""
{offset_tables},
{summary_tables},
{latency_tables},
po AS (SELECT every.topic{offsets}), su AS (SELECT{summary_rows}), la AS (SELECT t.topic{latency}), tw AS ({moved("throughput_windows")}),
sh AS ({QUERIES["shards"][1].replace("topic_attempts", "topic_work")}), ac AS (SELECT topic, count(*) AS n FROM ({active}) GROUP BY topic),
pj AS (SELECT topic, string_agg({partition}, ',' ORDER BY "partition") AS j FROM po GROUP BY topic),
wj AS (SELECT topic, string_agg({window}, ',' ORDER BY bucket) AS j FROM tw GROUP BY topic),
sj AS (SELECT topic, string_agg({shard}, ',' ORDER BY shard) AS j FROM sh GROUP BY topic)
SELECT topic_name AS topic, '{{"summary":{{"topicName":"' || topic_name || '","assignedPartitionCount":' || assigned_partition_count || ',"totalProcessed":' || total_processed
  || ',"lastRebalanceTime":"' || last_rebalance_time || '"}},"throughput":{{"windows":[' || wj.j
  || '],"totalProcessed":' || total_processed || ',"totalDeadLettered":' || total_dead_lettered
  || ',"avgProcessDuration":"' || {_duration("avg_process_us")} || '","maxProcessDuration":"' || {_duration("max_process_us")}
  || '","avgEndToEndDuration":"' || {_duration("avg_end_to_end_us")} || '","maxEndToEndDuration":"' || {_duration("max_end_to_end_us")}
  || '","minEndToEndDuration":"' || {_duration("min_end_to_end_us")} || '"}},"preCommits":{{"partitions":['
  || pj.j || ']}},"concurrency":{{"guardActive":' || least(coalesce(ac.n, 0), 250)
  || ',"guardCapacity":250,"overflowActive":' || greatest(coalesce(ac.n, 0) - 250, 0)
  || ',"overflowCapacity":0,"commitIngestActive":0,"commitIngestCapacity":0}},"shards":[' || sj.j || ']}}' AS doc
FROM su JOIN la ON la.topic = topic_name JOIN wj ON wj.topic = topic_name JOIN pj ON pj.topic = topic_name JOIN sj ON sj.topic = topic_name
LEFT JOIN ac ON ac.topic = topic_name"""


sql("snapshot_json", "topic_work topic_assignments commits", _document())
