"""The same answers as ANSI SQL for DuckDB, stated independently of the Spark plans."""

from __future__ import annotations

from tidelog.schema import PARTITION_KEY_HEADER, SEQUENCE_HEADER, SHARD_HEADER
from workload.queries import (
    CHECKPOINT_BEFORE,
    CUT,
    HOUR_MS,
    NOW_MS,
    OPENING_MS,
    OWNER,
    PINNED,
    READ_CAP,
    START_CASES,
)
from workload.tables import LEASE_TTL, TICK, WEDGED

_SHARD = "CASE WHEN user_id % 3 = 0 THEN 'shard-0' ELSE 'shard-' || (1 + user_id % 7) END"
_LONG = "event_id || repeat('0', 50)"
_WHITE_SPACE = (
    "concat(chr(9),chr(10),chr(11),chr(12),chr(13),chr(32),chr(133),chr(160),chr(5760),"
    + ",".join(f"chr({p})" for p in range(8192, 8203))
    + ",chr(8232),chr(8233),chr(8239),chr(8287),chr(12288))"
)
_MILLIS = "epoch_us(ts) // 1000"
_NUMBER = "CAST(regexp_extract(shard_id, '[0-9]+') AS BIGINT)"

# Blocks that queries are put together from, each a named table.
TABLES = {
    "records": f"""SELECT 'events' AS stream, {_SHARD} AS shard_id, event_id, user_id,
        {_LONG} AS sequence_number, 'u' || user_id AS partition_key,
        ts - to_hours(CAST((event_id * 7) % 11 AS INTEGER)) AS arrival_ts, event_type, props,
        event_id % 211 = 0 AS aggregated FROM events""",
    "deliveries": f"""SELECT stream, shard_id, event_id, sequence_number, arrival_ts,
        CASE WHEN event_type <> 'error' THEN 'ack'
             WHEN event_id % 97 = 0 AND shard_id IN ({", ".join(f"'{s}'" for s in WEDGED)})
             THEN 'nack_requeue' ELSE 'nack_skip' END AS outcome,
        outcome <> 'nack_requeue' AS done,
        event_id * {TICK} AS delivered_at,
        CASE WHEN outcome <> 'nack_requeue'
             THEN (event_id + (event_id * 7919) % 13) * {TICK} + event_id END AS settle_ord
        FROM records WHERE NOT aggregated""",
    "raw": f"""SELECT 'events' AS stream, {_SHARD} AS shard_id, event_id, user_id,
        {_LONG} AS sequence_number, 'u' || user_id AS partition_key, event_id % 12 AS kind,
        hex(props) AS body,
        CASE kind WHEN 1 THEN hex('x-tenant: t' || user_id || chr(10))
             WHEN 2 THEN hex('A:1' || chr(13) || chr(10) || 'B: ' || user_id || chr(13) || chr(10))
             WHEN 3 THEN hex('no colon' || chr(10) || 'A: b: c' || user_id || chr(10))
             WHEN 4 THEN hex('A: first' || chr(10) || 'B: x' || chr(10) || 'A: ' || user_id || chr(10))
             WHEN 5 THEN hex('A: ') || 'FF' || hex(user_id || chr(10))
             WHEN 8 THEN hex(chr(9) || ' A' || chr(160) || ':' || chr(8195) || ' ' || user_id || ' ' || chr(9))
             WHEN 10 THEN hex('partition-key: other' || chr(10) || '{SHARD_HEADER}: x' || chr(10)
                              || 'A: ' || user_id) END AS block,
        CASE WHEN block IS NOT NULL
             THEN '52534B31' || printf('%08X', length(block) // 2) || block || body
             WHEN kind = 0 THEN 'F3899AC2' || body WHEN kind = 9 THEN 'F3899AC2'
             WHEN kind = 6 THEN '52534B310000FFFF' || body WHEN kind = 7 THEN '52534B310000'
             ELSE body END AS data_hex,
        kind = 0 AS refused FROM events""",
    "unpacked": """SELECT *, CASE WHEN left(data_hex, 8) = '52534B31' AND length(data_hex) >= 16
        THEN CAST('0x' || substr(data_hex, 9, 8) AS BIGINT) END AS stated,
        coalesce(length(data_hex) // 2 >= 8 + stated, false) AS enveloped,
        CASE WHEN enveloped THEN substr(data_hex, 17 + 2 * stated) ELSE data_hex END AS payload_hex,
        decode(unhex(array_to_string(list_transform(range(CASE WHEN enveloped THEN stated ELSE 0 END),
            lambda i: CASE WHEN substr(data_hex, 17 + 2 * i, 2) = 'FF' THEN 'EFBFBD'
                      ELSE substr(data_hex, 17 + 2 * i, 2) END), ''))) AS block_text
        FROM raw""",
    "header_lines": f"""SELECT event_id, i, trim(split_part(line, ':', 1), {_WHITE_SPACE}) AS name,
        trim(substr(line, strpos(line, ':') + 1), {_WHITE_SPACE}) AS value
        FROM (SELECT event_id, unnest(string_split(block_text, chr(10))) AS line,
                     generate_subscripts(string_split(block_text, chr(10)), 1) AS i FROM unpacked)
        WHERE contains(line, ':')""",
    "own_headers": """SELECT event_id, name, arg_max(value, i) AS value FROM header_lines
        GROUP BY event_id, name""",
    "delivered_headers": f"""SELECT h.event_id, name, value FROM own_headers h JOIN raw USING (event_id)
        WHERE NOT refused
          AND name NOT IN ('{PARTITION_KEY_HEADER}', '{SEQUENCE_HEADER}', '{SHARD_HEADER}')
        UNION ALL SELECT event_id, '{PARTITION_KEY_HEADER}', partition_key FROM raw WHERE NOT refused
        UNION ALL SELECT event_id, '{SEQUENCE_HEADER}', sequence_number FROM raw
        WHERE NOT refused
        UNION ALL SELECT event_id, '{SHARD_HEADER}', shard_id FROM raw WHERE NOT refused""",
    "messages": """SELECT event_id, user_id, ts, props,
        CASE WHEN event_id % 3 <> 0 THEN 'x-tenant: t' || user_id || chr(10)
             || 'x-ev: ' || event_type || chr(10) ELSE '' END
        || CASE WHEN event_id % 7 = 0 THEN 'note:  at: ' || event_id || chr(9) || chr(10) ELSE '' END
        || CASE WHEN event_id % 11 = 0 THEN 'multi: x' || chr(10) || 'inj: ' || user_id || chr(10)
           ELSE '' END AS lines,
        CASE WHEN event_id % 2 = 0 THEN 'u' || user_id ELSE 'rs-w1-' || event_id END AS partition_key,
        CASE WHEN lines = '' THEN hex(props)
             ELSE '52534B31' || printf('%08X', strlen(lines)) || hex(lines) || hex(props) END AS data_hex
        FROM events""",
    "bodies": """SELECT stream, shard_id, event_id, sequence_number,
        CASE WHEN event_id % 13 = 0 THEN left(props, length(props) - 1)
             WHEN event_id % 17 = 0 THEN '{"j": 1}' WHEN event_id % 19 = 0 THEN '{"k": "x"}'
             WHEN event_id % 23 = 0 THEN 'plain' ELSE props END AS payload,
        CASE WHEN json_valid(payload)
             THEN TRY_CAST(json_extract(payload, '$.k') AS BIGINT) END AS k FROM records""",
    "seeks": f"""SELECT 'events' AS stream, event_id, event_id % 5 = 0 AS wide,
        CASE WHEN NOT wide THEN CASE WHEN user_id % 10 = 9 THEN 'shard-gone' ELSE {_SHARD} END END
            AS shard_id,
        event_id * {TICK} + {TICK // 2} AS "at",
        CASE WHEN NOT wide THEN 'sequence' WHEN event_id % 3 = 0 THEN 'horizon'
             WHEN event_id % 3 = 1 THEN 'latest' ELSE 'timestamp' END AS kind
        FROM events WHERE event_type = 'signup' AND (event_id * 31 + user_id) % 23 = 0""",
    "points": f"""SELECT stream, shard_id, CASE WHEN shard_id = 'shard-2' THEN 'SHARD_END'
        ELSE max(event_id) || repeat('0', 50) END AS checkpoint, max(event_id) AS upto FROM records
        WHERE event_type = 'signup' AND arrival_ts < TIMESTAMP '{CHECKPOINT_BEFORE}'
          AND shard_id <> 'shard-1' GROUP BY stream, shard_id""",
    "tips": f"""SELECT stream, shard_id, max(event_id) AS tip FROM records
        WHERE arrival_ts < TIMESTAMP '{CUT}' GROUP BY stream, shard_id""",
    "openings": f"""SELECT stream, shard_id, min(event_id) AS opening FROM records
        WHERE epoch_us(arrival_ts) // 1000 >= {OPENING_MS} GROUP BY stream, shard_id""",
    "wedges": """SELECT stream, shard_id, min(event_id) FILTER (WHERE NOT done) AS wedge
        FROM deliveries GROUP BY stream, shard_id""",
    "reached": """SELECT stream, shard_id,
        max(event_id) FILTER (WHERE wedge IS NULL OR event_id < wedge) AS upto,
        CASE WHEN upto IS NOT NULL THEN upto || repeat('0', 50) END AS checkpoint,
        bool_and(done) AS drained
        FROM deliveries JOIN wedges USING (stream, shard_id) GROUP BY stream, shard_id""",
    "released": """SELECT *, max(coalesce(settle_ord, 9223372036854775807)) OVER
        (PARTITION BY shard_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS released_at
        FROM deliveries""",
    "advances": """SELECT stream, shard_id, released_at AS settle_ord,
        max(event_id) || repeat('0', 50) AS checkpoint, count(*) AS released
        FROM released WHERE released_at < 9223372036854775807
        GROUP BY stream, shard_id, released_at""",
    "shards": """SELECT 'tree' AS stream, 'r' || r_regionkey AS shard_id,
        CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS adjacent_parent_id,
        r_regionkey <> 3 AS closed FROM region WHERE r_regionkey <> 4
        UNION ALL SELECT 'tree', 'n' || n_nationkey, 'r' || n_regionkey,
        CASE WHEN n_nationkey % 3 = 0 THEN 'r' || ((n_regionkey + 1) % 5) END, n_nationkey % 4 <> 1
        FROM nation
        UNION ALL SELECT 'tree', 'c' || c_custkey, 'n' || c_nationkey,
        CASE WHEN c_custkey % 5 = 0 THEN 'n' || ((c_nationkey + 1) % 25) END, c_custkey % 2 = 0
        FROM customer
        UNION ALL SELECT 'tree', 'o' || o_orderkey, 'c' || o_custkey,
        CASE WHEN o_orderkey % 6 = 0 THEN 'r' || (o_orderkey % 5) END, o_orderkey % 10 = 0
        FROM orders""",
    "checkpoints": f"""SELECT stream, shard_id,
        CASE WHEN closed AND {_NUMBER} % 2 = 0 THEN 'SHARD_END' ELSE {_NUMBER} || '5' END AS checkpoint
        FROM shards WHERE {_NUMBER} % 3 <> 1""",
    "edges": """SELECT stream, shard_id, parent_id FROM shards WHERE parent_id IS NOT NULL
        UNION SELECT stream, shard_id, adjacent_parent_id FROM shards
        WHERE adjacent_parent_id IS NOT NULL""",
    "tip_blocked": """SELECT DISTINCT e.shard_id FROM edges e JOIN shards p ON p.shard_id = e.parent_id
        LEFT JOIN checkpoints k ON k.shard_id = e.parent_id
        WHERE NOT (coalesce(k.checkpoint, '') = 'SHARD_END' OR (k.checkpoint IS NULL AND p.closed))""",
    "horizon_blocked": """SELECT DISTINCT e.shard_id FROM edges e
        JOIN shards p ON p.shard_id = e.parent_id
        LEFT JOIN checkpoints k ON k.shard_id = e.parent_id
        WHERE coalesce(k.checkpoint, '') <> 'SHARD_END'""",
    "generations": """SELECT shard_id, 0 AS depth FROM shards UNION
        SELECT e.shard_id, g.depth + 1 FROM generations g JOIN edges e ON e.parent_id = g.shard_id""",
    "depths": "SELECT shard_id, CAST(max(depth) AS BIGINT) AS depth FROM generations GROUP BY shard_id",
    "resharded": """SELECT event_id, 'u' || user_id AS partition_key,
        CASE (event_id * 13) % 4 WHEN 0 THEN 'r' || (user_id % 4) WHEN 1 THEN 'n' || (user_id % 25)
             WHEN 2 THEN 'c' || user_id ELSE 'o' || user_id END AS shard_id FROM events""",
    "stamped": """SELECT d.*,
        (SELECT count(*) FROM seeks s WHERE s."at" <= d.delivered_at
          AND (s.wide OR s.shard_id = d.shard_id)) AS epoch,
        (SELECT count(*) FROM seeks s WHERE s."at" <= d.settle_ord
          AND (s.wide OR s.shard_id = d.shard_id)) AS settle_epoch FROM deliveries d""",
    "live": """SELECT *, settle_ord IS NOT NULL AND epoch <> settle_epoch AS stale_ack,
        done AND NOT stale_ack AS live_done FROM stamped""",
    "epoch_wedges": """SELECT stream, shard_id, epoch, min(event_id) FILTER (WHERE NOT live_done) AS wedge
        FROM live GROUP BY stream, shard_id, epoch""",
    "epoch_reached": """SELECT stream, shard_id, epoch,
        max(event_id) FILTER (WHERE wedge IS NULL OR event_id < wedge) AS upto,
        CASE WHEN upto IS NOT NULL THEN upto || repeat('0', 50) END AS checkpoint
        FROM live JOIN epoch_wedges USING (stream, shard_id, epoch) GROUP BY stream, shard_id, epoch""",
    "commands": f"""SELECT 'events' AS stream, 's' || user_id AS shard_id, event_id AS n,
        {_MILLIS} AS t_ms, 'o' || (event_id % 3) AS owner,
        CASE event_type WHEN 'signup' THEN 'acquire' WHEN 'purchase' THEN 'acquire'
             WHEN 'view' THEN 'renew' WHEN 'click' THEN 'checkpoint'
             ELSE CASE WHEN event_id % 2 = 0 THEN 'release' ELSE 'read' END END AS op,
        CAST(event_id AS VARCHAR) AS sequence,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events""",
    "hourly": f"SELECT * REPLACE (t_ms // {HOUR_MS} * {HOUR_MS} AS t_ms) FROM commands",
}


def _ledger(commands: str, held: str) -> str:
    """One recursion step per command and shard; ``held`` is when another's lease still runs."""
    verdict = f"""CASE c.op WHEN 'acquire' THEN f.owner_after IS NULL OR f.owner_after = c.owner
        OR NOT ({held}) WHEN 'read' THEN true ELSE coalesce(f.owner_after = c.owner, false) END"""
    return f"""SELECT stream, shard_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS n,
        CAST(NULL AS BIGINT) AS t_ms, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS op,
        CAST(NULL AS BOOLEAN) AS ok, CAST(NULL AS VARCHAR) AS owner_before,
        CAST(NULL AS BIGINT) AS expires_before, CAST(NULL AS VARCHAR) AS owner_after,
        CAST(NULL AS BIGINT) AS expires_after, CAST(NULL AS VARCHAR) AS checkpoint_after,
        CAST(0 AS BIGINT) AS counter_after
        FROM (SELECT DISTINCT stream, shard_id FROM {commands})
        UNION ALL
        SELECT stream, shard_id, rn, n, t_ms, owner, op, ok, ob, eb,
          CASE WHEN ok AND op IN ('acquire', 'renew') THEN owner
               WHEN ok AND op = 'release' THEN NULL ELSE ob END,
          CASE WHEN ok AND op IN ('acquire', 'renew') THEN t_ms + {LEASE_TTL}
               WHEN ok AND op = 'release' THEN NULL ELSE eb END,
          CASE WHEN ok AND op = 'checkpoint' THEN sequence ELSE cb END,
          counter + CASE WHEN ok AND op <> 'read' THEN 1 ELSE 0 END
        FROM (SELECT c.*, f.owner_after AS ob, f.expires_after AS eb, f.checkpoint_after AS cb,
                     f.counter_after AS counter, {verdict} AS ok
              FROM {{self}} f JOIN {commands} c ON c.shard_id = f.shard_id AND c.rn = f.rn + 1)"""


TABLES["fold"] = _ledger("commands", "f.expires_after > c.t_ms").format(self="fold")
TABLES["lax_fold"] = _ledger("hourly", "f.expires_after > c.t_ms").format(self="lax_fold")
TABLES["strict_fold"] = _ledger("hourly", "f.expires_after >= c.t_ms").format(self="strict_fold")
TABLES["verdicts"] = "SELECT * FROM fold WHERE n IS NOT NULL"
TABLES["topics"] = """SELECT 'u' || user_id AS name, event_id AS "at", event_type FROM events"""
TABLES["intervals"] = """SELECT event_id AS sub_id, 'u' || user_id AS name, event_id AS sub_start,
    CASE WHEN event_id % 10 <> 0 THEN event_id + 200 + event_id % 700 END AS sub_end
    FROM events WHERE event_type = 'signup'"""
TABLES["fan_out"] = """SELECT sub_id, name, "at" FROM topics JOIN intervals USING (name)
    WHERE "at" >= sub_start AND (sub_end IS NULL OR "at" < sub_end)"""
TABLES["attempts"] = """SELECT sub_id, name, "at", CAST(unnest(range(
    CASE ("at" * 7 + sub_id) % 13 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END)) AS BIGINT) AS attempt
    FROM fan_out"""
TABLES["steps"] = """SELECT sub_id, "at" * 1000 + attempt * 3000 AS "at", attempt, 1 AS step FROM attempts
    UNION ALL SELECT sub_id, "at" * 1000 + attempt * 3000 + 3000, attempt, -1
    FROM attempts WHERE "at" % 101 <> 0"""

# What each table is made of, in order.
_ORDER = list(TABLES)


def _sql(body: str, *roots: str) -> str:
    """``body`` below the tables it names, and the tables those name."""
    needed: set[str] = set()
    pending = list(roots)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            words = set(TABLES[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
            pending += [t for t in _ORDER if t in words and t != name]
    listed = sorted(needed, key=_depth)
    ctes = ", ".join(f"{name} AS ({TABLES[name]})" for name in listed)
    return f"WITH RECURSIVE {ctes} {body}" if listed else body


def _depth(name: str) -> int:
    words = set(TABLES[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
    below = [t for t in _ORDER if t in words and t != name]
    return 1 + max(map(_depth, below), default=0)


_VERDICT = "shard_id, n, ok, owner_after, expires_after, checkpoint_after, counter_after"
_KEYED = "stream, shard_id, sequence_number"
_HEADERS = "array_to_string(list_sort(list(name || '=' || value)), ';')"
_FINISHED = "coalesce(k.checkpoint = 'SHARD_END', false)"


def _starts() -> str:
    cases = []
    for label, kind, ts_ms, why in START_CASES:
        forced = "false" if kind is None else ("true" if why == "start" else "k.checkpoint IS NULL")
        name = "NULL" if kind is None else f"'{kind}'"
        millis = "NULL" if ts_ms is None else str(ts_ms)
        cases.append(
            f"""SELECT s.stream, s.shard_id,
            CASE WHEN {_FINISHED} THEN NULL WHEN {forced} THEN {name}
                 WHEN k.checkpoint IS NOT NULL THEN 'after' ELSE 'latest' END AS start_kind,
            CASE WHEN NOT {_FINISHED} AND {forced} THEN CAST({millis} AS BIGINT) END AS start_ts_ms,
            CASE WHEN NOT {_FINISHED} AND NOT ({forced}) THEN k.checkpoint END AS start_sequence,
            '{label}' AS "case" FROM shards s LEFT JOIN checkpoints k USING (stream, shard_id)"""
        )
    return " UNION ALL ".join(cases)


ORACLES: dict[str, str] = {
    "a1_open_stream": _sql(
        """SELECT stream, shard_id,
        row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1 AS idx,
        sequence_number, partition_key, data_hex FROM raw""", "raw"),
    "a2_open_by_name": _sql(
        f"""SELECT {_KEYED} FROM raw
        WHERE event_id > (SELECT max(event_id) // 2 FROM events)""", "raw"),
    "a3_read_shard": _sql(
        "SELECT shard_id, sequence_number, partition_key, data_hex FROM raw WHERE shard_id = 'shard-0'",
        "raw"),
    "a4_read_limit": _sql(
        f"""SELECT stream, shard_id, count(*) AS records,
        CAST(ceil(count(*) / any_value(cap)) AS BIGINT) AS batches,
        least(count(*), any_value(cap)) AS largest_batch
        FROM raw, (SELECT greatest(1, count(*) // {READ_CAP}) AS cap FROM events)
        GROUP BY stream, shard_id""", "raw"),
    "a7_shard_catalogue": _sql(
        """SELECT stream, shard_id, count(*) AS records,
        count(DISTINCT event_id > (SELECT max(event_id) // 2 FROM events)) AS segments,
        min(okey) AS first_key, max(okey) AS last_key
        FROM (SELECT *, ltrim(sequence_number, '0') AS digits,
              lpad(CAST(length(digits) AS VARCHAR), 3, '0') || digits AS okey FROM raw)
        GROUP BY stream, shard_id""", "raw"),
    "a7_shard_listing": _sql(
        f"""SELECT stream, shard_id, count(*) AS records, CAST(NULL AS VARCHAR) AS parent_id,
        CAST(NULL AS VARCHAR) AS adjacent_parent_id, {_NUMBER} % 4 <> 3 AS closed
        FROM raw GROUP BY stream, shard_id
        UNION ALL SELECT stream, shard_id, 0, parent_id, adjacent_parent_id, closed FROM shards""",
        "raw", "shards"),
    "a8_publish": _sql(
        f"""SELECT {_SHARD} AS shard_id,
        row_number() OVER (PARTITION BY {_SHARD} ORDER BY event_id) - 1 AS idx,
        partition_key, data_hex FROM messages""", "messages"),
    "a8_compacted": _sql(
        f"""SELECT {_SHARD} AS shard_id,
        row_number() OVER (PARTITION BY {_SHARD} ORDER BY event_id) - 1 AS idx,
        partition_key, data_hex FROM messages""", "messages"),
    "a9_reply": _sql(
        """SELECT 'replies' AS stream, partition_key,
        '52534B31' || printf('%08X', strlen('answers: ' || sequence_number || chr(10)))
        || hex('answers: ' || sequence_number || chr(10)) || payload_hex AS data_hex
        FROM unpacked WHERE NOT refused""", "unpacked"),
    "a10_error_items": _sql(
        f"""SELECT {_KEYED}, CASE WHEN refused THEN 'AggregatedRecord' END AS error,
        CASE WHEN NOT refused THEN payload_hex END AS payload_hex FROM unpacked""", "unpacked"),
    "a11_multi_stream": _sql(
        """SELECT CASE event_id % 2 WHEN 0 THEN 'events-a' ELSE 'events-b' END AS stream, shard_id,
        row_number() OVER (PARTITION BY event_id % 2, shard_id ORDER BY event_id) - 1 AS idx,
        sequence_number FROM raw""", "raw"),
    "b1_pack": _sql("SELECT event_id, data_hex FROM messages", "messages"),
    "b2_unpack": _sql(
        f"""SELECT event_id, coalesce({_HEADERS} FILTER (WHERE name IS NOT NULL), '') AS headers,
        any_value(payload_hex) AS payload_hex FROM unpacked LEFT JOIN own_headers USING (event_id)
        GROUP BY event_id""".replace("list(name || '=' || value)), ';') FILTER (WHERE name IS NOT NULL)",
                                     "list(name || '=' || value) FILTER (WHERE name IS NOT NULL)), ';')"),
        "unpacked", "own_headers"),
    "b2_unpack_documents": """SELECT doc_id, lang, source, md5(text) AS text_md5,
        CAST(8 + strlen('lang: ' || lang || chr(10) || 'source: ' || source || chr(10))
             + strlen(text) AS BIGINT) AS bytes FROM documents""",
    "b3_deliver": _sql(
        f"SELECT event_id, {_HEADERS} AS headers FROM delivered_headers GROUP BY event_id",
        "delivered_headers"),
    "b4_refuse_aggregated": _sql(
        f"SELECT {_KEYED}, 'AggregatedRecord' AS error, data_hex FROM raw WHERE refused", "raw"),
    "b5_routing_key": _sql("SELECT event_id, partition_key FROM messages", "messages"),
    "b6_partition_key": _sql("SELECT event_id, partition_key FROM raw WHERE NOT refused", "raw"),
    "b7_position": _sql(
        """SELECT event_id, 'sequence' AS kind, CAST(NULL AS BIGINT) AS ts_ms, shard_id,
        sequence_number AS sequence FROM raw WHERE NOT refused""", "raw"),
    "b8_message": _sql(
        """SELECT event_id, any_value(payload_hex) AS payload_hex, count(*) AS n_headers
        FROM unpacked JOIN delivered_headers USING (event_id) GROUP BY event_id""",
        "unpacked", "delivered_headers"),
    "b9_decode_json": _sql(
        "SELECT event_id, k, CASE WHEN k IS NULL THEN 'Invalid' END AS error FROM bodies", "bodies"),
    "b10_order_key": """SELECT event_id,
        lpad(CAST(length(ltrim(s, '0')) AS VARCHAR), 3, '0') || ltrim(s, '0') AS order_key,
        lpad(ltrim(s, '0'), 129, '0') AS padded_key
        FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR)
              WHEN 1 THEN '000' || event_id
              WHEN 2 THEN '4' || lpad(CAST(event_id AS VARCHAR), 55, '0')
              ELSE lpad(CAST(event_id + 1 AS VARCHAR), 20, '1') || repeat('9', 109) END AS s
              FROM events)""",
    "b11_classify": _sql(
        """SELECT error, 'record' AS error_scope, count(*) AS n, count(DISTINCT shard_id) AS n_details
        FROM (SELECT 'AggregatedRecord' AS error, shard_id FROM raw WHERE refused
              UNION ALL SELECT 'Invalid', shard_id FROM bodies WHERE k IS NULL
              UNION ALL SELECT 'Read', shard_id FROM seeks WHERE NOT wide AND shard_id = 'shard-gone'
              UNION ALL SELECT 'Lease', shard_id FROM verdicts
              WHERE op IN ('renew', 'checkpoint') AND NOT ok) GROUP BY error""",
        "raw", "bodies", "seeks", "verdicts"),
    "c1_from_horizon": _sql(f"SELECT {_KEYED} FROM records", "records"),
    "c2_from_tip": _sql(
        f"""SELECT {_KEYED} FROM records LEFT JOIN tips USING (stream, shard_id)
        WHERE tip IS NULL OR event_id > tip""", "records", "tips"),
    "c3_from_timestamp": _sql(
        f"""SELECT {_KEYED} FROM records JOIN openings USING (stream, shard_id)
        WHERE event_id >= opening""", "records", "openings"),
    "c3_open_by_time": _sql(
        f"""SELECT {_KEYED} FROM records JOIN openings USING (stream, shard_id)
        WHERE event_id >= opening""", "records", "openings"),
    "c4_from_sequence": _sql(
        f"""SELECT {_KEYED} FROM records WHERE shard_id = 'shard-0'
        AND lpad(sequence_number, 129, '0') >= lpad('{PINNED}', 129, '0')""", "records"),
    "c5_after_checkpoint": _sql(
        f"""SELECT {_KEYED} FROM records LEFT JOIN points USING (stream, shard_id)
        WHERE checkpoint IS NULL OR (checkpoint <> 'SHARD_END' AND event_id > upto)""",
        "records", "points"),
    "c6_resolve_starts": _sql(_starts(), "shards", "checkpoints"),
    "c7_stream_wide": _sql(
        f"""SELECT {_KEYED} FROM records LEFT JOIN points USING (stream, shard_id)
        LEFT JOIN openings USING (stream, shard_id)
        WHERE CASE WHEN checkpoint IS NULL THEN event_id >= opening
              ELSE checkpoint <> 'SHARD_END' AND event_id > upto END""",
        "records", "points", "openings"),
    "c8_resume": _sql(
        f"""SELECT {_KEYED} FROM records LEFT JOIN points USING (stream, shard_id)
        LEFT JOIN tips USING (stream, shard_id)
        WHERE CASE WHEN checkpoint IS NULL THEN tip IS NULL OR event_id > tip
              ELSE checkpoint <> 'SHARD_END' AND event_id > upto END""",
        "records", "points", "tips"),
    "d1_delivery_index": _sql(
        f"""SELECT {_KEYED}, row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1 AS idx
        FROM records WHERE NOT aggregated""", "records"),
    "d2_outcomes": _sql("SELECT event_id, outcome, done FROM deliveries", "deliveries"),
    "d3_checkpoint": _sql("SELECT stream, shard_id, checkpoint FROM reached", "reached"),
    "d4_advance_log": _sql("SELECT * FROM advances", "advances"),
    "d4_settle_results": _sql(
        """SELECT stream, shard_id, settle_ord, sequence_number, checkpoint
        FROM deliveries LEFT JOIN advances USING (stream, shard_id, settle_ord) WHERE done""",
        "deliveries", "advances"),
    "d5_running_tracker": _sql(
        "SELECT stream, shard_id, checkpoint FROM reached WHERE checkpoint IS NOT NULL", "reached"),
    "d6_drained": _sql(
        """SELECT stream, shard_id, bool_and(done) AS drained,
        count(*) FILTER (WHERE NOT done) AS outstanding FROM deliveries GROUP BY stream, shard_id""",
        "deliveries"),
    "d7_wedges": _sql(
        """SELECT stream, shard_id, any_value(wedge) || repeat('0', 50) AS blocked_by,
        count(*) AS redelivered, count(*) FILTER (WHERE done) AS handled_again,
        epoch_us(max(arrival_ts)) // 1000
        - epoch_us(max(arrival_ts) FILTER (WHERE event_id = wedge)) // 1000 AS blocked_ms
        FROM deliveries JOIN wedges USING (stream, shard_id) WHERE event_id >= wedge
        GROUP BY stream, shard_id""", "deliveries", "wedges"),
    "d8_replay_set": _sql(
        f"""SELECT {_KEYED} FROM deliveries JOIN reached USING (stream, shard_id)
        WHERE upto IS NULL OR event_id > upto""", "deliveries", "reached"),
    "d9_shard_end": _sql(
        f"""SELECT stream, shard_id, CASE WHEN {_NUMBER} % 4 <> 3
            AND (newest IS NULL OR coalesce(all_done AND tip >= newest, false)) THEN 'SHARD_END'
            WHEN upto IS NOT NULL THEN upto || repeat('0', 50) END AS checkpoint
        FROM (SELECT stream, shard_id, max(event_id) FILTER (WHERE NOT aggregated) AS newest
              FROM records GROUP BY stream, shard_id)
        LEFT JOIN (
            SELECT stream, shard_id, bool_and(done) AS all_done, max(event_id) AS tip,
            max(event_id) FILTER (WHERE stuck IS NULL OR event_id < stuck) AS upto
            FROM (SELECT *, min(event_id) FILTER (WHERE NOT done) OVER (PARTITION BY stream, shard_id) AS stuck
                  FROM deliveries WHERE {_NUMBER} % 7 <> 2 OR event_id < 500)
            GROUP BY stream, shard_id) USING (stream, shard_id)""",
        "records", "deliveries"),
    "d10_conditional_persist": _sql(
        """SELECT stream, shard_id, n, owner, CAST(n AS VARCHAR) AS sequence, ok AS accepted,
        checkpoint_after FROM verdicts WHERE op = 'checkpoint'""", "verdicts"),
    "d11_checkpoint_table": f"""SELECT 'events' AS stream, {_SHARD} AS shard_id,
        arg_max(((event_id * 7919) % 1000) || repeat('0', 50), event_id) AS checkpoint
        FROM events GROUP BY {_SHARD}""",
    "e4_snapshot": _sql(
        """SELECT stream, shard_id, owner_after AS owner, expires_after AS expires_ms,
        checkpoint_after AS checkpoint, counter_after AS counter
        FROM verdicts QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY n DESC) = 1""",
        "verdicts"),
    "e6_ledger": _sql(f"SELECT {_VERDICT} FROM verdicts", "verdicts"),
    "e6_running_audit": _sql(f"SELECT {_VERDICT} FROM verdicts", "verdicts"),
    "e7_expiry_dialects": _sql(
        """SELECT shard_id, n, a.ok AS lax, a.owner_after AS lax_owner, b.ok AS strict,
        b.owner_after AS strict_owner FROM lax_fold a JOIN strict_fold b USING (shard_id, n)
        WHERE n IS NOT NULL AND (a.ok <> b.ok OR a.owner_after IS DISTINCT FROM b.owner_after)""",
        "lax_fold", "strict_fold"),
    "e8_write_counter": _sql(
        """SELECT shard_id, n, CAST(sum(CASE WHEN ok AND op <> 'read' THEN 1 ELSE 0 END) OVER
        (PARTITION BY shard_id ORDER BY n) AS BIGINT) AS counter_after FROM verdicts""", "verdicts"),
    "e9_fenced": _sql(
        """SELECT shard_id, n, owner, op, owner_before FROM verdicts
        WHERE op IN ('renew', 'checkpoint') AND NOT ok""", "verdicts"),
    "e10_ownership": _sql(
        """SELECT shard_id, owner_after AS owner, n AS from_n, t_ms AS from_ms, to_ms,
        CASE WHEN lapse < to_ms THEN lapse END AS lapsed_ms
        FROM (SELECT *, lead(t_ms) OVER w AS to_ms, lead(expires_before) OVER w AS lapse
              FROM verdicts WHERE owner_before IS DISTINCT FROM owner_after
              WINDOW w AS (PARTITION BY shard_id ORDER BY n)) WHERE owner_after IS NOT NULL""",
        "verdicts"),
    "e11_renewal_gaps": _sql(
        f"""SELECT shard_id, owner, n, previous_ms, t_ms, t_ms - previous_ms AS gap_ms,
        t_ms - previous_ms > {LEASE_TTL} AS past_ttl
        FROM (SELECT *, lag(t_ms) OVER (PARTITION BY shard_id, owner ORDER BY n) AS previous_ms
              FROM verdicts WHERE op IN ('acquire', 'renew') AND ok)
        WHERE owner_before = owner AND t_ms - previous_ms > {6 * HOUR_MS}""", "verdicts"),
    "d10_running_fence": _sql(
        """SELECT stream, shard_id, n, owner, CAST(n AS VARCHAR) AS sequence, ok AS accepted, checkpoint_after,
        ok AND n = max(n) FILTER (WHERE ok) OVER (PARTITION BY shard_id) AS stands
        FROM verdicts WHERE op = 'checkpoint'""", "verdicts"),
    "e10_running_watch": _sql(
        f"""SELECT 'tenure' AS kind, shard_id, owner_after AS owner, n, t_ms AS since_ms, to_ms AS at_ms,
        CASE WHEN lapse < to_ms THEN lapse END AS lapsed_ms
        FROM (SELECT *, lead(t_ms) OVER w AS to_ms, lead(expires_before) OVER w AS lapse
              FROM verdicts WHERE owner_before IS DISTINCT FROM owner_after
              WINDOW w AS (PARTITION BY shard_id ORDER BY n)) WHERE owner_after IS NOT NULL
        UNION ALL SELECT CASE WHEN t_ms - previous_ms > {LEASE_TTL} THEN 'late past ttl' ELSE 'late' END,
        shard_id, owner, n, previous_ms, t_ms, NULL
        FROM (SELECT *, lag(t_ms) OVER (PARTITION BY shard_id, owner ORDER BY n) AS previous_ms
              FROM verdicts WHERE op IN ('acquire', 'renew') AND ok)
        WHERE owner_before = owner AND t_ms - previous_ms > {6 * HOUR_MS}
        UNION ALL SELECT alert.kind, shard_id, owner, n, t_ms, t_ms + alert.wait, NULL
        FROM (SELECT *, lead(t_ms) OVER (PARTITION BY shard_id ORDER BY n) AS changed_ms,
              CASE WHEN op <> 'release' THEN [{{'kind': 'overdue', 'wait': {6 * HOUR_MS}}},
                                              {{'kind': 'lapsed', 'wait': {LEASE_TTL}}}] END AS alerts
              FROM verdicts WHERE op IN ('acquire', 'renew', 'release') AND ok) v,
        (SELECT max(t_ms) - 60000 AS clock FROM verdicts WHERE op IN ('acquire', 'renew', 'release')),
        (SELECT shard_id AS shard, max(t_ms) AS last_ms FROM verdicts
         WHERE op IN ('acquire', 'renew', 'release') GROUP BY shard_id) l,
        unnest(alerts) AS told(alert)
        WHERE l.shard = v.shard_id AND t_ms + alert.wait < coalesce(changed_ms, greatest(last_ms, clock + 1))""",
        "verdicts"),
    "f1_closed": _sql("SELECT stream, shard_id, closed FROM shards", "shards"),
    "f2_parents_done": _sql(
        """SELECT shard_id, 'tip' AS "from" FROM shards ANTI JOIN tip_blocked USING (shard_id)
        UNION ALL SELECT shard_id, 'horizon' FROM shards ANTI JOIN horizon_blocked USING (shard_id)""",
        "shards", "tip_blocked", "horizon_blocked"),
    "f3_startable": _sql(
        f"""SELECT stream, shard_id FROM shards s LEFT JOIN checkpoints k USING (stream, shard_id)
        WHERE s.shard_id NOT IN (SELECT shard_id FROM tip_blocked) AND NOT {_FINISHED}
        AND NOT ({_NUMBER} % 4 = 0 AND 'o' || ({_NUMBER} % 3) <> '{OWNER}'
                 AND {NOW_MS} - 5 + {_NUMBER} % 10 > {NOW_MS})
        AND {_NUMBER} % 11 <> 0""", "shards", "checkpoints", "tip_blocked"),
    "f3_running_release": _sql(
        """SELECT stream, shard_id FROM shards LEFT JOIN checkpoints k USING (stream, shard_id)
        WHERE shard_id NOT IN (SELECT shard_id FROM horizon_blocked)
        AND coalesce(k.checkpoint, '') <> 'SHARD_END'""", "shards", "checkpoints", "horizon_blocked"),
    "f4_depth": _sql("SELECT 'tree' AS stream, shard_id, depth FROM depths", "depths"),
    "f5_key_order": _sql(
        """SELECT partition_key, event_id, coalesce(depth, 0) AS depth,
        row_number() OVER (PARTITION BY partition_key
            ORDER BY coalesce(depth, 0), shard_id, event_id DESC) - 1 AS key_position
        FROM resharded LEFT JOIN depths USING (shard_id)""", "resharded", "depths"),
    "f6_trimmed_parents": _sql(
        """SELECT stream, shard_id, parent_id FROM edges
        WHERE parent_id NOT IN (SELECT shard_id FROM shards)""", "edges", "shards"),
    "g1_epoch": _sql("SELECT event_id, epoch FROM stamped", "stamped"),
    "g2_current": _sql(
        """SELECT event_id FROM deliveries d WHERE NOT EXISTS (SELECT 1 FROM seeks s
        WHERE s."at" > d.delivered_at AND (s.wide OR s.shard_id = d.shard_id))""",
        "deliveries", "seeks"),
    "g3_stale_acks": _sql("SELECT event_id, epoch, stale_ack FROM live", "live"),
    "g4_epoch_checkpoints": _sql(
        "SELECT stream, shard_id, epoch, checkpoint FROM epoch_reached", "epoch_reached"),
    "g4_stored_checkpoints": _sql(
        """SELECT stream, shard_id, checkpoint, epoch FROM epoch_reached WHERE upto IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY epoch DESC) = 1""", "epoch_reached"),
    "g4_running_gate": _sql(
        """SELECT stream, shard_id, checkpoint, epoch, stale_acks
        FROM (SELECT stream, shard_id, count(*) FILTER (WHERE stale_ack) AS stale_acks FROM live
              GROUP BY stream, shard_id)
        LEFT JOIN (SELECT * FROM epoch_reached WHERE upto IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY epoch DESC) = 1)
        USING (stream, shard_id)""", "live", "epoch_reached"),
    "g4_epoch_index": _sql(
        """SELECT event_id, epoch,
        row_number() OVER (PARTITION BY shard_id, epoch ORDER BY event_id) - 1 AS epoch_idx
        FROM stamped""", "stamped"),
    "g5_dispatch": _sql(
        """SELECT "at", kind, shard_id, CASE WHEN shard_id = 'shard-gone' THEN 'Read' END AS error
        FROM seeks""", "seeks"),
    "g6_marker": _sql(
        f"""SELECT event_id FROM records,
        (SELECT min(event_id) FILTER (WHERE props = '{{"k": 42}}' AND event_type = 'signup') AS marker,
                max(event_id) FILTER (WHERE arrival_ts < TIMESTAMP '{CUT}') AS tip FROM records)
        WHERE marker IS NULL OR event_id <= marker OR event_id > coalesce(tip, marker)""", "records"),
    "g6_running_marker": _sql(
        f"""SELECT event_id FROM records,
        (SELECT min(event_id) FILTER (WHERE props = '{{"k": 42}}' AND event_type = 'signup') AS marker,
                max(event_id) FILTER (WHERE arrival_ts < TIMESTAMP '{CUT}') AS tip FROM records)
        WHERE marker IS NULL OR event_id <= marker OR event_id > coalesce(tip, marker)""", "records"),
    "h1_fan_out": _sql("SELECT * FROM fan_out", "fan_out"),
    "h2_published_log": _sql(
        """SELECT *, row_number() OVER (PARTITION BY name ORDER BY "at") - 1 AS log_position
        FROM topics""", "topics"),
    "h3_live_intervals": _sql("SELECT * FROM intervals", "intervals"),
    "h4_requeue": _sql("SELECT * FROM attempts", "attempts"),
    "h5_in_flight": _sql(
        """SELECT *, CAST(sum(step) OVER (PARTITION BY sub_id ORDER BY "at", -step, attempt
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS in_flight FROM steps""", "steps"),
    "h5_quiescent": _sql(
        "SELECT sub_id, CAST(sum(step) AS BIGINT) AS in_flight FROM steps GROUP BY sub_id", "steps"),
    "h6_expectations": _sql(
        """SELECT 'u' || c_custkey AS name, c_custkey % 80 AS expected, count("at") AS published
        FROM customer LEFT JOIN topics ON topics.name = 'u' || c_custkey
        GROUP BY c_custkey HAVING count("at") <> c_custkey % 80""", "topics"),
}
for _name, _op in (("e1_acquire", "acquire"), ("e2_renew", "renew"), ("e3_checkpoint", "checkpoint"),
                   ("e4_read", "read"), ("e5_release", "release")):
    ORACLES[_name] = _sql(f"SELECT {_VERDICT} FROM verdicts WHERE op = '{_op}'", "verdicts")
