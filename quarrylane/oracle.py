"""DuckDB SQL for the registered block-feature queries, written from their definitions."""

from __future__ import annotations

import hashlib
import uuid

_NAMES = ("0b7e1a52-3c1d-4f6e-9a11-000000000001", "5f0c2c9e-7d42-4b8a-8c3f-0000000000aa", "c1d2e3f4-a5b6-4789-abcd-ef0123456789")
#: Dataset ids and the seeds of their samples.
SAMPLE_IDS = [(i, int.from_bytes(hashlib.sha256(uuid.UUID(i).bytes).digest()[:8], "big")) for i in _NAMES]

_FX = """
fx_events AS (SELECT cast(event_id AS bigint) AS n, cast(floor(epoch(ts)) AS bigint) AS "timestamp" FROM events),
fx_receipts AS (
  SELECT '0x' || sha256(cast(l_orderkey AS varchar)) AS block_hash,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS transaction_index,
         cast(l_quantity AS bigint) AS gas_used,
         1000000000 + l_orderkey + cast(round(l_extendedprice * 100) AS bigint) AS effective_gas_price
  FROM lineitem),
fx_gas AS (SELECT l_orderkey AS n, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS gas, count(*) AS txs FROM lineitem GROUP BY 1),
fx_blocks AS (
  SELECT e.n AS block_number, e."timestamp", '0x' || sha256(cast(e.n AS varchar)) AS block_hash, '0x' || sha256(cast(e.n - 1 AS varchar)) AS parent_hash,
         1000000000 + e.n AS base_fee_per_gas, coalesce(g.gas, 0) AS gas_used, cast(30000000 AS bigint) AS gas_limit, coalesce(g.txs, 0) AS tx_count
  FROM fx_events e LEFT JOIN fx_gas g ON e.n = g.n),
fx_head AS (SELECT max(n) - 100 AS head FROM fx_events)"""

_JOINED = """
joined AS (
  SELECT b.block_number, r.transaction_index, r.gas_used, r.effective_gas_price - b.base_fee_per_gas AS priority_fee, b.gas_used AS block_gas_used
  FROM fx_receipts r JOIN fx_blocks b ON r.block_hash = b.block_hash),
running AS (
  SELECT *, cast(sum(gas_used) OVER (PARTITION BY block_number ORDER BY priority_fee, transaction_index ROWS UNBOUNDED PRECEDING) AS bigint) AS running_gas FROM joined),
percentiles AS (
  SELECT block_number,
         min(CASE WHEN running_gas >= (cast(block_gas_used AS hugeint) * 50 + 99) // 100 THEN priority_fee END) AS p50,
         min(CASE WHEN running_gas >= (cast(block_gas_used AS hugeint) * 90 + 99) // 100 THEN priority_fee END) AS p90
  FROM running GROUP BY 1),
features AS (
  SELECT b.*, coalesce(p.p50, 0) AS effective_priority_fee_per_gas_p50, coalesce(p.p90, 0) AS effective_priority_fee_per_gas_p90
  FROM fx_blocks b LEFT JOIN percentiles p ON b.block_number = p.block_number)"""

_VERIFIER = """
fx_verifier AS (
  SELECT block_number, "timestamp", block_hash, CASE WHEN block_number % 1009 = 17 THEN '0x' || sha256(cast(block_number - 2 AS varchar)) ELSE parent_hash END AS parent_hash,
         CASE WHEN block_number % 997 = 13 THEN base_fee_per_gas + 1 ELSE base_fee_per_gas END AS base_fee_per_gas, gas_used, gas_limit, tx_count
  FROM fx_blocks WHERE block_number % 2003 <> 29)"""

_BROKEN = """
fx_broken AS (
  SELECT block_number, CASE WHEN block_number % 701 <> 19 THEN "timestamp" END AS "timestamp", CASE WHEN block_number % 809 = 23 THEN upper(block_hash) ELSE block_hash END AS block_hash,
         parent_hash, base_fee_per_gas, CASE WHEN block_number % 499 = 11 THEN gas_limit + 1 ELSE gas_used END AS gas_used, gas_limit, tx_count
  FROM fx_blocks WHERE block_number % 1013 <> 31)"""

_ISO = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def _iso(x: str, k: int | None = None) -> str:
    text = _ISO.format(f"({x})")
    return text if k is None else f"left({text}, {k})"


_T, _LATER = '"timestamp"', '"timestamp" + 7200 + (n % 5) * 3600'
_RANGES = f"""
fx_ranges AS (
  SELECT n AS range_id, n % 8 AS kind, "timestamp" AS t, {_LATER} AS later,
    CASE n % 8 WHEN 0 THEN {_iso(_T, 10)} WHEN 1 THEN {_iso(_T, 13)} || 'Z' WHEN 2 THEN {_iso(_T, 16)} || '+01:00' WHEN 6 THEN '1960-01-01' ELSE {_iso(_T)} END AS from_value,
    CASE n % 8 WHEN 0 THEN {_iso(_T, 10)} WHEN 1 THEN {_iso(_LATER, 13)} || 'Z' WHEN 2 THEN {_iso(_LATER + ' + 3600', 16)} || '+01:00' WHEN 3 THEN '2999-01-01T00:00:00Z'
               WHEN 4 THEN {_iso(_T + ' - 5')} WHEN 5 THEN 'soon' WHEN 6 THEN {_iso(_T)} ELSE {_iso(_LATER)} END AS to_value
  FROM fx_events),
bounds0 AS (
  SELECT range_id, from_value, to_value,
    cast(CASE kind WHEN 0 THEN t // 86400 * 86400 WHEN 1 THEN t // 3600 * 3600 WHEN 2 THEN t // 60 * 60 - 3600 WHEN 6 THEN NULL ELSE t END AS bigint) AS "start",
    cast(CASE kind WHEN 0 THEN t // 86400 * 86400 + 86399 WHEN 1 THEN later // 3600 * 3600 + 3599 WHEN 2 THEN (later + 3600) // 60 * 60 - 3600 + 59 WHEN 3 THEN 32472144000 WHEN 4 THEN t - 5 WHEN 5 THEN NULL WHEN 6 THEN t ELSE later END AS bigint) AS "end"
  FROM fx_ranges),
bounds AS (SELECT *, CASE WHEN "start" IS NULL OR "end" IS NULL OR "start" > "end" THEN 'RANGE_INVALID' END AS code FROM bounds0)"""

_RESOLVED = """
final AS (SELECT n, "timestamp" FROM fx_events, fx_head WHERE n <= head),
limits AS (SELECT min("timestamp") AS genesis, max("timestamp") AS latest FROM final),
hits AS (
  SELECT b.range_id, min(f.n) AS first_block, max(f.n) AS last_block, min(f."timestamp") AS first_timestamp, max(f."timestamp") AS last_timestamp
  FROM bounds b JOIN final f ON f."timestamp" BETWEEN b."start" AND b."end" GROUP BY 1),
coded AS (
  SELECT b.range_id, h.first_block, h.last_block, h.first_timestamp, h.last_timestamp,
    CASE WHEN b.code IS NOT NULL THEN b.code WHEN b."start" < l.genesis THEN 'RANGE_PRE_GENESIS' WHEN b."end" > l.latest THEN 'RANGE_UNFINALIZED' WHEN h.first_block IS NULL THEN 'RANGE_EMPTY' END AS code
  FROM bounds b CROSS JOIN limits l LEFT JOIN hits h ON b.range_id = h.range_id),
resolved AS (
  SELECT range_id, CASE WHEN code IS NULL THEN first_block END AS first_block, CASE WHEN code IS NULL THEN last_block END AS last_block,
    CASE WHEN code IS NULL THEN first_timestamp END AS first_timestamp, CASE WHEN code IS NULL THEN last_timestamp END AS last_timestamp, code FROM coded)"""

_BLOCK_REQUESTS = """
block_requests AS (
  SELECT n AS range_id, CASE WHEN n % 60 = 7 THEN n + 9 ELSE n END AS from_block, CASE WHEN n % 80 <> 27 THEN n + 5 + (n % 3) * 60 END AS to_block FROM fx_events)"""

_LINKS = """
previous AS (
  SELECT a.block_number, a.parent_hash, a."timestamp", p.block_number AS pn, p.block_hash AS ph, p."timestamp" AS pt
  FROM {0} a LEFT JOIN {0} p ON p.block_number = a.block_number - 1 WHERE a.block_number > (SELECT min(block_number) FROM {0})),
links AS (
  SELECT block_number, CASE WHEN pn IS NULL THEN 'gap' WHEN parent_hash IS DISTINCT FROM ph THEN 'parent' WHEN "timestamp" < pt THEN 'time' END AS reason FROM previous)"""

_REPLIES = """
base AS (
  SELECT n // 20 AS batch_id, n AS id, CASE WHEN n % 521 = 17 THEN '1.0' ELSE '2.0' END AS jsonrpc,
    CASE WHEN n % 211 <> 3 AND n % 223 <> 4 AND n % 227 <> 5 AND n % 229 <> 6 THEN 'r' END AS result,
    CASE WHEN n % 211 = 3 THEN -32603 WHEN n % 223 = 4 THEN -32005 WHEN n % 227 = 5 THEN -32601 END AS error_code, (n % 523 = 18 OR n % 229 <> 6) AS has_result
  FROM fx_events WHERE n % 101 <> 7),
replies AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE id % 307 = 5 UNION ALL SELECT batch_id, id + 10000000, jsonrpc, result, error_code, has_result FROM base WHERE id % 401 = 9),
outcomes AS (
  SELECT coalesce(c.b, r.batch_id) AS batch_id, coalesce(c.i, r.id) AS id,
    CASE WHEN c.i IS NULL OR r.n > 1 OR r.odd THEN 'protocol' WHEN r.fatal THEN 'fatal' WHEN r.over THEN 'limit' WHEN r.given THEN 'accepted' ELSE 'retry' END AS outcome
  FROM (SELECT n // 20 AS b, n AS i FROM fx_events) c
  FULL JOIN (SELECT batch_id, id, count(*) AS n, bool_or(jsonrpc <> '2.0' OR has_result = (error_code IS NOT NULL)) AS odd,
                    bool_or(coalesce(error_code IN (-32700, -32600, -32601, -32602, -32000, -32001, -32003, -32004, -32006), false)) AS fatal,
                    bool_or(coalesce(error_code = -32005, false)) AS over, bool_or(result IS NOT NULL) AS given FROM replies GROUP BY 1, 2) r
  ON c.b = r.batch_id AND c.i = r.id)"""

_LANDED = """
members AS (
  SELECT batch_id, id AS n, jsonrpc, error_code, n_text OR n_fraction OR no_object AS unnamed, no_object, result IS NOT NULL AND has_result AS given, (has_result AND result IS NULL AND error_code IS NULL) OR (result IS NOT NULL AND has_result) AS shown,
    error_code IS NOT NULL AND id % 211 = 3 AND id % 2 = 1 AS code_text, error_code IS NOT NULL AND id % 223 = 4 AND id % 3 = 1 AS no_message
  FROM (SELECT *, id % 541 = 11 AS n_text, id % 547 = 12 AS n_fraction, id % 557 = 13 AS no_object FROM replies)),
rated AS (
  SELECT batch_id, CASE WHEN NOT unnamed THEN n END AS id, unnamed OR jsonrpc <> '2.0' OR shown = (error_code IS NOT NULL) OR code_text OR no_message AS odd,
    CASE WHEN NOT no_object AND NOT code_text AND error_code IS NOT NULL THEN CASE WHEN n % 211 = 3 THEN -32603 ELSE error_code END END AS code, given AND NOT no_object AS given
  FROM members WHERE NOT (batch_id % 97 = 41 OR batch_id % 101 = 43)
  UNION ALL SELECT DISTINCT batch_id, NULL, true, NULL, false FROM replies WHERE batch_id % 97 = 41 OR batch_id % 101 = 43),
landed AS (
  SELECT coalesce(c.b, r.batch_id) AS batch_id, coalesce(c.i, r.id) AS id,
    CASE WHEN c.i IS NULL OR r.n > 1 OR r.odd THEN 'protocol' WHEN r.fatal THEN 'fatal' WHEN r.over THEN 'limit' WHEN r.given THEN 'accepted' ELSE 'retry' END AS outcome
  FROM (SELECT n // 20 AS b, n AS i FROM fx_events) c
  FULL JOIN (SELECT batch_id, id, count(*) AS n, bool_or(odd) AS odd, bool_or(coalesce(code IN (-32700, -32600, -32601, -32602, -32000, -32001, -32003, -32004, -32006), false)) AS fatal, bool_or(coalesce(code = -32005, false)) AS over, bool_or(given) AS given FROM rated GROUP BY 1, 2) r
  ON c.b = r.batch_id AND c.i = r.id)"""

_STAGED = """
staged AS (
  SELECT b.*, block_hash AS _proof_hash, parent_hash AS _proof_parent_hash, "timestamp" AS _proof_timestamp, gas_used AS _proof_gas_used, gas_limit AS _proof_gas_limit FROM {0} b)"""

_COMPARED = """
sides AS (
  SELECT coalesce(a.block_number, v.block_number) AS block_number,
    CASE WHEN v.block_number IS NULL THEN 'missing_there' WHEN a.block_number IS NULL THEN 'missing_here'
         WHEN a."timestamp" IS DISTINCT FROM v."timestamp" THEN 'timestamp' WHEN a.block_hash IS DISTINCT FROM v.block_hash THEN 'block_hash' WHEN a.parent_hash IS DISTINCT FROM v.parent_hash THEN 'parent_hash'
         WHEN a.base_fee_per_gas IS DISTINCT FROM v.base_fee_per_gas THEN 'base_fee_per_gas' WHEN a.gas_used IS DISTINCT FROM v.gas_used THEN 'gas_used' WHEN a.tx_count IS DISTINCT FROM v.tx_count THEN 'tx_count' END AS reason
  FROM {0} a FULL JOIN {1} v ON a.block_number = v.block_number)"""


def _sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((_FX, *ctes))}\n{body}"


_SEVEN = 'block_number, "timestamp", block_hash, parent_hash, base_fee_per_gas, gas_used, gas_limit, tx_count'
_SEEDS = "(VALUES " + ", ".join(f"({k}, '{i}', cast({s} AS hugeint))" for k, (i, s) in enumerate(SAMPLE_IDS)) + ") ids(k, dataset_id, seed)"
_RAW_REASON = """CASE WHEN n % 350 = 49 THEN 'other_block' WHEN n % 350 = 99 THEN 'block_hash' WHEN n % 350 = 149 THEN 'parent_hash' WHEN n % 350 IN (199, 249) THEN 'base_fee_per_gas' WHEN n % 350 = 299 THEN 'gas_used' WHEN n % 350 = 349 THEN 'tx_count' END"""
_DECODED = f"""decoded AS (SELECT block_number, "timestamp", block_hash, parent_hash, base_fee_per_gas, gas_used, gas_limit, tx_count, reject_reason
  FROM (SELECT b.*, {_RAW_REASON.replace('n %', 'b.block_number %')} AS reject_reason FROM fx_blocks b))"""
_HEX = "regexp_matches({0}, '^0x[0-9a-f]{{64}}$')"
#: A value that is there and outside its domain.
_OUT_OF_DOMAIN = f"""coalesce(block_number < 0 OR "timestamp" < 0 OR gas_used < 0 OR tx_count < 0 OR base_fee_per_gas <= 0 OR gas_limit <= 0 OR gas_used > gas_limit OR NOT {_HEX.format('block_hash')} OR NOT {_HEX.format('parent_hash')}, false)"""
#: Exactly the blocks from 0 to the last event.
_EXACT = "cast(count(*) = (SELECT max(n) + 1 FROM fx_events) AND count(DISTINCT block_number) = count(*) AND min(block_number) = 0 AND max(block_number) = (SELECT max(n) FROM fx_events) AS bigint)"
_SPAN = "span AS (SELECT head // 2 AS target, head - 50 AS anchor, head FROM fx_head)"
_NULL = lambda c: f"CASE WHEN reject_reason IS NULL THEN {c} END AS {c}"

#: The files of a CSV dataset: parts of equal ranges of numbers, in each the rows of a file in order.
_FILES = """
fx_span AS (SELECT min(n) AS first, max(n) - min(n) + 1 AS blocks FROM fx_events),
dealt AS (SELECT e.*, (n - first) * ((blocks + 65535) // 65536) // blocks AS part FROM fx_events e, fx_span),
placed AS (SELECT *, (row_number() OVER (PARTITION BY part ORDER BY n) - 1) // 1024 AS file FROM dealt),
files AS (SELECT part, file, 'block_number,timestamp' || chr(10) || string_agg(n || ',' || "timestamp", chr(10) ORDER BY n) || chr(10) AS body FROM placed GROUP BY 1, 2)"""

ORACLE_SQL = {
    "tx_counts": _sql("SELECT block_hash, count(*) AS tx_count FROM fx_receipts GROUP BY 1"),
    "receipt_join": _sql("SELECT * FROM joined", _JOINED),
    "bucketed_receipt_join": _sql('SELECT j.* FROM joined j JOIN fx_events e ON e.n = j.block_number, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM fx_events) WHERE e."timestamp" >= lo + (hi - lo) // 2', _JOINED),
    "running_gas": _sql("SELECT block_number, transaction_index, gas_used, priority_fee, running_gas FROM running", _JOINED),
    "priority_fee_percentiles": _sql("SELECT * FROM percentiles", _JOINED),
    "build_block_features": _sql("SELECT * FROM features", _JOINED),
    "receipt_gaps": _sql(
        """SELECT b.block_number, b.gas_used, cast(coalesce(s.g, 0) AS bigint) AS receipt_gas, 'incomplete' AS reason FROM fx_blocks b
LEFT JOIN (SELECT block_hash, sum(gas_used) AS g FROM fx_receipts WHERE NOT (transaction_index = 0 AND effective_gas_price % 97 = 5) GROUP BY 1) s ON b.block_hash = s.block_hash WHERE b.gas_used <> coalesce(s.g, 0)"""
    ),
    "select_features": _sql('SELECT block_number, "timestamp", base_fee_per_gas, gas_used, block_hash, parent_hash, gas_limit FROM fx_blocks'),
    "proof_columns": _sql('SELECT block_number, "timestamp", gas_used, block_hash AS _proof_hash, parent_hash AS _proof_parent_hash, "timestamp" AS _proof_timestamp, gas_used AS _proof_gas_used, gas_limit AS _proof_gas_limit FROM fx_blocks'),
    "warehouse_features": _sql("SELECT f.* FROM features f, fx_head WHERE block_number <= head", _JOINED),
    "warehouse_counts": _sql('SELECT block_number, "timestamp", tx_count FROM fx_blocks, fx_head WHERE block_number <= head'),
    "receipt_proofs": _sql(
        """SELECT b.block_number FROM fx_blocks b LEFT JOIN (SELECT block_hash, sum(gas_used) AS g FROM fx_receipts WHERE NOT (transaction_index = 0 AND effective_gas_price % 97 = 5) GROUP BY 1) s ON b.block_hash = s.block_hash WHERE b.gas_used <> coalesce(s.g, 0)"""
    ),
    "scan_blocks": _sql('SELECT b.* FROM fx_blocks b, fx_head, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM fx_events) WHERE block_number BETWEEN head // 4 AND head // 2 AND "timestamp" BETWEEN lo + (hi - lo) // 5 AND hi'),
    "scan_by_time": _sql(
        """SELECT block_hash, transaction_index, gas_used, effective_gas_price, block_timestamp FROM (
SELECT r.*, coalesce(b."timestamp", hi) AS block_timestamp, lo, hi FROM fx_receipts r LEFT JOIN fx_blocks b ON r.block_hash = b.block_hash, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM fx_events))
WHERE block_timestamp BETWEEN lo + (hi - lo) // 4 AND lo + (hi - lo) // 2"""
    ),
    "decode_headers": _sql(
        f"SELECT block_number, {', '.join(map(_NULL, ('block_hash', 'parent_hash', 'base_fee_per_gas', 'gas_used', 'gas_limit', 'tx_count')))}, CASE WHEN reject_reason IS NULL THEN \"timestamp\" END AS \"timestamp\", reject_reason FROM decoded", _DECODED
    ),
    "decode_fee_history": _sql("SELECT block_number, block_hash, effective_priority_fee_per_gas_p50 AS p50, effective_priority_fee_per_gas_p90 AS p90 FROM features", _JOINED),
    "reconcile_replies": _sql("SELECT * FROM outcomes", _REPLIES),
    "reconcile_batches": _sql("SELECT * FROM landed", _REPLIES, _LANDED),
    "retry_calls": _sql("SELECT batch_id, id FROM outcomes WHERE outcome IN ('retry', 'limit')", _REPLIES),
    "normalize_bounds": _sql("SELECT * FROM bounds", _RANGES),
    "check_requests": _sql(
        """SELECT range_id, cast(NULL AS bigint) AS from_block, cast(NULL AS bigint) AS to_block, from_value AS from_time, to_value AS to_time, code FROM bounds
UNION ALL SELECT range_id, f, to_block, CASE WHEN range_id % 140 = 47 THEN '2026-01-01' END, NULL,
  CASE WHEN range_id % 140 = 47 OR f < 0 OR to_block IS NULL OR f > to_block THEN 'RANGE_INVALID' END
FROM (SELECT *, from_block - CASE WHEN range_id % 100 = 67 THEN 1000000000 ELSE 0 END AS f FROM block_requests)""",
        _RANGES, _BLOCK_REQUESTS,
    ),
    "finalized_head": _sql("SELECT head AS block_number FROM fx_head"),
    "resolve_time_ranges": _sql("SELECT * FROM resolved", _RANGES, _RESOLVED),
    "resolve_time_ranges_by_day": _sql("SELECT * FROM resolved", _RANGES, _RESOLVED),
    "resolve_block_ranges": _sql(
        """SELECT range_id, CASE WHEN code IS NULL THEN from_block END AS first_block, CASE WHEN code IS NULL THEN to_block END AS last_block, CASE WHEN code IS NULL THEN t0 END AS first_timestamp, CASE WHEN code IS NULL THEN t1 END AS last_timestamp, code FROM (
SELECT r.*, a."timestamp" AS t0, b."timestamp" AS t1, CASE WHEN to_block IS NULL OR from_block > to_block THEN 'RANGE_INVALID' WHEN to_block > head THEN 'RANGE_UNFINALIZED' WHEN a.n IS NULL OR b.n IS NULL THEN 'RANGE_EMPTY' END AS code
FROM block_requests r CROSS JOIN fx_head LEFT JOIN fx_events a ON a.n = r.from_block LEFT JOIN fx_events b ON b.n = r.to_block)""",
        _BLOCK_REQUESTS,
    ),
    "verify_edges": _sql(
        """SELECT x.range_id, cast(coalesce(fv.block_number IS NOT NULL AND lv.block_number IS NOT NULL AND fv.block_hash = fb.block_hash AND fv.parent_hash = fb.parent_hash AND lv.block_hash = lb.block_hash AND lv.parent_hash = lb.parent_hash
  AND fv."timestamp" = x.first_timestamp AND lv."timestamp" = x.last_timestamp AND fv."timestamp" >= x."start" AND lv."timestamp" <= x."end"
  AND (x.first_block = 0 OR coalesce(bv."timestamp" < x."start", false)) AND (x.last_block + 1 > head OR coalesce(av."timestamp" > x."end", false)), false) AS bigint) AS proved
FROM (SELECT r.*, b."start", b."end" FROM resolved r JOIN bounds b ON r.range_id = b.range_id WHERE r.code IS NULL) x CROSS JOIN fx_head
LEFT JOIN fx_verifier fv ON fv.block_number = x.first_block LEFT JOIN fx_verifier lv ON lv.block_number = x.last_block
LEFT JOIN fx_verifier bv ON bv.block_number = x.first_block - 1 LEFT JOIN fx_verifier av ON av.block_number = x.last_block + 1
LEFT JOIN fx_blocks fb ON fb.block_number = x.first_block LEFT JOIN fx_blocks lb ON lb.block_number = x.last_block""",
        _RANGES, _RESOLVED, _VERIFIER,
    ),
    "domain_violations": _sql(f"SELECT block_number FROM fx_broken WHERE {_OUT_OF_DOMAIN}", _BROKEN),
    "null_counts": _sql(
        'SELECT count(*) - count(block_number) AS block_number, count(*) - count("timestamp") AS "timestamp", count(*) - count(block_hash) AS block_hash, count(*) - count(parent_hash) AS parent_hash, count(*) - count(base_fee_per_gas) AS base_fee_per_gas, count(*) - count(gas_used) AS gas_used, count(*) - count(gas_limit) AS gas_limit, count(*) - count(tx_count) AS tx_count FROM fx_broken', _BROKEN
    ),
    "contiguity": _sql(
        """SELECT count(*) AS row_count, min(block_number) AS first_block, max(block_number) AS last_block, count(*) - count(DISTINCT block_number) AS repeats, """ + _EXACT + """ AS exact, 'blocks' AS "of" FROM fx_blocks
UNION ALL SELECT count(*), min(block_number), max(block_number), count(*) - count(DISTINCT block_number), """ + _EXACT + """, 'broken' FROM fx_broken""", _BROKEN
    ),
    "time_violations": _sql(
        """SELECT b.block_number, 'decreases' AS reason FROM late b JOIN late p ON p.block_number = b.block_number - 1 WHERE b."timestamp" < p."timestamp"
UNION ALL SELECT block_number, 'edge' FROM late WHERE block_number = (SELECT min(block_number) FROM late) AND "timestamp" <> 0""",
        'late AS (SELECT block_number, "timestamp" - CASE WHEN block_number % 601 = 21 THEN 100000 ELSE 0 END AS "timestamp" FROM fx_blocks)',
    ),
    "link_violations": _sql("SELECT * FROM links WHERE reason IS NOT NULL", _BROKEN, _LINKS.format("fx_broken")),
    "link_violations_by_chunk": _sql("SELECT * FROM links WHERE reason IS NOT NULL", _BROKEN, _LINKS.format("fx_broken")),
    "dataset_summary": _sql(
        " UNION ALL ".join(
            f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE {_OUT_OF_DOMAIN}) AS domain_faults, cast({' + '.join(f'count(*) - count({c})' for c in _SEVEN.split(', '))} AS bigint) AS null_values, {_EXACT} AS exact,
  cast(max_by(block_hash, block_number) IS NOT DISTINCT FROM (SELECT '0x' || sha256(cast(max(n) AS varchar)) FROM fx_events) AS bigint) AS target_ok,
  cast(min_by("timestamp", block_number) IS NOT DISTINCT FROM (SELECT min("timestamp") FROM fx_events) AND max_by("timestamp", block_number) IS NOT DISTINCT FROM (SELECT max("timestamp") FROM fx_events) AS bigint) AS times_ok,
  (SELECT count(*) FROM links_{k} WHERE reason IS NOT NULL) AS link_faults, '{k}' AS "of" FROM fx_{k}"""
            for k in ("blocks", "broken")
        ),
        _BROKEN, *(_LINKS.format(f"fx_{k}").replace("previous AS", f"previous_{k} AS").replace("links AS", f"links_{k} AS").replace("FROM previous)", f"FROM previous_{k})") for k in ("blocks", "broken")),
    ),
    "proof_mismatches": _sql(
        """SELECT block_number FROM spoilt WHERE _proof_hash IS NULL OR _proof_hash <> block_hash OR _proof_parent_hash <> parent_hash OR _proof_timestamp <> shown OR _proof_gas_used <> gas_used OR _proof_gas_limit <> gas_limit OR gas_limit <= 0 OR gas_used > gas_limit""",
        _STAGED.format("fx_blocks"), 'spoilt AS (SELECT * REPLACE (CASE WHEN block_number % 809 <> 23 THEN _proof_hash END AS _proof_hash), "timestamp" + CASE WHEN block_number % 701 = 19 THEN 1 ELSE 0 END AS shown FROM staged)',
    ),
    "sample_numbers": _sql(
        f"""SELECT dataset_id, block_number, count(*) AS times FROM (
SELECT DISTINCT s.n, i.dataset_id, unnest([s.n, s.n + s.n % 7] || list_transform(range(0, least(3, greatest(s.n % 7 - 1, 0))), lambda j: cast(s.n + 1 + (i.seed + j) % (s.n % 7 - 1) AS bigint))) AS block_number
FROM fx_events s JOIN {_SEEDS} ON i.k = s.n % {len(SAMPLE_IDS)} ) GROUP BY 1, 2""".replace("ids(k", "i(k")
    ),
    "rows_at": _sql("SELECT * FROM fx_verifier", _VERIFIER),
    "missing_at": _sql("SELECT n AS block_number FROM fx_events WHERE n NOT IN (SELECT block_number FROM fx_verifier)", _VERIFIER),
    "compare_sample": _sql("SELECT * FROM sides WHERE reason IS NOT NULL", _VERIFIER, _COMPARED.format("fx_blocks", "fx_verifier")),
    "compare_full": _sql(
        """SELECT * FROM sides WHERE reason IS NOT NULL UNION ALL SELECT block_number, 'verifier_' || reason FROM links WHERE reason IS NOT NULL
UNION ALL SELECT p.n, 'missing_there' FROM (SELECT cast(unnest(generate_series(0, (SELECT head + 100 FROM fx_head))) AS bigint) AS n) p WHERE n NOT IN (SELECT block_number FROM ours) AND n NOT IN (SELECT block_number FROM theirs)""",
        _VERIFIER, "ours AS (SELECT b.* FROM fx_blocks b, fx_head WHERE block_number BETWEEN 1 AND head + 99)", "theirs AS (SELECT v.* FROM fx_verifier v, fx_head WHERE block_number BETWEEN 1 AND head + 99)", _COMPARED.format("ours", "theirs"), _LINKS.format("theirs"),
    ),
    "core_mismatches": _sql("SELECT block_number, reason FROM (SELECT block_number, CASE WHEN reason IN ('missing_there', 'missing_here', 'timestamp', 'block_hash', 'parent_hash') THEN reason END AS reason FROM sides) WHERE reason IS NOT NULL", _VERIFIER, _COMPARED.format("fx_blocks", "fx_verifier")),
    "ancestry_breaks": _sql(
        """SELECT l.block_number, l.reason FROM links l, span WHERE l.reason IS NOT NULL AND l.block_number > target AND l.block_number <= anchor
UNION ALL SELECT anchor, 'coverage' FROM span, (SELECT count(*) AS n FROM part) WHERE n <> anchor - target + 1
UNION ALL SELECT anchor, 'anchor' FROM span, (SELECT max_by(block_hash, block_number) AS h FROM part) WHERE h IS DISTINCT FROM '0x' || sha256(cast(anchor AS varchar))
UNION ALL SELECT target, 'target' FROM span, (SELECT min_by(block_hash, block_number) AS h FROM part) WHERE h IS DISTINCT FROM '0x' || sha256(cast(target AS varchar))""",
        _VERIFIER, _SPAN, "part AS (SELECT v.* FROM fx_verifier v, span WHERE block_number BETWEEN target AND anchor)", _LINKS.format("part"),
    ),
    "canonical_chain": _sql("SELECT b.* FROM fx_blocks b, fx_head WHERE block_number <= head"),
    "refresh_anchor": _sql(
        """SELECT head AS block_number, '0x' || sha256(cast(head AS varchar)) AS block_hash, cast(1 AS bigint) AS refreshed, 'blocks' AS "of" FROM fx_head
UNION ALL SELECT v.block_number, v.block_hash, cast((SELECT count(*) FROM links WHERE reason IS NOT NULL) = 0 AND (SELECT count(*) FROM part) = head - target + 1 AS bigint), 'verifier' FROM fx_verifier v, span WHERE v.block_number = head""",
        _VERIFIER, _SPAN, "part AS (SELECT v.* FROM fx_verifier v, span WHERE block_number BETWEEN target AND head)", _LINKS.format("part"),
    ),
    "write_parquet": _sql(f"SELECT {_SEVEN} FROM fx_blocks"),
    "write_csv": _sql(f"SELECT {_SEVEN} FROM fx_blocks"),
    "read_parquet": _sql('SELECT block_number, "timestamp", tx_count FROM fx_blocks'),
    "read_csv": _sql('SELECT block_number, "timestamp", block_hash FROM fx_blocks'),
    "chunk_bounds": _sql("SELECT block_number // 1024 AS chunk_id, min(block_number) AS from_block, max(block_number) AS to_block, count(*) AS row_count, count(DISTINCT block_number) AS distinct_blocks FROM fx_broken GROUP BY 1", _BROKEN),
    "stage_chunks": _sql(f"SELECT {_SEVEN}, _proof_hash, _proof_parent_hash, _proof_timestamp, _proof_gas_used, _proof_gas_limit FROM staged", _STAGED.format("fx_blocks")),
    "missing_chunks": _sql(
        """SELECT p.chunk_id, p.from_block, p.to_block FROM (SELECT DISTINCT n // 256 AS chunk_id, n // 256 * 256 AS from_block, least(n // 256 * 256 + 255, head + 200) AS to_block FROM (SELECT cast(unnest(generate_series(0, (SELECT head + 200 FROM fx_head))) AS bigint) AS n), fx_head) p
LEFT JOIN (SELECT block_number // 256 AS chunk_id, min(block_number) AS f, max(block_number) AS t, count(*) AS c FROM staged GROUP BY 1) s ON p.chunk_id = s.chunk_id AND p.from_block = s.f AND p.to_block = s.t AND s.c = s.t - s.f + 1
WHERE s.chunk_id IS NULL""",
        _VERIFIER, _STAGED.format("fx_verifier"),
    ),
    "chunk_states": _sql(
        """SELECT chunk_id, from_block, to_block, state, cast(coalesce(chunk_id < (SELECT min(chunk_id) FROM states WHERE state <> 'complete'), true) AS bigint) AS usable FROM states""",
        _VERIFIER, _LINKS.format("fx_verifier"),
        """plan AS (SELECT DISTINCT n // 256 AS chunk_id, n // 256 * 256 AS from_block, least(n // 256 * 256 + 255, head + 400) AS to_block FROM (SELECT cast(unnest(generate_series(0, (SELECT head + 400 FROM fx_head))) AS bigint) AS n), fx_head),
have AS (SELECT block_number // 256 AS chunk_id, min(block_number) AS f, max(block_number) AS t, count(*) AS c FROM fx_verifier GROUP BY 1),
faulty AS (SELECT DISTINCT block_number // 256 AS chunk_id FROM links WHERE reason IN ('parent', 'time')),
states AS (
  SELECT p.*, CASE WHEN h.chunk_id IS NULL THEN 'absent' WHEN p.chunk_id // 8 = 1 THEN 'changed' WHEN p.from_block <> h.f OR p.to_block <> h.t OR h.c <> h.t - h.f + 1 THEN 'incomplete' WHEN x.chunk_id IS NOT NULL THEN 'broken' ELSE 'complete' END AS state
  FROM plan p LEFT JOIN have h ON p.chunk_id = h.chunk_id LEFT JOIN faulty x ON p.chunk_id = x.chunk_id)""",
    ),
    "assemble": _sql(f"SELECT {_SEVEN} FROM fx_blocks"),
    "run_receipt": _sql("SELECT count(*) AS row_count, count(*) FILTER (WHERE block_number < 1024) AS reused_rows, count(*) FILTER (WHERE block_number >= 1024) AS acquired_rows, min_by(block_hash, block_number) AS first_hash, max_by(block_hash, block_number) AS target_hash FROM fx_blocks"),
    "manifest_facts": _sql('SELECT count(*) AS row_count, min(block_number) AS from_block, max(block_number) AS to_block, min_by("timestamp", block_number) AS from_timestamp, max_by("timestamp", block_number) AS to_timestamp, max_by(block_hash, block_number) AS target_hash FROM fx_blocks'),
    "file_digests": _sql("SELECT part, file, cast(strlen(body) AS bigint) AS bytes, sha256(body) AS sha256 FROM files", _FILES),
    "changed_files": _sql(
        """SELECT part, file, 'added' AS reason FROM files WHERE file % 4 IN (0, 2)
UNION ALL SELECT part, file, 'changed' FROM files WHERE file % 4 = 1 UNION ALL SELECT part, file, 'removed' FROM files WHERE file % 4 = 2""",
        _FILES,
    ),
    "csv_violations": _sql(
        """SELECT reason, count(*) AS lines FROM (SELECT CASE WHEN NOT regexp_matches(n, '^(0|[1-9][0-9]*)$') THEN 'block_number' WHEN NOT regexp_matches(t, '^(0|[1-9][0-9]*)$') THEN 'timestamp' WHEN NOT regexp_matches(c, '^(0|[1-9][0-9]*)$') THEN 'tx_count' END AS reason
FROM (SELECT CASE WHEN block_number % 401 = 3 THEN '0' ELSE '' END || block_number AS n, CASE WHEN block_number % 409 <> 5 THEN cast("timestamp" AS varchar) ELSE '' END AS t, CASE WHEN block_number % 419 = 7 THEN '+1' ELSE cast(tx_count AS varchar) END AS c FROM fx_blocks)) WHERE reason IS NOT NULL GROUP BY 1"""
    ),
    "order_violations": _sql(
        """SELECT DISTINCT 'inside' AS reason, part FROM (SELECT n, part, lag(n) OVER (PARTITION BY part ORDER BY i) AS p FROM (SELECT n, n % 4 AS part, row_number() OVER (PARTITION BY n % 4 ORDER BY n DESC) AS i FROM fx_events)) WHERE n <= p
UNION ALL SELECT 'across', part FROM (SELECT part, low, lag(high) OVER (ORDER BY part) AS before FROM (SELECT n % 4 AS part, min(n) AS low, max(n) AS high FROM fx_events GROUP BY 1)) WHERE low <= before"""
    ),
    # Three datasets, each a third of the blocks; two state something else of their rows than these are.
    "audit_manifests": _sql(
        """SELECT faults, count(*) AS datasets FROM (
SELECT CASE WHEN NOT regexp_matches(CASE third WHEN 1 THEN '0x' ELSE max_by(block_hash, block_number) END, '^0x[0-9a-f]{64}$') THEN 'target_hash' WHEN CASE third WHEN 2 THEN 1 ELSE count(*) END <> max(block_number) - min(block_number) + 1 THEN 'row_count' ELSE '' END AS faults
FROM (SELECT *, CASE WHEN block_number < (head + 100) // 3 THEN 0 WHEN block_number < 2 * (head + 100) // 3 THEN 1 ELSE 2 END AS third FROM fx_blocks, fx_head) GROUP BY third) GROUP BY 1"""
    ),
    "stream_headers": _sql(f"SELECT {_SEVEN} FROM decoded WHERE reject_reason IS NULL", _DECODED),
    "finalized_view": _sql("SELECT b.* FROM fx_blocks b, fx_head WHERE block_number <= head"),
    "stream_reorgs": _sql("SELECT b.* FROM fx_blocks b, fx_head WHERE block_number <= head"),
    "stream_final_features": _sql("SELECT f.* FROM features f, fx_head WHERE block_number <= head", _JOINED),
    "stream_features": _sql("SELECT * FROM features WHERE block_number <> 33 OR tx_count < 2", _JOINED),
}
ORACLE_SQL["ancestry_breaks_forked"] = ORACLE_SQL["ancestry_breaks"]
