"""Oracle SQL: every registered query recomputed from the raw tables on flat columns.

Nothing here reads the JSON text (but for the digests of it): outcomes follow
from the rules the log was derived by. The SQL is plain DuckDB.
"""

from __future__ import annotations

import re

# --- the change log as flat columns, one row per delivered message -------------------------------

_FLAT = """
b AS (SELECT event_id AS n, user_id, event_type, CAST(floor(value) AS INTEGER) AS qty, epoch_us(ts) // 1000 AS commit_ms,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
        row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id) AS seq
      FROM events),
flat AS (SELECT n, user_id, qty, commit_ms, iso,
        CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
        CASE WHEN n % 89 = 7 THEN '' ELSE 'SKU-' || user_id END AS pid,
        'WH-' || (n % 3) AS wid,
        CASE WHEN n % 79 = 5 THEN 0 ELSE 2 * seq + (n * 7919) % 7 END AS ver,
        n % 97 = 13 AS broken,
        n % 2 = 0 AS canonical,
        CASE WHEN n % 40 = 3 THEN '' WHEN n % 40 = 7 THEN '0' ELSE CAST(n * 8 AS VARCHAR) END AS lsn,
        CASE WHEN n % 2 = 1 THEN 'warehouse_inventory-' || CASE WHEN n % 40 = 3 THEN '' WHEN n % 40 = 7 THEN '0' ELSE CAST(n * 8 AS VARCHAR) END || '-' || n
             WHEN seq % 7 IN (2, 3) THEN 'U' || user_id || '-' || (n % 3) || '-' || (seq // 7)
             WHEN seq % 11 = 5 THEN 'X' || user_id || '-' || seq ELSE 'E' || n END AS eid,
        CASE WHEN n % 2 = 0 AND n % 83 < 4 THEN 'v2' ELSE 'v3' END AS sver,
        CASE WHEN n % 2 = 0 THEN 0 ELSE n % 5 END AS reserved,
        CASE WHEN n % 2 = 0 THEN '' WHEN qty = 0 THEN 'OOS' ELSE 'ACTIVE' END AS raw_status,
        CASE WHEN n % 2 = 1 AND qty = 0 THEN 'OOS' ELSE 'ACTIVE' END AS status
      FROM b),
dl AS (SELECT n * 10 AS off, commit_ms + (n * 37) % 8000 AS log_ms, * FROM flat
       UNION ALL SELECT n * 10 + 1, commit_ms + (n * 37) % 8000 + 60000, * FROM flat WHERE n % 50 = 0
       UNION ALL SELECT n * 10 + 2, commit_ms + 90000000, * FROM flat WHERE n % 400 = 0),
lg AS (SELECT *, CAST(user_id % 12 AS INTEGER) AS part FROM dl)"""

_GATED = _FLAT + """,
g AS (SELECT *,
        CASE WHEN broken THEN 'decode_error' WHEN pid = '' THEN 'missing_required'
             WHEN op = 'd' OR ver = 0 THEN 'schema_breaking' END AS reason,
        CASE WHEN broken THEN 'json unmarshal: malformed JSON' WHEN pid = '' THEN 'missing product_id'
             WHEN op = 'd' THEN 'REQUIRED_FIELD_MISSING:after.available_qty'
             WHEN ver = 0 THEN 'REQUIRED_FIELD_MISSING:after.row_version' END AS detail,
        CASE WHEN broken OR pid = '' THEN NULL WHEN op = 'd' OR ver = 0 THEN 'breaking'
             WHEN sver = 'v2' THEN 'conditional' ELSE 'compatible' END AS decision
      FROM lg)"""



def _labels(where: str = "true", same: str = "m.id = kr.eid AND m.wid = kr.wid") -> str:
    """One event after the other by recursion over each product's rows, carrying what was applied so far.

    ``same`` says which earlier applied event an id repeats. No id is on two products.
    """
    return f"""
kr AS (SELECT off, pid, wid, eid, ver, log_ms, row_number() OVER (PARTITION BY pid ORDER BY off) AS i
       FROM g WHERE reason IS NULL AND {where}),
sq AS (
  SELECT off, pid, i, 'applied' AS result, [{{'id': eid, 'wid': wid, 'ver': ver, 'ms': log_ms}}] AS done FROM kr WHERE i = 1
  UNION ALL
  SELECT off, pid, i, result,
    CASE WHEN result = 'applied' THEN list_append(done, {{'id': eid, 'wid': wid, 'ver': ver, 'ms': log_ms}}) ELSE done END
  FROM (SELECT kr.*, sq.done,
          CASE WHEN len(list_filter(sq.done, lambda m: {same} AND kr.log_ms - m.ms < 86400000)) > 0 THEN 'skipped'
               WHEN len(list_filter(sq.done, lambda m: m.wid = kr.wid AND m.ver >= kr.ver)) > 0 THEN 'rejected'
               ELSE 'applied' END AS result
        FROM sq JOIN kr ON kr.pid = sq.pid AND kr.i = sq.i + 1))"""


def _outcomes(same: str = "m.id = kr.eid AND m.wid = kr.wid") -> str:
    return f"""{_GATED},{_labels(same=same)},
res AS (SELECT g.*, sq.result FROM g JOIN sq ON g.off = sq.off
        UNION ALL SELECT *, 'dlq' AS result FROM g WHERE reason IS NOT NULL),
oc AS MATERIALIZED (SELECT *, CASE WHEN result = 'applied' THEN log_ms - commit_ms END AS lat_ms FROM res)"""


_OUTCOMES = _outcomes()

# The final state by the definition "the last applied event", which is the one with the greatest version.
_STATE = _OUTCOMES + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY pid, wid ORDER BY ver DESC, off) AS rk FROM oc WHERE result = 'applied'),
st AS (SELECT pid AS product_id, wid AS warehouse_id, qty AS available_qty, CAST(reserved AS INTEGER) AS reserved_qty,
          status AS stock_status, ver AS row_version, eid AS last_event_id, commit_ms, log_ms AS updated_ms
       FROM ranked WHERE rk = 1)"""

# The message text itself, for the digests.
_TEXT = _GATED + """,
img AS (SELECT *, CASE WHEN canonical THEN concat('{"available_qty":', qty, ',"row_version":', ver, '}')
          ELSE concat('{"product_id":"', pid, '","warehouse_id":"', wid, '","available_qty":', qty, ',"reserved_qty":',
             reserved, ',"stock_status":"', raw_status, '","row_version":', ver, '}') END AS im FROM g),
full_text AS (SELECT *, CASE WHEN canonical THEN concat('{"event_id":"', eid, '","event_time":"', iso, '","op":"', op,
          '","product_id":"', pid, '","warehouse_id":"', wid, '","schema_version":"', sver, '","',
          CASE WHEN op = 'd' THEN 'before' ELSE 'after' END, '":', im, '}')
        ELSE concat('{"op":"', op, '","ts_ms":', commit_ms + 30,
          ',"source":{"db":"warehouse","schema":"public","table":"warehouse_inventory","txId":', n,
          CASE WHEN n % 40 = 3 THEN '' WHEN n % 40 = 7 THEN ',"lsn":null' WHEN n % 4 = 3 THEN concat(',"lsn":"', n * 8, '"')
            ELSE concat(',"lsn":', n * 8) END, ',"ts_ms":', commit_ms,
          '},"before":', CASE WHEN op = 'd' THEN im ELSE 'null' END, ',"after":',
          CASE WHEN op = 'd' THEN 'null' ELSE im END, '}') END AS whole FROM img),
tx AS (SELECT *, CASE WHEN broken THEN left(whole, length(whole) - 5) ELSE whole END AS text FROM full_text)"""

# --- source table and read model ------------------------------------------------------------------

_STOCK = """
wa AS (SELECT l_partkey AS p, 'SKU-' || l_partkey AS product_id, 'WH-' || l_suppkey AS warehouse_id,
         CAST(sum(l_quantity) AS INTEGER) AS q, count(*) AS v, epoch_us(max(l_shipdate)) // 1000 AS upd
       FROM lineitem GROUP BY l_partkey, l_suppkey),
we AS (SELECT p, product_id, warehouse_id, CASE WHEN p % 103 = 3 THEN q + 1 ELSE q END AS q,
         CASE WHEN p % 107 = 5 THEN v + 1 WHEN p % 109 = 9 THEN v - 1 ELSE v END AS v, upd
       FROM wa WHERE p % 101 <> 1),
mm AS (SELECT wa.product_id, wa.warehouse_id, wa.q AS warehouse_qty, we.q AS website_qty, wa.v AS warehouse_version,
         we.v AS website_version, wa.upd AS warehouse_updated_ms, we.upd + 2000 AS website_updated_ms, we.upd AS web_commit,
         CASE WHEN we.product_id IS NULL THEN 'missing_in_website' WHEN wa.v > we.v THEN 'website_behind'
              WHEN wa.v < we.v THEN 'website_ahead' ELSE 'value_mismatch' END AS reason
       FROM wa LEFT JOIN we ON wa.product_id = we.product_id AND wa.warehouse_id = we.warehouse_id
       WHERE we.product_id IS NULL OR wa.q <> we.q OR wa.v <> we.v)"""

_RES = """
rs AS (SELECT 'ORD-' || o_orderkey AS order_id, l_linenumber AS line_number, 'SKU-' || l_partkey AS product_id,
         'WH-' || l_suppkey AS warehouse_id, CAST(l_quantity AS INTEGER) AS quantity,
         CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END AS reservation_status,
         epoch_us(o_orderdate) // 1000 AS created_ms
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

# --- movements: the floor by recursion over each key's sequence, not by the closed form --------------

_LEDGER = """
mv AS (SELECT 'SKU-' || user_id AS product_id, event_id AS n,
         CAST(CASE event_type WHEN 'purchase' THEN -floor(value) WHEN 'view' THEN -3
              WHEN 'signup' THEN floor(value / 2) ELSE 10 END AS BIGINT) AS delta,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
led AS (SELECT product_id, n, delta, i, CAST(50 AS BIGINT) AS opening, greatest(0, 50 + delta) AS on_hand FROM mv WHERE i = 1
        UNION ALL
        SELECT mv.product_id, mv.n, mv.delta, mv.i, led.on_hand, greatest(0, led.on_hand + mv.delta)
        FROM led JOIN mv ON mv.product_id = led.product_id AND mv.i = led.i + 1)"""

# --- series on a 15-second grid -----------------------------------------------------------------------

_REASONS = ["decode_error", "missing_required", "schema_breaking", "projection_error", "no_mapping"]
_BOUNDS = ["0.1", "0.25", "0.5", "1", "2", "3", "5", "10", "30"]

_SERIES = _OUTCOMES + f""",
pt AS (SELECT (log_ms // 1000) // 15 * 15 AS bucket, * FROM oc),
sp AS (SELECT min(bucket) AS lo, max(bucket) AS hi FROM pt),
gd AS (SELECT unnest(generate_series(lo, hi, 15)) AS bucket FROM sp),
ag AS (SELECT bucket, count(*) AS received, count(*) FILTER (result = 'applied') AS applied,
         count(*) FILTER (result = 'skipped') AS skipped, count(*) FILTER (result = 'rejected') AS rejected,
         count(*) FILTER (result = 'dlq') AS dlq, count(*) FILTER (decision = 'conditional') AS warnings,
         {", ".join(f"count(*) FILTER (lat_ms <= {b} * 1000) AS c{i}" for i, b in enumerate(_BOUNDS))},
         {", ".join(f"count(*) FILTER (reason = '{r}') AS dlq_{r}" for r in _REASONS)},
         count(lat_ms) AS cn
       FROM pt GROUP BY bucket),
sr AS (SELECT gd.bucket, coalesce(received, 0) AS received, coalesce(applied, 0) AS applied,
         coalesce(skipped, 0) AS skipped, coalesce(rejected, 0) AS rejected, coalesce(dlq, 0) AS dlq,
         coalesce(warnings, 0) AS warnings,
         {", ".join(f"coalesce(dlq_{r}, 0) AS dlq_{r}" for r in _REASONS)},
         {", ".join(f"coalesce(c{i}, 0) AS c{i}" for i in range(len(_BOUNDS)))}, coalesce(cn, 0) AS cn
       FROM gd LEFT JOIN ag ON gd.bucket = ag.bucket)"""


def _over(column: str, seconds: int) -> str:
    return f"CAST(sum({column}) OVER (ORDER BY bucket RANGE BETWEEN {seconds - 15} PRECEDING AND CURRENT ROW) AS BIGINT)"


def _windowed(columns: dict[str, tuple[str, int]]) -> str:
    return ", ".join(f"{_over(c, w)} AS {name}" for name, (c, w) in columns.items())


def _quantile(q: str, prefix: str = "c") -> str:
    """Linear interpolation in the first bucket whose cumulative count reaches the rank."""
    rank = f"(CAST({q} AS DOUBLE) * {prefix}n)"
    arms = []
    for i, bound in enumerate(_BOUNDS):
        low = _BOUNDS[i - 1] if i else "0"
        below = f"{prefix}{i - 1}" if i else "0"
        arms.append(
            f"WHEN {prefix}{i} >= {rank} THEN CAST({low} AS DOUBLE) + (CAST({bound} AS DOUBLE) - CAST({low} AS DOUBLE))"
            f" * (({rank} - {below}) / ({prefix}{i} - {below}))"
        )
    return f"CASE WHEN {prefix}n = 0 THEN NULL {' '.join(arms)} ELSE CAST(30 AS DOUBLE) END"


def _latency_windows(label: str, seconds: int) -> str:
    columns = {f"{label}{i}": (f"c{i}", seconds) for i in range(len(_BOUNDS))}
    return _windowed({**columns, f"{label}n": ("cn", seconds)})


_TOTALS = _OUTCOMES + f""",
tt AS (SELECT {", ".join(f"count(*) FILTER (lat_ms <= {b} * 1000) AS c{i}" for i, b in enumerate(_BOUNDS))},
         count(lat_ms) AS cn, CAST(coalesce(sum(lat_ms), 0) AS BIGINT) AS total_ms, count(*) AS received,
         count(*) FILTER (result = 'applied') AS applied FROM oc)"""

_BUDGET = "(CAST(1 AS DOUBLE) - CAST(0.9995 AS DOUBLE))"

_BENCH = """
bench_days AS (SELECT event_type, CAST(day(ts) AS BIGINT) AS run, count(*) AS events_sent,
         CAST(epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000 AS DOUBLE) AS elapsed_seconds
       FROM events GROUP BY event_type, day(ts)),
bench AS (SELECT CASE WHEN event_type <> 'click' THEN event_type END AS scenario, events_sent,
         CAST(0 AS BIGINT) AS events_failed, elapsed_seconds,
         CASE WHEN elapsed_seconds > 0 THEN floor(CAST(100 AS DOUBLE) * events_sent / elapsed_seconds) / CAST(100 AS DOUBLE)
         END AS effective_rate, run FROM bench_days)"""


def _burn_sql() -> str:
    pairs = [
        ("fast", 3600, 300, 14.4, "page"),
        ("medium", 21600, 1800, 6, "page"),
        ("slow", 86400, 7200, 3, "ticket"),
        ("drip", 259200, 21600, 1, "ticket"),
    ]
    windows, arms = {}, []
    for name, long, short, factor, severity in pairs:
        for kind, w in (("l", long), ("s", short)):
            windows[f"{name}_{kind}r"] = ("received", w)
            windows[f"{name}_{kind}a"] = ("applied", w)
        burn = {
            k: f"coalesce(CASE WHEN {name}_{k}r > 0 THEN ({name}_{k}r - {name}_{k}a) / {name}_{k}r END / {_BUDGET}, 0)"
            for k in ("l", "s")
        }
        arms.append(
            f"SELECT bucket + 15 AS eval_ts, '{name}' AS pair, '{severity}' AS severity, {burn['l']} AS long_burn, "
            f"{burn['s']} AS short_burn, {burn['l']} > {factor} AND {burn['s']} > {factor} AS firing FROM w"
        )
    return f"WITH {_SERIES}, w AS (SELECT bucket, {_windowed(windows)} FROM sr) {' UNION ALL '.join(arms)}"


# Offsets carried forward by partition, at every step of the grid, summed.
_LAG_SERIES = """
cm AS (SELECT part, off, log_ms + 20000 + (n % 7) * 60000 AS at_ms FROM lg
       WHERE n % 5 = 0 AND NOT (part = 7 AND log_ms >= epoch_ms(TIMESTAMP '2024-01-20 00:00:00'))),
fo AS (SELECT part, min(off) - 1 AS start FROM lg GROUP BY part),
e0 AS (SELECT part, (log_ms // 1000) // 15 * 15 AS bucket, max(off) AS top FROM lg GROUP BY ALL),
e1 AS (SELECT part, bucket, max(top) OVER (PARTITION BY part ORDER BY bucket) AS top FROM e0),
c0 AS (SELECT part, (at_ms // 1000) // 15 * 15 AS bucket, max(off) AS top FROM cm GROUP BY ALL),
c1 AS (SELECT part, bucket, max(top) OVER (PARTITION BY part ORDER BY bucket) AS top FROM c0),
pg AS (SELECT gd.bucket, fo.part, fo.start FROM gd, fo),
backlog AS (SELECT pg.bucket, CAST(sum(coalesce(e1.top, start) - coalesce(c1.top, start)) AS BIGINT) AS lag
            FROM pg ASOF LEFT JOIN e1 ON pg.part = e1.part AND pg.bucket >= e1.bucket
                    ASOF LEFT JOIN c1 ON pg.part = c1.part AND pg.bucket >= c1.bucket GROUP BY pg.bucket)"""

_RUNS = """
ends AS (SELECT min(log_ms) AS first_ms, max(log_ms) AS last_ms FROM lg),
runs AS (SELECT first_ms + (last_ms - first_ms) * k // 4 AS ran_ms, (first_ms + (last_ms - first_ms) * k // 4) / 1000 AS ran,
           count(product_id) AS gauge, count(*) FILTER (product_id IN ('SKU-1', 'SKU-3')) AS critical
         FROM ends, (VALUES (1), (2), (3)) ks(k)
         LEFT JOIN mm ON k = 1 OR (k = 2 AND reason <> 'missing_in_website') OR (k = 3 AND reason = 'value_mismatch') GROUP BY ALL)"""


def _alert_sql() -> str:
    rules = [
        ("InventorySyncLatencySLOBurnFast", "page", 300, "q5 > 3 AND q60 > 3"),
        ("InventorySyncLatencySLOBurnSlow", "ticket", 1800, "q360 > 3"),
        ("InventoryConsumerLagHigh", "page", 600, "lag > 20000"),
        ("InventoryEventsThroughputZero", "page", 300, "applied5 = 0"),
        ("InventoryDLQSpike", "page", 300, " OR ".join(f"{r}5 / CAST(300 AS DOUBLE) > CAST(0.003 AS DOUBLE)" for r in _REASONS)),
        ("InventorySchemaWarningRising", "ticket", 900, "warn15 / CAST(900 AS DOUBLE) > CAST(0.001 AS DOUBLE)"),
        ("InventoryReconciliationMismatchHigh", "page", 600, "gauge > 5"),
    ]
    arms = " UNION ALL ".join(
        f"SELECT bucket, '{n}' AS alert, '{sev}' AS severity, {hold} AS hold, coalesce({cond}, false) AS active FROM sig"
        for n, sev, hold, cond in rules
    )
    windows = _windowed({"applied5": ("applied", 300), "warn15": ("warnings", 900)} | {f"{r}5": (f"dlq_{r}", 300) for r in _REASONS})
    return f"""WITH {_SERIES}, {_STOCK}, {_RUNS}, {_LAG_SERIES},
w AS (SELECT bucket, {windows}, {_latency_windows("a", 300)}, {_latency_windows("h", 3600)},
        {_latency_windows("s", 21600)} FROM sr),
sig AS (SELECT w.bucket, applied5, {', '.join(f'{r}5' for r in _REASONS)}, warn15, lag, gauge, {_quantile("0.95", "a")} AS q5, {_quantile("0.95", "h")} AS q60,
          {_quantile("0.95", "s")} AS q360
        FROM w LEFT JOIN backlog ON w.bucket = backlog.bucket ASOF LEFT JOIN runs ON w.bucket + 15 >= runs.ran),
ev AS ({arms}),
isl AS (SELECT *, sum(CASE WHEN active THEN 0 ELSE 1 END) OVER (PARTITION BY alert ORDER BY bucket) AS island FROM ev),
since AS (SELECT *, min(bucket) FILTER (active) OVER (PARTITION BY alert, island) AS since FROM isl)
SELECT bucket + 15 AS eval_ts, alert, severity, active, active AND bucket - since >= hold AS firing FROM since"""


def _website_check_rows() -> str:
    checks = {
        "chk_available_qty_nonneg": "q < 0",
        "chk_reserved_qty_nonneg": "false",
        "chk_row_version_positive": "v <= 0",
        "chk_stock_status_known": "false",
        "available_qty_int32": "q > 2147483647",
        "reserved_qty_int32": "false",
        "product_id_length": "length(product_id) > 100",
        "product_id_not_null": "product_id IS NULL",
        "warehouse_id_length": "length(warehouse_id) > 50",
        "warehouse_id_not_null": "warehouse_id IS NULL",
        "stock_status_length": "false",
        "stock_status_not_null": "false",
        "last_event_id_length": "length('seed-' || product_id || '-' || warehouse_id) > 150",
        "last_event_id_not_null": "false",
        "available_qty_not_null": "q IS NULL",
        "reserved_qty_not_null": "false",
        "row_version_not_null": "v IS NULL",
    }
    arms = [f"SELECT '{n}' AS constraint_name, count(*) FILTER ({c}) AS violations FROM we" for n, c in checks.items()]
    arms.append("SELECT 'chk_warehouse_available_qty_nonneg', count(*) FILTER (q < 0) FROM wa")
    return " UNION ALL ".join(arms)


def _audit_day(ms: str) -> str:
    return f"CAST(CAST(make_timestamp({ms} * 1000) AS DATE) AS VARCHAR)"


_COMMIT = "CASE WHEN broken THEN log_ms ELSE commit_ms END"
_AUDIT_WINDOW = f"{_COMMIT} BETWEEN epoch_ms(TIMESTAMP '2024-01-10 06:30:00') AND epoch_ms(TIMESTAMP '2024-01-14 06:30:00')"
_OUTCOME_COLUMNS = """SELECT off, CASE WHEN NOT broken THEN eid END AS event_id, result, reason, detail,
    decision AS schema_decision, lat_ms AS latency_ms FROM oc"""
_OUTCOME_ROWS = f"WITH {_OUTCOMES} {_OUTCOME_COLUMNS}"
_STATE_ROWS = (
    "product_id, warehouse_id, available_qty, stock_status, row_version, last_event_id, commit_ms, updated_ms"
)
_LAG = f"""lag AS (SELECT part, max(off) AS end_offset, min(off) AS first_offset,
    max(off) FILTER (log_ms < epoch_ms(TIMESTAMP '2024-01-28 00:00:00')) AS committed_offset FROM lg GROUP BY part)"""
_TOPIC = "'cdc.inventory.warehouse'"


_CLAMPS = _LEDGER + """,
cl AS (SELECT (epoch_us(ts) // 1000000) // 15 * 15 AS bucket, count(*) AS clamps, CAST(sum(on_hand - (opening + delta)) AS BIGINT) AS absorbed
       FROM led JOIN events ON event_id = n WHERE on_hand > opening + delta GROUP BY 1)"""


def _triage_sql() -> str:
    high = "sum(CASE WHEN {} THEN 1 ELSE 0 END) OVER (ORDER BY bucket RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) = 41"
    triage = {
        "applied10": ("applied", 600), "dlq5": ("dlq", 300), "warn15": ("warnings", 900),
        "received2h": ("received", 7200), "applied2h": ("applied", 7200), "clamps10": ("clamps", 600),
    }
    return f"""WITH {_SERIES}, {_STOCK}, {_RUNS}, {_LAG_SERIES}, {_CLAMPS},
so AS (SELECT sr.*, coalesce(clamps, 0) AS clamps FROM sr LEFT JOIN cl ON sr.bucket = cl.bucket),
w AS (SELECT bucket, {_windowed(triage)}, {_latency_windows("a", 300)} FROM so),
sig AS (SELECT w.*, {_quantile("0.95", "a")} AS p95, lag, critical FROM w LEFT JOIN backlog ON w.bucket = backlog.bucket
        ASOF LEFT JOIN runs ON w.bucket + 15 >= runs.ran),
hd AS (SELECT *, {high.format("p95 > 3")} AS slow, {high.format("lag > 20000")} AS lagging FROM sig)
SELECT bucket + 15 AS eval_ts, CASE WHEN applied10 = 0 OR coalesce(critical > 0, false) OR clamps10 > 1 THEN 'SEV-1'
  WHEN slow OR dlq5 > 1 OR lagging THEN 'SEV-2'
  WHEN warn15 > 0 OR (CASE WHEN received2h > 0 THEN (received2h - applied2h) / received2h END) / {_BUDGET} > 3
  THEN 'SEV-3' END AS severity FROM hd"""


# --- days, and windows of 28 of them ------------------------------------------------------------------

def _day_window(column: str) -> str:
    return f"CAST(sum({column}) OVER (ORDER BY bucket RANGE BETWEEN {27 * 86400} PRECEDING AND CURRENT ROW) AS BIGINT)"


_DAYS = _OUTCOMES + f""",
d0 AS (SELECT (log_ms // 86400000) * 86400 AS bucket, count(*) AS received, count(*) FILTER (result = 'applied') AS applied,
         {", ".join(f"count(*) FILTER (lat_ms <= {b} * 1000) AS c{i}" for i, b in enumerate(_BOUNDS))}, count(lat_ms) AS cn FROM oc GROUP BY 1),
d1 AS (SELECT unnest(generate_series(min(bucket), max(bucket), 86400)) AS bucket FROM d0),
d2 AS (SELECT d1.bucket, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ["received", "applied", *(f"c{i}" for i in range(len(_BOUNDS))), "cn"])}
       FROM d1 LEFT JOIN d0 ON d1.bucket = d0.bucket),
dw AS (SELECT bucket, received, applied, {_day_window("received")} AS received_w, {_day_window("applied")} AS applied_w,
         {", ".join(f"{_day_window(f'c{i}')} AS t{i}" for i in range(len(_BOUNDS)))}, {_day_window("cn")} AS tn FROM d2)"""


def _daily_objectives_sql() -> str:
    rows = [
        ("freshness_p95", "p95", "3", "<="), ("freshness_p99", "p99", "5", "<="), ("successful_processing", "ok", "0.9995", ">="),
        ("mismatch_rate", "bad", "0.001", "<="), ("sla_freshness_p95", "p95", "5", "<="), ("sla_freshness_p99", "p99", "10", "<="),
    ]
    arms = " UNION ALL ".join(
        f"SELECT bucket + 86400 AS eval_ts, '{n}' AS slo, {v} AS value, CAST({t} AS DOUBLE) AS target, {v} {op} CAST({t} AS DOUBLE) AS met FROM v"
        for n, v, t, op in rows
    )
    return f"""WITH {_DAYS}, {_STOCK}, {_RUNS},
lr AS (SELECT (ran_ms // 86400000) * 86400 AS bucket, arg_max(gauge, ran_ms) AS gauge FROM runs GROUP BY 1),
v AS (SELECT dw.bucket, {_quantile("0.95", "t")} AS p95, {_quantile("0.99", "t")} AS p99,
        CASE WHEN received_w > 0 THEN applied_w / received_w END AS ok, gauge / CAST(1000 AS DOUBLE) AS bad
      FROM dw LEFT JOIN lr ON dw.bucket = lr.bucket) {arms}"""


def _budget_columns(suffix: str, label: str) -> str:
    allowed, consumed = f"received{suffix} * {_BUDGET}", f"(received{suffix} - applied{suffix})"
    return (
        f"received{suffix} AS received_{label}, round({allowed}, 4) AS allowed_{label}, {consumed} AS consumed_{label}, "
        f"round({allowed} - {consumed}, 4) AS remaining_{label}"
    )


# --- offsets counted against those of the log -----------------------------------------------------------

_COUNTED = _OUTCOMES + """,
ct AS (SELECT (off // 10) % 12 AS part, (off // 10) // 12 AS o, result FROM oc WHERE (off // 10) // 12 % 97 NOT IN (5, 6)),
ex AS (SELECT event_id % 12 AS part, unnest(range(min(event_id // 12), max(event_id // 12) + 1)) AS o FROM events GROUP BY 1),
dv AS (SELECT part, o, count(*) AS deliveries, count(DISTINCT result) AS results FROM ct GROUP BY ALL),
lost AS (SELECT part, o, o - row_number() OVER (PARTITION BY part ORDER BY o) AS run FROM ex ANTI JOIN dv USING (part, o)),
gaps AS (SELECT CAST(part AS INTEGER) AS part, min(o) AS from_offset, max(o) AS to_offset, count(*) AS missing FROM lost GROUP BY lost.part, run)"""


def oracles() -> dict[str, str]:
    return {name: re.sub(r"^WITH (?!RECURSIVE)", "WITH RECURSIVE ", sql.strip()) for name, sql in _all().items()}


def _all() -> dict[str, str]:
    present = {
        "event_id": "true", "op": "true", "product_id": "pid <> ''", "warehouse_id": "true", "schema_version": "true",
        "event_time": "true", "after.available_qty": "op <> 'd'", "after.row_version": "op <> 'd' AND ver > 0",
        "after.colour": "false",
    }
    ledger = (
        f"WITH RECURSIVE {_LEDGER} SELECT product_id, n, delta, CAST(on_hand AS BIGINT) AS on_hand, i AS row_version FROM led"
    )
    return {
        # sources and sinks
        "s1_read_log": f"""WITH {_TEXT} SELECT {_TOPIC} AS topic, part AS "partition", off, 'SKU-' || user_id AS key, log_ms,
            CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest FROM tx""",
        "s2_source_table": f"""WITH {_STOCK} SELECT product_id, warehouse_id, q AS available_qty, CAST(0 AS INTEGER) AS reserved_qty,
            'ACTIVE' AS stock_status, v AS row_version, upd AS updated_ms FROM wa""",
        "s3_snapshot_events": f"""WITH {_STOCK} SELECT CAST(-1 AS BIGINT) AS off, 'r' AS op, 'warehouse_inventory-77-5' AS event_id,
            product_id, warehouse_id, CAST(q AS BIGINT) AS available_qty, v AS row_version,
            epoch_ms(TIMESTAMP '2024-02-01 00:00:00') AS event_ms FROM wa""",
        "s4_capture_columns": f"""WITH {_FLAT} SELECT off, CAST(CASE WHEN op = 'd' THEN qty END AS BIGINT) AS before_qty,
            CASE WHEN op = 'd' THEN ver END AS before_version, CAST(CASE WHEN op <> 'd' THEN qty END AS BIGINT) AS after_qty,
            CASE WHEN op <> 'd' THEN ver END AS after_version, CAST(2 AS INTEGER) AS columns
            FROM lg WHERE NOT broken AND NOT canonical""",
        "s5_route_topic": f"""WITH {_FLAT} SELECT CASE WHEN part % 3 = 0 THEN 'cdc.inventory.public.warehouse_inventory.old'
            ELSE 'cdc.inventory.warehouse' END AS topic, part AS "partition", count(*) AS messages FROM lg GROUP BY 1, 2""",
        "s7_merge_state": f"WITH {_STATE} SELECT product_id, warehouse_id, available_qty, row_version FROM st",
        "s8_dlq_sink": f"""WITH {_TEXT} SELECT 'cdc.inventory.dlq' AS topic, 'SKU-' || user_id AS key, reason AS reason_header,
            {_TOPIC} AS topic_header, part AS "partition", off, CASE WHEN NOT broken THEN eid END AS event_id, reason,
            log_ms AS failed_ms, md5(text) AS digest FROM tx WHERE reason IS NOT NULL""",
        "s9_audit_history": f"""WITH {_FLAT} SELECT {_audit_day(f"({_COMMIT})")} AS event_date, count(*) AS events,
            count(DISTINCT (off // 5000) % 2) AS batches, min(off) AS first_off, max(off) AS last_off FROM lg GROUP BY 1""",
        "s10_read_bench_runs": f"WITH {_BENCH} SELECT * FROM bench",
        "s11_tolerant_parse": f"""WITH {_FLAT} SELECT part AS "partition", off, CAST(off AS VARCHAR) AS offset_header,
            'VALUE_CONVERTER' AS stage FROM lg WHERE broken""",
        "s12_seed_missing": f"""WITH {_STOCK} SELECT product_id, warehouse_id, q AS available_qty, v AS row_version,
            'seed-' || product_id || '-' || warehouse_id AS last_event_id, upd AS commit_ms FROM we
            UNION ALL SELECT product_id, warehouse_id, q, v, 'seed-' || product_id || '-' || warehouse_id,
            epoch_ms(TIMESTAMP '2024-02-01 00:00:00') FROM wa WHERE p % 101 = 1""",
        # decode
        "p1_probe_envelope": f"""WITH {_FLAT} SELECT off, CASE WHEN NOT broken THEN CASE WHEN canonical THEN 'canonical'
            ELSE 'debezium' END END AS envelope, CASE WHEN broken THEN 'json unmarshal: malformed JSON' END AS decode_error FROM lg""",
        "p2_decode_canonical": f"""WITH {_FLAT} SELECT off, eid AS event_id, commit_ms AS event_ms, op, pid AS product_id,
            wid AS warehouse_id, sver AS schema_version, CAST(CASE WHEN op = 'd' THEN qty END AS BIGINT) AS before_qty,
            CASE WHEN op = 'd' THEN ver END AS before_version, CAST(CASE WHEN op <> 'd' THEN qty END AS BIGINT) AS after_qty,
            CASE WHEN op <> 'd' THEN ver END AS after_version FROM lg WHERE canonical AND NOT broken""",
        "p3_decode_debezium": f"""WITH {_FLAT} SELECT off, op, 'warehouse' AS db, 'public' AS schema,
            'warehouse_inventory' AS table_name, n AS tx_id,
            CAST(CASE WHEN op = 'd' THEN qty END AS BIGINT) AS before_qty, CASE WHEN op = 'd' THEN reserved END AS before_reserved,
            CASE WHEN op = 'd' THEN raw_status END AS before_status, CASE WHEN op = 'd' THEN ver END AS before_version,
            CAST(CASE WHEN op <> 'd' THEN qty END AS BIGINT) AS after_qty, CASE WHEN op <> 'd' THEN reserved END AS after_reserved,
            CASE WHEN op <> 'd' THEN raw_status END AS after_status, CASE WHEN op <> 'd' THEN ver END AS after_version
            FROM lg WHERE NOT canonical AND NOT broken""",
        "p4_derive_event_id": f"""WITH {_FLAT} SELECT off, 'warehouse_inventory-' || lsn || '-' || n AS event_id
            FROM lg WHERE NOT canonical AND NOT broken""",
        "p5_derive_event_time": f"""WITH {_FLAT} SELECT off, commit_ms AS event_ms, commit_ms AS source_ms
            FROM lg WHERE NOT canonical AND NOT broken""",
        "p6_normalize_lsn": f"WITH {_FLAT} SELECT off, lsn FROM lg WHERE NOT canonical AND NOT broken",
        "p7_promote_keys": f"""WITH {_FLAT} SELECT off, op, pid AS product_id, wid AS warehouse_id
            FROM lg WHERE NOT canonical AND NOT broken""",
        "p8_default_schema_version": f"""WITH {_FLAT} SELECT CASE WHEN canonical THEN 'canonical' ELSE 'debezium' END AS envelope,
            sver AS schema_version, count(*) AS events FROM lg WHERE NOT broken GROUP BY 1, 2""",
        "p9_latest_row": f"""WITH {_FLAT} SELECT off, CAST(qty AS BIGINT) AS available_qty, ver AS row_version
            FROM lg WHERE NOT broken""",
        "p10_projection_defaults": f"""WITH {_FLAT} SELECT off, NOT broken AS has_image,
            CASE WHEN broken THEN 'ACTIVE' ELSE status END AS stock_status, {_COMMIT} AS commit_ms FROM lg""",
        "p11_attach_position": f"""WITH {_FLAT} SELECT {_TOPIC} AS topic, part, off, CASE WHEN NOT broken THEN eid END AS event_id
            FROM lg""",
        # gates
        "v1_required_fields": f"""WITH {_FLAT} SELECT off, CASE WHEN pid = '' THEN 'missing product_id' END AS missing
            FROM lg WHERE NOT broken""",
        "v2_schema_guard": f"""WITH {_GATED} SELECT off, decision, CASE decision WHEN 'breaking' THEN 'REQUIRED_FIELD_MISSING'
            WHEN 'conditional' THEN 'SCHEMA_VERSION_DRIFT' END AS reason, CASE WHEN op = 'd' THEN 'after.available_qty'
            WHEN ver = 0 THEN 'after.row_version' WHEN sver = 'v2' THEN 'schema_version' END AS field, 'v3' AS contract
            FROM g WHERE NOT broken AND pid <> ''""",
        "v3_field_present": f"WITH {_FLAT} " + " UNION ALL ".join(
            f"SELECT '{p}' AS path, count(*) FILTER ({c}) AS present FROM lg WHERE NOT broken" for p, c in present.items()
        ),
        "v4_constraint_violations": f"""WITH {_FLAT} SELECT off, 'chk_row_version_positive' AS violations
            FROM lg WHERE NOT broken AND ver = 0""",
        "v5_validate_constraints": f"WITH {_STOCK} {_website_check_rows()}",
        "v6_route_dlq": f"WITH {_GATED} SELECT reason AS dlq_reason, detail AS dlq_detail, count(*) AS events FROM g GROUP BY 1, 2",
        "v7_dlq_envelope": f"""WITH {_TEXT} SELECT {_TOPIC} AS original_topic, part AS original_partition, off,
            CASE WHEN NOT broken THEN eid END AS event_id, reason, detail AS reason_detail, log_ms AS failed_ms,
            CAST(length(text) AS INTEGER) AS chars FROM tx WHERE reason IS NOT NULL""",
        "v8_contract_types": f"""WITH {_FLAT} SELECT off, CASE WHEN NOT broken AND op <> 'd' THEN 'after.available_qty'
            ELSE '' END AS type_errors FROM lg""",
        "v9_unknown_fields": f"""WITH {_FLAT} SELECT off, CASE WHEN NOT broken AND n % 7 = 0 THEN 'batch,colour' ELSE '' END
            AS unknown FROM lg""",
        "v10_apply_mapping": f"WITH {_FLAT} SELECT off, CAST(qty AS BIGINT) AS available_qty FROM lg WHERE NOT broken",
        # dedupe, order, upsert
        "d1_was_applied": f"""WITH {_GATED},{_labels("off % 10 = 0")},
            m AS (SELECT eid, pid, wid, max(log_ms) AS marked FROM g JOIN sq USING (off, pid) WHERE result = 'applied' GROUP BY ALL)
            SELECT g.off, g.eid AS event_id, coalesce(g.log_ms - m.marked < 86400000, false) AS seen
            FROM g LEFT JOIN m ON g.eid = m.eid AND g.pid = m.pid AND g.wid = m.wid WHERE g.reason IS NULL AND g.off % 10 <> 0""",
        "d1_was_applied_by_id": f"""WITH {_GATED},{_labels("off % 10 = 0", "m.id = kr.eid")},
            m AS (SELECT eid, max(log_ms) AS marked FROM g JOIN sq USING (off, pid) WHERE result = 'applied' GROUP BY ALL)
            SELECT g.off, g.eid AS event_id, coalesce(g.log_ms - m.marked < 86400000, false) AS seen
            FROM g LEFT JOIN m ON g.eid = m.eid WHERE g.reason IS NULL AND g.off % 10 <> 0""",
        "d2_mark_applied": f"""WITH {_OUTCOMES} SELECT 'cdc:applied:' || eid AS mark, pid AS product_id, wid AS warehouse_id,
            max(log_ms) AS marked_ms FROM oc WHERE result = 'applied' GROUP BY eid, pid, wid
            HAVING max(log_ms) > epoch_ms(TIMESTAMP '2024-01-20 00:00:00') - 86400000""",
        "d3_versioned_upsert": f"WITH {_STATE} SELECT * FROM st",
        "d4_event_outcomes": _OUTCOME_ROWS,
        "d4_event_outcomes_in_blocks": _OUTCOME_ROWS,
        "d4_event_outcomes_by_id": f"WITH {_outcomes('m.id = kr.eid')} {_OUTCOME_COLUMNS}",
        "d4_id_conflicts": f"""WITH {_GATED} SELECT eid AS event_id, pid AS product_id, wid AS warehouse_id, min(ver) AS lowest,
            max(ver) AS highest FROM g WHERE reason IS NULL GROUP BY ALL HAVING min(ver) <> max(ver)""",
        "d4_result_counts": f"WITH {_OUTCOMES} SELECT result, reason, count(*) AS events FROM oc GROUP BY 1, 2",
        "d5_apply_delete": f"""WITH {_FLAT}, rk AS (SELECT *, row_number() OVER (PARTITION BY pid, wid ORDER BY ver DESC, off) AS r
            FROM lg WHERE NOT broken AND pid <> '' AND ver > 0)
            SELECT pid AS product_id, wid AS warehouse_id, qty AS available_qty,
            CASE WHEN op = 'd' THEN 'DELETED' ELSE status END AS stock_status, ver AS row_version, eid AS last_event_id
            FROM rk WHERE r = 1""",
        "d6_ordering_check": f"""WITH {_GATED}, p AS (SELECT *, max(ver) OVER (PARTITION BY pid, wid ORDER BY off
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv FROM g WHERE reason IS NULL)
            SELECT off, pid AS product_id, wid AS warehouse_id, ver AS row_version, pv AS previous_version,
            true AS version_not_newer, false AS partition_changed FROM p WHERE ver <= pv""",
        "d7_sync_latency": f"""WITH {_OUTCOMES} SELECT off, eid AS event_id, lat_ms / CAST(1000 AS DOUBLE) AS latency_seconds
            FROM oc WHERE result = 'applied'""",
        # reconcile and replay
        "r1_reconcile": f"""WITH {_STOCK} SELECT product_id, warehouse_id, warehouse_qty, website_qty, warehouse_version,
            website_version FROM mm ORDER BY product_id, warehouse_id""",
        "r2_mismatch_view": f"""WITH {_STOCK} SELECT product_id, warehouse_id, warehouse_qty, website_qty, warehouse_version,
            website_version, warehouse_updated_ms, website_updated_ms, reason FROM mm""",
        "r3_mismatch_by_reason": f"""WITH {_STOCK} SELECT reason, count(*) AS mismatches FROM mm GROUP BY reason
            ORDER BY mismatches DESC, reason""",
        "r4_replay_window": f"""WITH {_STOCK} SELECT min(web_commit) AS since_ms, max(web_commit) AS until_ms FROM mm
            WHERE reason <> 'missing_in_website'""",
        "r5_replay_from_audit": f"""WITH {_TEXT} SELECT {_TOPIC} AS topic, part AS "partition", off, 'SKU-' || user_id AS key,
            md5(text) AS digest FROM tx WHERE {_AUDIT_WINDOW}""",
        "r5_replay_dry_run": f"WITH {_FLAT} SELECT count(*) AS events FROM lg WHERE {_AUDIT_WINDOW}",
        "r6_replay_dlq": f"""WITH {_GATED} SELECT off, CASE WHEN broken THEN 'decode_error' WHEN pid = '' THEN 'missing_required'
            WHEN ver = 0 THEN 'projection_error' END AS dlq_reason, CASE WHEN NOT broken THEN op END AS op,
            CAST(CASE WHEN NOT broken THEN qty END AS BIGINT) AS available_qty FROM g
            WHERE reason IS NOT NULL AND log_ms >= epoch_ms(TIMESTAMP '2024-01-15 00:00:00')""",
        "r6_first_failures": f"""WITH {_GATED} SELECT off, min(log_ms) AS failed_ms, count(*) AS deliveries FROM g
            WHERE reason IS NOT NULL GROUP BY part, off""",
        "r7_mismatch_gauge": f"WITH {_STOCK} SELECT count(*) AS gauge, count(*) AS mismatches FROM mm",
        "r8_scheduled_reconcile": f"""WITH {_STOCK} SELECT epoch_ms(TIMESTAMP '2024-02-01 00:00:00') AS run_ms, reason,
            count(*) AS mismatches FROM mm GROUP BY reason""",
        "r9_dlq_investigate": f"""WITH {_GATED}, k AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY log_ms, part, off) AS k
            FROM g WHERE reason IS NOT NULL) SELECT off, reason, detail AS reason_detail FROM k WHERE k <= 5""",
        # read model
        "q1_by_product": f"WITH {_STATE} SELECT {_STATE_ROWS} FROM st WHERE product_id = 'SKU-7'",
        "q1_by_product_and_warehouse": f"""WITH {_STATE} SELECT {_STATE_ROWS} FROM st
            WHERE product_id = 'SKU-7' AND warehouse_id = 'WH-1'""",
        "q2_by_status": f"WITH {_STATE} SELECT {_STATE_ROWS} FROM st WHERE stock_status = 'OOS'",
        "q2_status_counts": f"WITH {_STATE} SELECT stock_status, count(*) AS items FROM st GROUP BY 1",
        "q3_recently_updated": f"""WITH {_STATE} SELECT {_STATE_ROWS} FROM st
            ORDER BY updated_ms DESC, product_id, warehouse_id LIMIT 20""",
        "q4_by_commit_recency": f"""WITH {_STATE} SELECT {_STATE_ROWS} FROM st
            ORDER BY commit_ms DESC, product_id, warehouse_id LIMIT 20""",
        "q5_reservations_for_order": f"""WITH {_RES} SELECT order_id, line_number, product_id, warehouse_id, quantity,
            reservation_status, created_ms FROM rs WHERE order_id = 'ORD-7'""",
        "q6_reservations_for_sku": f"""WITH {_RES}, k AS (SELECT *, CAST(row_number() OVER (PARTITION BY product_id, warehouse_id
            ORDER BY created_ms DESC, order_id, line_number, quantity DESC, reservation_status) AS INTEGER) AS rank FROM rs)
            SELECT product_id, warehouse_id, rank, order_id, line_number, quantity, reservation_status, created_ms
            FROM k WHERE rank <= 2""",
        "q7_source_recency": f"""WITH {_STOCK} SELECT product_id, warehouse_id, q AS available_qty, v AS row_version,
            upd AS updated_ms FROM wa ORDER BY upd DESC, product_id, warehouse_id LIMIT 20""",
        # metrics
        "m1_outcome_counts": f"""WITH {_OUTCOMES} SELECT result, count(*) AS events FROM oc GROUP BY 1
            UNION ALL SELECT 'received', count(*) FROM oc""",
        "m1_outcome_counts_by_partition": f"""WITH {_OUTCOMES} SELECT part, result, count(*) AS events FROM oc GROUP BY 1, 2
            UNION ALL SELECT part, 'received', count(*) FROM oc GROUP BY 1""",
        "m2_latency_histogram": f"WITH {_TOTALS} " + " UNION ALL ".join(
            f"SELECT '{label}' AS le, {c} AS events, total_ms / CAST(1000 AS DOUBLE) AS latency_sum, cn AS latency_count FROM tt"
            for label, c in [
                *[(b if "." in b else f"{b}.0", f"c{i}") for i, b in enumerate(_BOUNDS)], ("+Inf", "cn"),
            ]
        ),
        "m3_histogram_quantile": f"WITH {_TOTALS} " + " UNION ALL ".join(
            f"SELECT CAST({q} AS DOUBLE) AS q, {_quantile(q)} AS latency_seconds FROM tt" for q in ("0.5", "0.95", "0.99")
        ),
        "m4_event_rate": f"""WITH {_SERIES} SELECT bucket + 15 AS eval_ts, {_over("applied", 60)} / CAST(60 AS DOUBLE) AS rate
            FROM sr""",
        "m5_dlq_by_reason": f"WITH {_SERIES}, w AS (SELECT bucket, "
        + _windowed({f"{r}_w": (f"dlq_{r}", 3600) for r in _REASONS})
        + " FROM sr) "
        + " UNION ALL ".join(f"SELECT bucket + 15 AS eval_ts, '{r}' AS reason, {r}_w AS events FROM w WHERE {r}_w > 0" for r in _REASONS),
        "m6_schema_warning_count": f"""WITH {_SERIES}, w AS (SELECT bucket, {_windowed({"n": ("warnings", 3600)})} FROM sr)
            SELECT bucket + 15 AS eval_ts, n AS warnings FROM w WHERE n > 0""",
        "m7_consumer_lag": f"""WITH {_FLAT}, {_LAG} SELECT {_TOPIC} AS topic, part AS "partition", end_offset, committed_offset,
            end_offset - coalesce(committed_offset, first_offset - 1) AS lag FROM lag""",
        "m7_topic_lag": f"""WITH {_FLAT}, {_LAG} SELECT {_TOPIC} AS topic,
            CAST(sum(end_offset - coalesce(committed_offset, first_offset - 1)) AS BIGINT) AS lag FROM lag""",
        "m7_lag_series": f"""WITH {_SERIES}, {_LAG_SERIES} SELECT {_TOPIC} AS topic, bucket + 15 AS eval_ts, lag FROM backlog""",
        "m7_capture_backlog": f"""WITH {_SERIES},
            moves AS (SELECT (ms // 1000) // 15 * 15 AS bucket, 1 AS d FROM (SELECT CASE WHEN broken THEN log_ms ELSE commit_ms END AS ms FROM oc)
              UNION ALL SELECT (log_ms // 1000) // 15 * 15, -1 FROM oc UNION ALL SELECT bucket, 0 FROM sr),
            held AS (SELECT bucket, CAST(sum(sum(d)) OVER (ORDER BY bucket) AS BIGINT) AS events FROM moves GROUP BY bucket)
            SELECT bucket + 15 AS eval_ts, events FROM held JOIN gd USING (bucket)""",
        "m8_success_rate": f"""WITH {_SERIES}, w AS (SELECT bucket, {_windowed({n: (n, 300) for n in
            ("received", "applied", "skipped", "rejected", "dlq")})} FROM sr)
            SELECT bucket + 15 AS eval_ts, (applied / CAST(300 AS DOUBLE))
              / greatest((received + applied + skipped + rejected + dlq) / CAST(300 AS DOUBLE), CAST(1 AS DOUBLE)) AS panel_success_rate,
            CASE WHEN received > 0 THEN applied / received END AS slo_success_rate FROM w""",
        "m9_slo_report": f"""WITH {_TOTALS}, {_STOCK}, v AS (SELECT {_quantile("0.95")} AS p95, {_quantile("0.99")} AS p99,
            applied / received AS ok, (SELECT count(*) FROM mm) / CAST(1000 AS DOUBLE) AS bad FROM tt)
            SELECT 'freshness_p95' AS slo, p95 AS value, CAST(3 AS DOUBLE) AS target, p95 <= 3 AS met FROM v
            UNION ALL SELECT 'freshness_p99', p99, 5, p99 <= 5 FROM v
            UNION ALL SELECT 'successful_processing', ok, CAST(0.9995 AS DOUBLE), ok >= CAST(0.9995 AS DOUBLE) FROM v
            UNION ALL SELECT 'mismatch_rate', bad, CAST(0.001 AS DOUBLE), bad <= CAST(0.001 AS DOUBLE) FROM v
            UNION ALL SELECT 'sla_freshness_p95', p95, 5, p95 <= 5 FROM v
            UNION ALL SELECT 'sla_freshness_p99', p99, 10, p99 <= 10 FROM v""",
        "m10_error_budget": f"""WITH {_TOTALS} SELECT received, round(received * {_BUDGET}, 4) AS allowed,
            received - applied AS consumed, round(received * {_BUDGET} - (received - applied), 4) AS remaining,
            round(received * {_BUDGET} / days, 4) AS allowed_per_day, round(received * {_BUDGET} / days * CAST(28 AS DOUBLE), 4) AS allowed_per_window
            FROM tt, (SELECT count(DISTINCT log_ms // 86400000) AS days FROM oc)""",
        "m9_daily_objectives": _daily_objectives_sql(),
        "m10_daily_budget": f"WITH {_DAYS} SELECT bucket + 86400 AS eval_ts, {_budget_columns('', 'day')}, {_budget_columns('_w', 'window')} FROM dw",
        "m9_offset_gaps": f"WITH {_COUNTED} SELECT * FROM gaps",
        "m9_repeated_offsets": f"WITH {_COUNTED} SELECT CAST(part AS INTEGER) AS part, o AS off, deliveries, results FROM dv WHERE deliveries > 1",
        "m9_no_silent_loss": f"""WITH {_COUNTED} SELECT 'no_silent_loss' AS slo, CAST(count(*) AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS target,
            count(*) = 0 AS met FROM lost""",
        "m9_conservation": f"""WITH {_COUNTED},
            wanted AS (SELECT part, count(*) AS expected FROM ex GROUP BY 1),
            counted AS (SELECT part, count(*) AS accounted, count(*) FILTER (deliveries > 1) AS repeated, count(*) FILTER (results > 1) AS conflicting
                  FROM dv GROUP BY 1),
            summed AS (SELECT part, count(*) AS received, {", ".join(f"count(*) FILTER (result = '{r}') AS {r}" for r in ("applied", "skipped", "rejected", "dlq"))}
                  FROM ct GROUP BY 1)
            SELECT CAST(wanted.part AS INTEGER) AS part, expected, accounted, expected - accounted AS missing, repeated, conflicting, received,
              applied, skipped, rejected, dlq, expected = accounted AND repeated = 0 AS conserved
            FROM wanted JOIN counted USING (part) JOIN summed USING (part)""",
        "m11_burn_rate": _burn_sql(),
        "m12_alert_rules": _alert_sql(),
        "m13_threshold_band": f"""WITH {_SERIES}, w AS (SELECT bucket, {_latency_windows("a", 300)} FROM sr),
            p AS (SELECT bucket, {_quantile("0.95", "a")} AS p95 FROM w)
            SELECT bucket + 15 AS eval_ts, CASE WHEN p95 IS NULL THEN NULL WHEN p95 >= 3 THEN 'red' WHEN p95 >= 2 THEN 'yellow'
            ELSE 'green' END AS latency_band, CASE WHEN p95 IS NULL THEN NULL WHEN p95 >= CAST(7.8 AS DOUBLE) THEN 'red'
            WHEN p95 >= 7 THEN 'yellow' ELSE 'green' END AS tight_band FROM p""",
        "m14_severity_triage": _triage_sql(),
        "m15_bench_summary": f"""WITH {_BENCH} SELECT coalesce(scenario, 'unknown') AS scenario, count(*) AS runs,
            round(avg(effective_rate), 2) AS rate_mean, round(stddev_pop(effective_rate), 2) AS rate_stdev,
            round(avg(events_sent), 2) AS events_sent_mean, CAST(sum(events_sent) AS BIGINT) AS events_sent_total
            FROM bench GROUP BY 1 HAVING count(effective_rate) > 0""",
        # ledger
        "l2_oversold_series": f"WITH {_CLAMPS} SELECT bucket + 15 AS eval_ts, clamps, absorbed FROM cl",
        "l1_floor_ledger": ledger,
        "l1_floor_ledger_in_blocks": ledger,
        "l2_negative_delta_clamps": f"""WITH RECURSIVE {_LEDGER} SELECT product_id, n, delta,
            CAST(on_hand - (opening + delta) AS BIGINT) AS absorbed FROM led WHERE on_hand > opening + delta""",
    }
