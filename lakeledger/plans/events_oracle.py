"""DuckDB SQL of the queries in ``events``."""

from __future__ import annotations

from lakeledger.plans.oracle import BRONZE_COLS, ORACLE as BASE
from lakeledger.plans.oracle import PRELUDE

_SESSIONS = """, timed AS (SELECT * FROM silver {where}),
marked AS (
    SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins
    FROM timed WINDOW w AS (PARTITION BY account_id ORDER BY event_time)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY account_id ORDER BY event_time) AS nr FROM marked),
sessions AS (
    SELECT account_id, min(event_time) AS started_at, max(event_time) AS last_at, count(*) AS transactions,
        CAST(sum(amount_minor) AS BIGINT) AS total_amount_minor, count(DISTINCT counterparty_id) AS counterparties
    FROM numbered GROUP BY account_id, nr)
"""
#: Where a stream's watermark ends up: the newest time in whole milliseconds, less the delay.
_LINE = "(SELECT date_trunc('milliseconds', max({time})) - INTERVAL {hours} HOUR FROM {rows})"

ORACLE = {
    "bitmap_missing": BASE["offset_missing"],
    "bitmap_gaps": BASE["offset_gaps"],
    "bitmap_reconcile": BASE["offset_reconcile"],
    "asof_counterparty": PRELUDE + """, r AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id, event_time ORDER BY kafka_partition DESC, kafka_offset DESC) AS nth FROM silver)
    WHERE nth = 1)
SELECT l.transaction_id, l.counterparty_id, l.event_time, r.event_time AS asof_event_time, r.transaction_id AS asof_transaction_id,
    r.status AS asof_status, r.amount_minor AS asof_amount_minor
FROM silver l ASOF LEFT JOIN r ON l.counterparty_id = r.account_id AND l.event_time >= r.event_time""",
    "account_sessions": PRELUDE + _SESSIONS.format(where="") + "SELECT * FROM sessions",
    "stream_sessions": PRELUDE + _SESSIONS.format(where="WHERE event_time <= kafka_timestamp") + f"""
SELECT * EXCLUDE (counterparties) FROM sessions WHERE last_at + INTERVAL 6 HOUR <= {_LINE.format(time="event_time", hours=3, rows="timed")}""",
    "stream_pairs": PRELUDE + f""", timed AS (SELECT * FROM silver WHERE event_time <= kafka_timestamp),
p AS (SELECT account_id, transaction_id AS pending_id, event_time AS pending_at FROM timed WHERE status = 'PENDING'),
s AS (SELECT account_id, transaction_id AS settled_id, event_time AS settled_at FROM timed WHERE status = 'SETTLED'),
line AS (SELECT least({_LINE.format(time="pending_at", hours=3, rows="p")}, {_LINE.format(time="settled_at", hours=3, rows="s")}) AS passed)
SELECT p.account_id, pending_id, pending_at, settled_id, settled_at
FROM p LEFT JOIN s ON s.account_id = p.account_id AND settled_at >= pending_at AND settled_at <= pending_at + INTERVAL 1 DAY
WHERE settled_id IS NOT NULL OR pending_at + INTERVAL 1 DAY < (SELECT passed FROM line)""",
    "stream_mart": PRELUDE + f""", marks AS (SELECT *, least(event_time, kafka_timestamp) AS mark FROM silver)
SELECT CAST(event_time AS DATE) AS event_date, account_id, currency, count(*) AS transaction_count,
    CAST(sum(amount_minor) AS BIGINT) AS total_amount_minor, CAST(count_if(status = 'SETTLED') AS BIGINT) AS settled_count,
    CAST(count_if(is_late) AS BIGINT) AS late_count, max(ingested_at) AS last_ingested_at
FROM marks WHERE date_trunc('day', mark) + INTERVAL 1 DAY <= {_LINE.format(time="mark", hours=1, rows="marks")} GROUP BY 1, 2, 3""",
    "sketch_weeks": PRELUDE + """
SELECT CAST(date_trunc('week', ingest_date) AS DATE) AS week, count(*) AS messages, count(DISTINCT transaction_id) AS transactions,
    count(DISTINCT account_id) AS accounts, true AS ids_within, true AS accounts_within, true AS p50_lag_within, true AS p99_lag_within
FROM b GROUP BY 1""",
    "diff_replay": PRELUDE + f""", damaged AS (
    SELECT * FROM (SELECT {BRONZE_COLS} FROM b UNION ALL SELECT {BRONZE_COLS} FROM b WHERE ingest_date < DATE '2024-01-16')
    WHERE kafka_offset % 1000 <> 14),
whole AS (SELECT {BRONZE_COLS} FROM b)
SELECT {BRONZE_COLS}, count(*) AS copies FROM (SELECT * FROM damaged EXCEPT ALL SELECT * FROM whole) GROUP BY ALL
UNION ALL
SELECT {BRONZE_COLS}, -count(*) AS copies FROM (SELECT * FROM whole EXCEPT ALL SELECT * FROM damaged) GROUP BY ALL""",
}
