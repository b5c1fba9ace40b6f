"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

The oracle derives the structured log rows straight from ``events`` with the same
fixed arithmetic as the fixture (no JSON), then states each operator's meaning in
plain SQL. Integer sums are cast back to BIGINT (DuckDB widens them), and instants
stay TIMESTAMP (naive UTC), matching the Spark side's TIMESTAMP_NTZ.
"""

from __future__ import annotations

PRELUDE = """
WITH e AS (
    SELECT *, 0 AS copy FROM events
    UNION ALL
    SELECT *, 1 AS copy FROM events WHERE event_id % 20 = 7
),
w AS (
    SELECT
        event_id, copy, ts,
        event_id % 500 = 29 AS not_json,
        CASE WHEN event_id % 700 = 31 THEN NULL
             WHEN event_id % 750 = 71 THEN ''
             ELSE 'txn_' || lpad(CAST(event_id AS VARCHAR), 12, '0') END AS transaction_id,
        CASE WHEN event_id % 300 = 17 THEN NULL
             WHEN event_id % 450 = 19 THEN ''
             ELSE 'acc_' || lpad(CAST(user_id % 200 AS VARCHAR), 4, '0') END AS account_id,
        CASE WHEN event_id % 97 = 13 THEN NULL
             ELSE 'acc_' || lpad(CAST((user_id * 7 + event_id) % 200 AS VARCHAR), 4, '0')
        END AS counterparty_id,
        CAST(CASE WHEN event_id % 3 = 1 THEN ceil(value) ELSE round(value * 100) END AS BIGINT)
            * CASE WHEN event_id % 50 = 23 THEN -1 ELSE 1 END
            + CASE WHEN copy = 1 AND event_id % 200 = 47 THEN 1 ELSE 0 END AS amount_minor,
        CASE WHEN event_id % 211 = 5 THEN NULL
             WHEN event_id % 50 = 11 THEN 'XYZ'
             WHEN event_id % 3 = 0 THEN 'INR'
             WHEN event_id % 3 = 1 THEN 'JPY'
             ELSE 'USD' END AS currency,
        CASE WHEN event_id % 101 = 7 THEN 'TELEPORTED'
             WHEN event_type IN ('purchase', 'click') THEN 'SETTLED'
             WHEN event_type = 'view' THEN 'PENDING'
             WHEN event_type = 'error' THEN 'FAILED'
             WHEN event_type = 'signup' THEN 'CANCELLED'
             ELSE 'REFUNDED' END AS status,
        CASE WHEN event_id % 900 = 41 THEN NULL
             WHEN event_id % 650 = 61 THEN ts + INTERVAL 3 DAY
             WHEN event_id % 600 = 59 THEN ts
             WHEN event_id % 40 = 3 THEN ts - INTERVAL 2 HOUR
             ELSE ts END AS event_time,
        event_id % 900 <> 41 AND event_id % 650 <> 61 AND event_id % 600 = 59 AS naive,
        CAST((user_id + CASE WHEN event_id % 400 = 9 THEN 1 ELSE 0 END) % 6 AS INTEGER) AS kafka_partition,
        event_id * 2 + copy * 21 AS kafka_offset,
        ts + to_seconds(5 + 30 * copy) AS ingested_at
    FROM e
),
x AS (
    SELECT
        CASE WHEN not_json THEN NULL ELSE transaction_id END AS transaction_id,
        CASE WHEN not_json THEN NULL ELSE account_id END AS account_id,
        CASE WHEN not_json THEN NULL ELSE counterparty_id END AS counterparty_id,
        CASE WHEN not_json THEN NULL ELSE amount_minor END AS amount_minor,
        CASE WHEN not_json THEN NULL ELSE currency END AS currency,
        CASE WHEN not_json THEN NULL ELSE status END AS status,
        CASE WHEN not_json THEN NULL ELSE event_time END AS event_time,
        CASE WHEN not_json THEN NULL ELSE ts END AS produced_at,
        nullif(account_id, '') AS kafka_key,
        'txn.raw' AS kafka_topic,
        kafka_partition,
        kafka_offset,
        ts AS kafka_timestamp,
        ingested_at,
        CAST(ingested_at AS DATE) AS ingest_date,
        not_json,
        naive
    FROM w
),
b AS (
    SELECT * EXCLUDE (not_json, naive) FROM x
    WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL AND event_time IS NOT NULL
),
dlq AS (
    SELECT * EXCLUDE (not_json, naive),
        concat_ws(',',
            CASE WHEN transaction_id IS NULL THEN 'missing:transaction_id' END,
            CASE WHEN account_id IS NULL THEN 'missing:account_id' END,
            CASE WHEN event_time IS NULL THEN 'missing:event_time' END) AS dlq_reason
    FROM x
    WHERE transaction_id IS NULL OR account_id IS NULL OR event_time IS NULL
),
d AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY transaction_id ORDER BY kafka_partition, kafka_offset) AS rn
        FROM b) WHERE rn = 1
),
lt AS (
    SELECT *,
        (epoch_us(ingested_at) // 1000000) - (epoch_us(event_time) // 1000000) AS lateness_seconds
    FROM d
),
t AS (
    SELECT *, lateness_seconds > 300 AS is_late,
        concat_ws(',',
            CASE WHEN amount_minor IS NULL OR amount_minor <= 0 THEN 'non_positive_amount' END,
            CASE WHEN currency IS NULL OR currency NOT IN ('INR', 'JPY', 'USD')
                 THEN 'unknown_currency' END,
            CASE WHEN status IS NULL OR status NOT IN
                 ('CANCELLED', 'FAILED', 'PENDING', 'REFUNDED', 'SETTLED')
                 THEN 'unknown_status' END,
            CASE WHEN counterparty_id IS NULL THEN 'missing_counterparty' END
        ) AS quarantine_reason
    FROM lt
),
silver AS (SELECT * EXCLUDE (quarantine_reason) FROM t WHERE quarantine_reason = ''),
quarantine AS (SELECT * FROM t WHERE quarantine_reason <> ''),
mart AS (
    SELECT CAST(event_time AS DATE) AS event_date, account_id, currency,
        count(*) AS transaction_count,
        CAST(sum(amount_minor) AS BIGINT) AS total_amount_minor,
        CAST(count_if(status = 'SETTLED') AS BIGINT) AS settled_count,
        CAST(count_if(is_late) AS BIGINT) AS late_count,
        max(ingested_at) AS last_ingested_at
    FROM silver GROUP BY 1, 2, 3
),
qc AS (
    SELECT
        (SELECT count(*) FROM b) AS rows_checked,
        count_if(amount_minor IS NULL OR amount_minor <= 0) AS non_positive_amount,
        count_if(currency IS NULL OR currency NOT IN ('INR', 'JPY', 'USD')) AS unknown_currency,
        count_if(status IS NULL OR status NOT IN
                 ('CANCELLED', 'FAILED', 'PENDING', 'REFUNDED', 'SETTLED')) AS unknown_status,
        count_if(counterparty_id IS NULL) AS missing_counterparty
    FROM quarantine
),
dq_counts AS (
    SELECT rows_checked, 'non_positive_amount' AS check_name, non_positive_amount AS rows_failed FROM qc
    UNION ALL SELECT rows_checked, 'unknown_currency', unknown_currency FROM qc
    UNION ALL SELECT rows_checked, 'unknown_status', unknown_status FROM qc
    UNION ALL SELECT rows_checked, 'missing_counterparty', missing_counterparty FROM qc
),
dq_rates AS (
    SELECT *, CASE WHEN rows_checked > 0
                   THEN CAST(rows_failed AS DOUBLE) / rows_checked ELSE 0.0 END AS failure_rate
    FROM dq_counts
),
landed AS (
    SELECT kafka_topic, kafka_partition, kafka_offset FROM b
    UNION ALL
    SELECT kafka_topic, kafka_partition, kafka_offset FROM dlq
)
"""

DQ_COLUMNS = """
    CAST(rows_checked AS BIGINT) AS rows_checked,
    CAST(rows_failed AS BIGINT) AS rows_failed,
    failure_rate"""

BRONZE_COLS = (
    "transaction_id, account_id, counterparty_id, amount_minor, currency, status, "
    "event_time, produced_at, kafka_key, kafka_topic, kafka_partition, kafka_offset, "
    "kafka_timestamp, ingested_at, ingest_date"
)


def _q(body: str) -> str:
    return PRELUDE + body


def watermark_dedup(batches: int = 5) -> str:
    """Kept and late rows, one micro-batch after the other. Rows at or before the newest time
    of two batches back less an hour are late; an id is remembered while that line has not
    passed its time plus an hour."""
    steps = [""", m AS (
    SELECT transaction_id, kafka_partition, kafka_offset, least(event_time, kafka_timestamp) AS mark,
        CAST(kafka_timestamp >= TIMESTAMP '2024-01-09' AS INT) + CAST(kafka_timestamp >= TIMESTAMP '2024-01-16' AS INT)
        + CAST(kafka_timestamp >= TIMESTAMP '2024-01-23' AS INT) + CAST(kafka_partition = 5 AS INT) AS batch
    FROM b)"""]
    for n in range(batches):
        line = f"(SELECT date_trunc('milliseconds', max(mark)) - INTERVAL 1 HOUR FROM m WHERE batch <= {n - 2})"
        seen = f"SELECT transaction_id, mark FROM kept{n - 1}" if n else "SELECT '' AS transaction_id, TIMESTAMP '1970-01-01' AS mark WHERE false"
        steps.append(f"""timely{n} AS (SELECT * FROM m WHERE batch = {n} AND mark > coalesce({line}, TIMESTAMP '1970-01-01')),
seen{n} AS (SELECT * FROM ({seen}) WHERE mark + INTERVAL 1 HOUR > coalesce({line}, TIMESTAMP '1970-01-01')),
first{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_partition, kafka_offset) AS rn
    FROM timely{n}) WHERE rn = 1 AND transaction_id NOT IN (SELECT transaction_id FROM seen{n})),
kept{n} AS (SELECT transaction_id, mark FROM seen{n} UNION ALL SELECT transaction_id, mark FROM first{n})""")
    rows = " UNION ALL ".join(
        f"SELECT transaction_id, kafka_partition, kafka_offset, 'kept' AS outcome FROM first{n} UNION ALL "
        f"SELECT transaction_id, kafka_partition, kafka_offset, 'late' FROM m WHERE batch = {n} AND (batch, transaction_id, kafka_partition, kafka_offset) "
        f"NOT IN (SELECT batch, transaction_id, kafka_partition, kafka_offset FROM timely{n})" for n in range(batches))
    return ",\n".join(steps) + "\n" + rows


ORACLE: dict[str, str] = {
    "bronze_parse": _q(f"SELECT {BRONZE_COLS} FROM x"),
    "bronze_good": _q("SELECT * FROM b"),
    "bronze_dlq": _q("SELECT * FROM dlq"),
    "dlq_reason_counts": _q("SELECT dlq_reason, count(*) AS messages FROM dlq GROUP BY 1"),
    "wire_violations": _q(r"""
SELECT transaction_id, kafka_partition, kafka_offset, violations FROM (
    SELECT transaction_id, kafka_partition, kafka_offset,
        concat_ws(',',
            CASE WHEN amount_minor IS NULL OR amount_minor <= 0 THEN 'non_positive_amount' END,
            CASE WHEN currency IS NULL OR currency NOT IN ('INR', 'JPY', 'USD')
                 THEN 'unknown_currency' END,
            CASE WHEN status IS NULL OR status NOT IN
                 ('CANCELLED', 'FAILED', 'PENDING', 'REFUNDED', 'SETTLED')
                 THEN 'unknown_status' END,
            CASE WHEN naive THEN 'naive_event_time' END,
            CASE WHEN event_time > ingested_at THEN 'future_event_time' END,
            CASE WHEN account_id = '' THEN 'empty_account_id' END,
            CASE WHEN transaction_id = '' THEN 'empty_transaction_id' END
        ) AS violations
    FROM x WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL AND event_time IS NOT NULL) WHERE violations <> ''
"""),
    "silver_dedup": _q(f"SELECT {BRONZE_COLS} FROM d"),
    "silver_lateness": _q(f"SELECT {BRONZE_COLS}, lateness_seconds, lateness_seconds > 300 AS is_late FROM lt"),
    "silver_clean": _q("SELECT * FROM silver"),
    "silver_quarantine": _q("SELECT * FROM quarantine"),
    "quarantine_reason_counts": _q(
        "SELECT quarantine_reason, count(*) AS messages FROM quarantine GROUP BY 1"
    ),
    "dq_results": _q(f"""
SELECT 'fixture-run' AS run_id, 'silver.transactions' AS table_name, check_name,
    TIMESTAMP '2024-02-01 00:00:00' AS checked_at, {DQ_COLUMNS},
    0.05 :: DOUBLE AS threshold, failure_rate <= 0.05 AS passed
FROM dq_rates"""),
    "dq_breaches": _q("""
SELECT 'fixture-run' AS run_id, check_name AS "check", round(failure_rate, 4) AS failure_rate,
    0.02 :: DOUBLE AS threshold, CAST(rows_failed AS BIGINT) AS rows_failed,
    CAST(rows_checked AS BIGINT) AS rows_checked
FROM dq_rates WHERE failure_rate > 0.02"""),
    "dq_trend": _q(""", day_checked AS (
    SELECT ingest_date, count(*) AS rows_checked, max(ingested_at) AS checked_at
    FROM b GROUP BY 1
),
day_failed AS (
    SELECT ingest_date,
        count_if(amount_minor IS NULL OR amount_minor <= 0) AS non_positive_amount,
        count_if(currency IS NULL OR currency NOT IN ('INR', 'JPY', 'USD')) AS unknown_currency,
        count_if(status IS NULL OR status NOT IN
                 ('CANCELLED', 'FAILED', 'PENDING', 'REFUNDED', 'SETTLED')) AS unknown_status,
        count_if(counterparty_id IS NULL) AS missing_counterparty
    FROM quarantine GROUP BY 1
),
day_counts AS (
    SELECT c.ingest_date, c.rows_checked, c.checked_at,
        coalesce(f.non_positive_amount, 0) AS non_positive_amount,
        coalesce(f.unknown_currency, 0) AS unknown_currency,
        coalesce(f.unknown_status, 0) AS unknown_status,
        coalesce(f.missing_counterparty, 0) AS missing_counterparty
    FROM day_checked c LEFT JOIN day_failed f USING (ingest_date)
),
long AS (
    UNPIVOT day_counts ON non_positive_amount, unknown_currency, unknown_status, missing_counterparty
    INTO NAME check_name VALUE rows_failed
),
rated AS (
    SELECT CAST(ingest_date AS VARCHAR) AS run_id, 'silver.transactions' AS table_name,
        check_name, checked_at,
        CASE WHEN rows_checked > 0 THEN CAST(rows_failed AS DOUBLE) / rows_checked ELSE 0.0 END
            AS failure_rate
    FROM long
)
SELECT run_id, table_name, check_name, checked_at, failure_rate,
    lag(failure_rate) OVER (PARTITION BY table_name, check_name ORDER BY checked_at, run_id)
        AS previous_rate,
    failure_rate - lag(failure_rate) OVER (
        PARTITION BY table_name, check_name ORDER BY checked_at, run_id) AS rate_change
FROM rated"""),
    "daily_account_totals": _q("SELECT * FROM mart"),
    "affected_dates": _q("SELECT DISTINCT CAST(event_time AS DATE) AS event_date FROM silver"),
    "gold_rebuild_twice": _q("SELECT * FROM mart"),
    "gold_late_restate": _q("SELECT * FROM mart"),
    "gold_vanished_date": _q(
        "SELECT * FROM mart WHERE event_date <> (SELECT min(event_date) FROM mart)"
    ),
    "append_replay": _q("SELECT * FROM b"),
    "append_old_version": _q("SELECT * FROM b"),
    "append_other_app": _q(
        "SELECT * FROM b UNION ALL SELECT * FROM b WHERE ingest_date < DATE '2024-01-16'"
    ),
    "replace_all": _q("SELECT * FROM silver"),
    "append_merge_schema": _q(f"""
SELECT 'r-old' AS run_id, 'silver.transactions' AS table_name, check_name,
    TIMESTAMP '2024-02-01 00:00:00' AS checked_at, {DQ_COLUMNS},
    CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS BOOLEAN) AS passed
FROM dq_rates
UNION ALL
SELECT 'r-new', 'silver.transactions', check_name, TIMESTAMP '2024-02-01 00:00:00', {DQ_COLUMNS},
    0.05 :: DOUBLE, failure_rate <= 0.05
FROM dq_rates"""),
    "stream_ingest": _q("SELECT * FROM b"),
    "stream_crash_replay": _q("SELECT * FROM b"),
    "stream_dlq": _q("SELECT * FROM dlq"),
    "stream_cleared_checkpoint": _q("SELECT * FROM b"),
    "stream_dedup_watermark": _q(watermark_dedup()),
    "refine_summary": _q("""
SELECT 'fixture-run' AS run_id,
    (SELECT count(*) FROM b) AS bronze_rows,
    (SELECT count(*) FROM silver) AS silver_rows,
    (SELECT count(*) FROM quarantine) AS quarantined_rows,
    (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM silver) AS gold_dates,
    (SELECT count(*) FROM dq_rates WHERE failure_rate > 0.05) AS dq_breaches"""),
    "refine_gate": _q("""
SELECT 4 :: BIGINT AS dq_rows, (SELECT count(*) FROM dq_rates WHERE failure_rate > 0.02) AS failed_checks,
    (SELECT count(*) FROM mart) AS gold_rows,
    (SELECT CAST(coalesce(sum(total_amount_minor), 0) AS BIGINT) FROM mart) AS gold_amount,
    (SELECT count(*) FROM dq_rates WHERE failure_rate > 0.02) > 0 AS raised"""),
    "daily_rerun": _q("""
SELECT 4 :: BIGINT AS dq_rows, (SELECT count(*) FROM b) AS rows_checked, (SELECT count(*) FROM mart) AS gold_rows,
    (SELECT CAST(coalesce(sum(total_amount_minor), 0) AS BIGINT) FROM mart) AS gold_amount,
    1 :: BIGINT AS swept_first, 0 :: BIGINT AS swept_again, (SELECT count(*) FROM b) AS bronze_rows"""),
    "refine_incremental": _q("SELECT * FROM t"),
    "refine_incremental_dq": _q(f"""
SELECT 'fixture-run' AS run_id, 'silver.transactions' AS table_name, check_name,
    TIMESTAMP '2024-02-01 00:00:00' AS checked_at, {DQ_COLUMNS},
    0.05 :: DOUBLE AS threshold, failure_rate <= 0.05 AS passed
FROM dq_rates"""),
    "mart_deltas": _q("SELECT * FROM mart"),
    "mart_deltas_folded": _q("SELECT * FROM mart"),
    "upsert_mart": _q("SELECT * FROM mart"),
    "compact_rows": _q("SELECT * FROM b"),
    "expire_rows": _q("SELECT * FROM b"),
    "log_roundtrip": _q("""
SELECT transaction_id, account_id, counterparty_id, amount_minor, currency, status,
    event_time, produced_at, kafka_key, kafka_topic FROM b"""),
    "generated_log_profile": """
WITH c AS (SELECT count(*) AS n FROM events),
k AS (
    SELECT n,
        CASE WHEN n < 2 THEN 0 ELSE greatest(1, least(n - 1,
            CAST(round_even(CAST(n AS DOUBLE) * 0.05, 0) AS BIGINT))) END AS dup,
        CASE WHEN n < 2 THEN 0 ELSE greatest(1, least(n - 1,
            CAST(round_even(CAST(n AS DOUBLE) * 0.01, 0) AS BIGINT))) END AS one_pct
    FROM c
)
SELECT n AS messages, n - dup AS distinct_transaction_ids,
    one_pct AS null_field_rows, one_pct AS negative_amounts, one_pct AS unknown_currency_rows
FROM k""",
    "offset_gaps": _q("""
SELECT kafka_topic, kafka_partition, after_offset, before_offset,
    before_offset - after_offset - 1 AS missing_offsets
FROM (
    SELECT kafka_topic, kafka_partition, kafka_offset AS before_offset,
        lag(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset)
            AS after_offset
    FROM (SELECT DISTINCT * FROM landed))
WHERE after_offset IS NOT NULL AND before_offset - after_offset > 1"""),
    "offset_missing": _q("""
SELECT kafka_topic, kafka_partition, kafka_offset FROM x
EXCEPT
SELECT kafka_topic, kafka_partition, kafka_offset FROM landed WHERE kafka_offset % 1000 <> 14"""),
    "offset_not_in_bronze": _q("""
SELECT kafka_topic, kafka_partition, kafka_offset FROM x
EXCEPT
SELECT kafka_topic, kafka_partition, kafka_offset FROM b"""),
    "offset_lost_after_rebatch": _q("""
SELECT kafka_topic, kafka_partition, kafka_offset FROM x
WHERE ingest_date >= DATE '2024-01-16' AND ingest_date < DATE '2024-01-21'"""),
    "offset_reconcile": _q(""", pc AS (
    SELECT kafka_topic, kafka_partition, kafka_offset,
        sum(on_log) AS on_log, sum(landed) AS landed FROM (
        SELECT kafka_topic, kafka_partition, kafka_offset, 1 AS on_log, 0 AS landed FROM x
        UNION ALL
        SELECT kafka_topic, kafka_partition, kafka_offset, 0, 1 FROM landed)
    GROUP BY 1, 2, 3
)
SELECT kafka_topic, kafka_partition,
    CAST(sum(on_log) AS BIGINT) AS log_rows,
    CAST(sum(landed) AS BIGINT) AS landed_rows,
    CAST(count_if(on_log > 0 AND landed = 0) AS BIGINT) AS missing_rows,
    CAST(count_if(landed > 1) AS BIGINT) AS repeated_positions,
    CAST(count_if(on_log = 0) AS BIGINT) AS unknown_positions,
    min(kafka_offset) AS min_offset,
    max(kafka_offset) AS max_offset
FROM pc GROUP BY 1, 2"""),
    "retry_conflicts": _q("""
SELECT transaction_id, copies, versions, versions > 1 AS conflicting FROM (
    SELECT transaction_id, count(*) AS copies,
        count(DISTINCT (account_id, counterparty_id, amount_minor, currency, status, event_time))
            AS versions
    FROM b GROUP BY transaction_id)
WHERE copies > 1"""),
    "ingest_lag": _q("""
SELECT ingest_date, kafka_partition, count(*) AS messages,
    min(lag) AS min_lag_seconds, max(lag) AS max_lag_seconds, avg(lag) AS avg_lag_seconds,
    quantile_disc(lag, 0.5) AS p50_lag_seconds, quantile_disc(lag, 0.99) AS p99_lag_seconds,
    CAST(count_if(lag > 60) AS BIGINT) AS slow_messages
FROM (SELECT *, (epoch_us(ingested_at) - epoch_us(produced_at)) / 1000000.0 AS lag
      FROM b WHERE produced_at IS NOT NULL)
GROUP BY 1, 2"""),
    "key_spread": _q("""
SELECT account_id, count(DISTINCT kafka_partition) AS partitions, count(*) AS messages
FROM b WHERE account_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT kafka_partition) > 1"""),
    "distinct_counts": _q("""
SELECT ingest_date, count(*) AS messages, count(DISTINCT transaction_id) AS transactions,
    count(DISTINCT account_id) AS accounts, count(DISTINCT ingested_at) AS stamps
FROM b GROUP BY 1"""),
    "dlq_replay": _q(f"""
SELECT transaction_id, account_id, counterparty_id, amount_minor, currency, status,
    coalesce(event_time, kafka_timestamp) AS event_time, produced_at, kafka_key, kafka_topic,
    kafka_partition, kafka_offset, kafka_timestamp, ingested_at, ingest_date
FROM dlq
WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL
  AND coalesce(event_time, kafka_timestamp) IS NOT NULL"""),
}
