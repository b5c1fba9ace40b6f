"""Declared table shapes and the fixed values of the payments contract.

Every stored table has a declared StructType. Nothing is inferred: a producer that
adds a field does not widen bronze, and a field that stops arriving reads as null.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the wire contract of the payments log exactly.
# ---------------------------------------------------------------------------
RAW_TOPIC = "txn.raw"
LOG_PARTITIONS = 6
CURRENCIES = ("INR", "JPY", "USD")
STATUSES = ("PENDING", "SETTLED", "FAILED", "CANCELLED", "REFUNDED")
CURRENCY_EXPONENT = {"INR": 2, "USD": 2, "JPY": 0}
REQUIRED_FIELDS = ("transaction_id", "account_id", "event_time")
DEFAULT_LATENESS_SECONDS = 300
DEFAULT_FAILURE_THRESHOLD = 0.05
DEFAULT_RETAIN_HOURS = 168
ACCOUNT_POOL_SIZE = 200
FRESH_WINDOW_SECONDS = 30
LATE_MIN_SECONDS = 300
LATE_MAX_SECONDS = 3600
DEFAULT_DQ_TABLE = "silver.transactions"
# ISO-8601 with microseconds and a numeric offset; to_json alone would cut to millis.
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

BRONZE_PARTITION = "ingest_date"
GOLD_PARTITION = "event_date"
DQ_PARTITION = "run_id"


def _fields(spec: list[tuple[str, T.DataType]]) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name, dtype in spec]


# The six columns of a Kafka record, as Spark's Kafka source produces them.
LOG_SCHEMA = T.StructType(
    _fields(
        [
            ("key", T.BinaryType()),
            ("value", T.BinaryType()),
            ("topic", T.StringType()),
            ("partition", T.IntegerType()),
            ("offset", T.LongType()),
            ("timestamp", T.TimestampType()),
        ]
    )
)

# The JSON payload. Declared, never inferred.
WIRE_SCHEMA = T.StructType(
    _fields(
        [
            ("transaction_id", T.StringType()),
            ("account_id", T.StringType()),
            ("counterparty_id", T.StringType()),
            ("amount_minor", T.LongType()),
            ("currency", T.StringType()),
            ("status", T.StringType()),
            ("event_time", T.TimestampType()),
            ("ingest_time", T.TimestampType()),
        ]
    )
)

BRONZE_SCHEMA = T.StructType(
    _fields(
        [
            ("transaction_id", T.StringType()),
            ("account_id", T.StringType()),
            ("counterparty_id", T.StringType()),
            ("amount_minor", T.LongType()),
            ("currency", T.StringType()),
            ("status", T.StringType()),
            ("event_time", T.TimestampType()),
            ("produced_at", T.TimestampType()),
            ("raw_payload", T.StringType()),
            ("kafka_key", T.StringType()),
            ("kafka_topic", T.StringType()),
            ("kafka_partition", T.IntegerType()),
            ("kafka_offset", T.LongType()),
            ("kafka_timestamp", T.TimestampType()),
            ("ingested_at", T.TimestampType()),
            ("ingest_date", T.DateType()),
        ]
    )
)

DLQ_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + _fields([("dlq_reason", T.StringType())]))

SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + _fields([("lateness_seconds", T.LongType()), ("is_late", T.BooleanType())])
)

QUARANTINE_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields + _fields([("quarantine_reason", T.StringType())])
)

DQ_SCHEMA = T.StructType(
    _fields(
        [
            ("run_id", T.StringType()),
            ("table_name", T.StringType()),
            ("check_name", T.StringType()),
            ("checked_at", T.TimestampType()),
            ("rows_checked", T.LongType()),
            ("rows_failed", T.LongType()),
            ("failure_rate", T.DoubleType()),
            ("threshold", T.DoubleType()),
            ("passed", T.BooleanType()),
        ]
    )
)

MART_SCHEMA = T.StructType(
    _fields(
        [
            ("event_date", T.DateType()),
            ("account_id", T.StringType()),
            ("currency", T.StringType()),
            ("transaction_count", T.LongType()),
            ("total_amount_minor", T.LongType()),
            ("settled_count", T.LongType()),
            ("late_count", T.LongType()),
            ("last_ingested_at", T.TimestampType()),
        ]
    )
)

BRONZE_COLUMNS = tuple(f.name for f in BRONZE_SCHEMA.fields)
WIRE_FIELDS = tuple(f.name for f in WIRE_SCHEMA.fields)
