"""Audits the log and the landed tables: nothing lost, nothing doubled, keys kept.

All of these are aggregations or windows with bounded groups; none joins two large
tables or gathers a whole log partition into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.operators.bronze import split_parseable, to_bronze

LOG_POSITION = ("kafka_topic", "kafka_partition", "kafka_offset")
BUSINESS_FIELDS = (
    "account_id", "counterparty_id", "amount_minor", "currency", "status", "event_time",
)
# Offsets per reconciliation range: bounds every window group to this many rows.
OFFSET_RANGE = 1_000_000


def landed_positions(bronze: DataFrame, dlq: DataFrame) -> DataFrame:
    """Log positions that reached bronze or the dead-letter table."""
    return bronze.select(*LOG_POSITION).unionByName(dlq.select(*LOG_POSITION))


def log_positions(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def _position_counts(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Per log position: copies on the log, copies landed. One shuffle, no join."""
    tagged = log_positions(log).select(*LOG_POSITION, F.lit(1).alias("on_log"), F.lit(0).alias("landed"))
    tagged = tagged.unionByName(
        landed.select(*LOG_POSITION, F.lit(0).alias("on_log"), F.lit(1).alias("landed"))
    )
    return tagged.groupBy(*LOG_POSITION).agg(
        F.sum("on_log").cast("long").alias("on_log"), F.sum("landed").cast("long").alias("landed")
    )


def offset_missing(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Log positions with no landed row (X1): the silent-loss detector."""
    return (
        _position_counts(log, landed)
        .where((F.col("on_log") > 0) & (F.col("landed") == 0))
        .select(*LOG_POSITION)
    )


def offset_reconcile(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Per (topic, partition): rows on the log, landed, missing, repeated, unknown."""
    pc = _position_counts(log, landed)
    return pc.groupBy("kafka_topic", "kafka_partition").agg(
        F.sum("on_log").cast("long").alias("log_rows"),
        F.sum("landed").cast("long").alias("landed_rows"),
        F.count_if((F.col("on_log") > 0) & (F.col("landed") == 0)).alias("missing_rows"),
        F.count_if(F.col("landed") > 1).alias("repeated_positions"),
        F.count_if(F.col("on_log") == 0).alias("unknown_positions"),
        F.min("kafka_offset").alias("min_offset"),
        F.max("kafka_offset").alias("max_offset"),
    )


def offset_gaps(landed: DataFrame, *, range_size: int = OFFSET_RANGE) -> DataFrame:
    """Holes in the landed offsets of each (topic, partition) (X1).

    A log partition is one huge ordered group, so it is cut into offset ranges of
    ``range_size``: gaps inside a range come from a ``lag`` window partitioned by
    (topic, partition, range), whose groups hold at most ``range_size`` rows; gaps
    between ranges come from the same window over the tiny per-range (min, max)
    summary. Repeated offsets need no distinct pass: a repeat lags onto itself (a
    difference of 0), so it never reads as a gap; ``offset_reconcile`` counts them.
    The window and the range summary share one shuffle on (topic, partition, range).
    """
    pos = landed.select(*LOG_POSITION).withColumn(
        "_range", F.floor(F.col("kafka_offset") / F.lit(range_size))
    )
    inner_w = Window.partitionBy("kafka_topic", "kafka_partition", "_range").orderBy("kafka_offset")
    inner = pos.select(
        "kafka_topic", "kafka_partition",
        F.lag("kafka_offset").over(inner_w).alias("after_offset"),
        F.col("kafka_offset").alias("before_offset"),
    )
    edges = pos.groupBy("kafka_topic", "kafka_partition", "_range").agg(
        F.min("kafka_offset").alias("lo"), F.max("kafka_offset").alias("hi")
    )
    edge_w = Window.partitionBy("kafka_topic", "kafka_partition").orderBy("_range")
    across = edges.select(
        "kafka_topic", "kafka_partition",
        F.lag("hi").over(edge_w).alias("after_offset"),
        F.col("lo").alias("before_offset"),
    )
    return (
        inner.unionByName(across)
        .where(F.col("after_offset").isNotNull()
               & (F.col("before_offset") - F.col("after_offset") > 1))
        .select(
            "kafka_topic", "kafka_partition", "after_offset", "before_offset",
            (F.col("before_offset") - F.col("after_offset") - 1).alias("missing_offsets"),
        )
    )


def retry_report(bronze: DataFrame, *, fields=BUSINESS_FIELDS) -> DataFrame:
    """Transaction ids delivered more than once, with the number of distinct
    versions of their business fields (X2); ``conflicting`` = more than one version.

    Two exact hash aggregations: (id, fields) first, which collapses identical
    copies map-side (a hot id costs one row per task), then per id. Grouping keys
    may be any type, so no sort-based aggregate is needed; null fields compare equal.
    """
    versions = bronze.groupBy("transaction_id", *fields).agg(F.count(F.lit(1)).alias("_n"))
    return (
        versions.groupBy("transaction_id")
        .agg(
            F.sum("_n").cast("long").alias("copies"),
            F.count(F.lit(1)).alias("versions"),
        )
        .where(F.col("copies") > 1)
        .select("transaction_id", "copies", "versions",
                (F.col("versions") > 1).alias("conflicting"))
    )


def ingest_lag(bronze: DataFrame, *, slow_seconds: int = 60) -> DataFrame:
    """Seconds from producer stamp to ingest, per ingest date and log partition (X3)."""
    lag = (F.unix_micros("ingested_at") - F.unix_micros("produced_at")) / F.lit(1_000_000)
    return (
        bronze.where(F.col("produced_at").isNotNull())
        .withColumn("_lag", lag)
        .groupBy("ingest_date", "kafka_partition")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("_lag").alias("min_lag_seconds"),
            F.max("_lag").alias("max_lag_seconds"),
            F.avg("_lag").alias("avg_lag_seconds"),
            F.percentile_approx("_lag", F.lit(0.5), F.lit(10_000)).alias("p50_lag_seconds"),
            F.percentile_approx("_lag", F.lit(0.99), F.lit(10_000)).alias("p99_lag_seconds"),
            F.count_if(F.col("_lag") > slow_seconds).alias("slow_messages"),
        )
    )


def distinct_counts(bronze: DataFrame) -> DataFrame:
    """Exact distinct transactions, accounts and ingest stamps per ingest date (A11)."""
    return bronze.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("transaction_id").alias("transactions"),
        F.count_distinct("account_id").alias("accounts"),
        F.count_distinct("ingested_at").alias("stamps"),
    )


def key_spread(bronze: DataFrame) -> DataFrame:
    """Accounts seen on more than one log partition (X6): keying discipline broken."""
    return (
        bronze.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count_distinct("kafka_partition").alias("partitions"),
            F.count(F.lit(1)).alias("messages"),
        )
        .where(F.col("partitions") > 1)
    )


def replay_dlq(dlq: DataFrame, *, fallback_event_time: Column | None = None) -> DataFrame:
    """Re-parse dead letters with a corrected rule (X5).

    The correction: an unparseable event time falls back to the broker timestamp
    (the time the log accepted the message). Rows that become parseable are
    returned in bronze shape, with the original ingest stamp kept; others stay dead.
    """
    raw = dlq.select(
        F.col("kafka_key").cast("binary").alias("key"),
        F.col("raw_payload").cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.col("ingested_at").alias("_ingested_at"),
    )
    reparsed = to_bronze(raw, ingested_at=F.col("_ingested_at"))
    fb = fallback_event_time if fallback_event_time is not None else F.col("kafka_timestamp")
    corrected = reparsed.withColumn("event_time", F.coalesce(F.col("event_time"), fb))
    good, _ = split_parseable(corrected)
    return good
