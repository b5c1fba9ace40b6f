"""Sessions of an account: runs of activity with no pause of ``gap`` between two events.

``session_window`` merges rows into sessions with partial sessions per task before the
shuffle; the same expression runs in batch and, behind a watermark, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = {"transactions": "count(*)", "total_amount_minor": "sum(amount_minor)", "counterparties": "count(DISTINCT counterparty_id)"}


def account_sessions(silver: DataFrame, *, gap: str = "6 hours", measures=MEASURES) -> DataFrame:
    """(account_id, started_at, last_at, measures) of each session. On a stream, give the
    watermark first and no distinct measure; a session comes out once it can't grow."""
    grouped = silver.groupBy("account_id", F.session_window("event_time", gap).alias("session"))
    return grouped.agg(*(F.expr(sql).alias(name) for name, sql in measures.items()), F.max("event_time").alias("last_at")).select(
        "account_id", F.col("session.start").alias("started_at"), "last_at", *measures)
