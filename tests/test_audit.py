"""Audits, checked against brute force on small hand-built inputs."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from lakeledger.operators.audit import (
    distinct_counts,
    ingest_lag,
    key_spread,
    offset_gaps,
    offset_missing,
    offset_reconcile,
    replay_dlq,
    retry_report,
)
from lakeledger.operators.bronze import split_parseable, to_bronze
from rows import landed, later, log_of


def _positions(spark, triples):
    return spark.createDataFrame(
        triples, "kafka_topic string, kafka_partition int, kafka_offset long")


def _brute_gaps(triples):
    out = set()
    by = {}
    for t, p, o in set(triples):
        by.setdefault((t, p), []).append(o)
    for (t, p), offs in by.items():
        offs.sort()
        for a, b in zip(offs, offs[1:]):
            if b - a > 1:
                out.add((t, p, a, b, b - a - 1))
    return out


def test_offset_gaps_match_brute_force_across_ranges(spark):
    triples = [("t", 0, o) for o in [0, 1, 2, 5, 9, 10, 11, 30, 31, 33]]
    triples += [("t", 1, o) for o in [3, 4, 4, 8]] + [("u", 0, 100)]
    got = {tuple(r) for r in offset_gaps(_positions(spark, triples), range_size=7).collect()}
    assert got == _brute_gaps(triples)
    got_one_range = {tuple(r) for r in offset_gaps(_positions(spark, triples)).collect()}
    assert got_one_range == got


def test_offset_missing_and_reconcile(spark):
    log = spark.createDataFrame(
        [(None, b"x", "t", p, o, datetime(2024, 1, 1, tzinfo=UTC)) for p in (0, 1) for o in range(5)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    landed = _positions(spark, [("t", 0, o) for o in range(5)] + [("t", 1, 0), ("t", 1, 0),
                                                                   ("t", 1, 4), ("t", 2, 9)])
    missing = {tuple(r) for r in offset_missing(log, landed).collect()}
    assert missing == {("t", 1, 1), ("t", 1, 2), ("t", 1, 3)}
    rec = {r.kafka_partition: r for r in offset_reconcile(log, landed).collect()}
    assert rec[0].missing_rows == 0 and rec[0].log_rows == 5
    assert rec[1].missing_rows == 3 and rec[1].repeated_positions == 1 and rec[1].landed_rows == 3
    assert rec[2].unknown_positions == 1


def test_retry_report_flags_conflicting_copies(spark):
    sent = [{"transaction_id": t, "amount_minor": a, "counterparty_id": c} for t, a, c in (
        ("same", 5, "bob"), ("same", 5, "bob"), ("diff", 1, "bob"), ("diff", 2, "bob"), ("nulls", 5, None), ("nulls", 5, "bob"),
        ("single", 5, "bob"))]
    got = {r.transaction_id: (r.copies, r.versions, r.conflicting) for r in retry_report(landed(spark, *sent)).collect()}
    assert got == {"same": (2, 1, False), "diff": (2, 2, True), "nulls": (2, 2, True)}


def test_key_spread_lag_and_distinct_counts(spark):
    sent = [{"account_id": "a", "at": (0, 0)}, {"account_id": "a", "at": (4, 1)}, {"account_id": "b", "at": (1, 2)},
            {"account_id": "b", "at": (1, 3), "transaction_id": "pay-2", "seen": later(seconds=90)}]
    bronze = landed(spark, *sent)
    assert [tuple(r) for r in key_spread(bronze).collect()] == [("a", 2, 2)]
    lag = {r.kafka_partition: r for r in ingest_lag(bronze).collect()}
    one = lag[1]
    assert (one.messages, one.min_lag_seconds, one.p50_lag_seconds, one.p99_lag_seconds, one.max_lag_seconds, one.slow_messages) == (
        2, 0.0, 0.0, 90.0, 90.0, 1)
    counts = distinct_counts(bronze).first()
    assert (counts.messages, counts.transactions, counts.accounts, counts.stamps) == (4, 3, 2, 2)


def test_dlq_replay_recovers_only_fixable_rows(spark):
    payloads = [
        b'{"transaction_id":"t1","account_id":"a","event_time":"garbage"}',
        b'{"transaction_id":null,"account_id":"a","event_time":"garbage"}',
        b"{not json",
    ]
    _, dead = split_parseable(to_bronze(log_of(spark, *payloads)))
    assert dead.count() == 3
    rec = replay_dlq(dead).collect()
    assert [r.transaction_id for r in rec] == ["t1"]
    assert rec[0].event_time == rec[0].kafka_timestamp
    assert rec[0].raw_payload is not None and rec[0].ingested_at is not None
    assert dead.where(F.col("dlq_reason") == "missing:event_time").count() == 1
