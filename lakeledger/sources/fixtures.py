"""The payments log derived from the supplied ``events`` table.

No supplied table holds payments, so each event becomes one message on the log,
and some events are retried once (a second message, later offset, same payload).
Defects are placed by fixed arithmetic on ``event_id`` so that an independent SQL
engine can derive the same structured rows without parsing any JSON. Every event
is used; the arithmetic only decides which defect a message carries.

Fixed values of the fixture (the oracle SQL states the same numbers):

* retried when ``event_id % 20 = 7``; retry offset ``+21``; retry ingest ``ts + 35 s``,
  original ingest ``ts + 5 s``; the retry's amount is one more when ``event_id % 200 = 47``
* transaction_id null when ``event_id % 700 = 31``, empty when ``event_id % 750 = 71``,
  else ``txn_`` + 12-digit id
* account_id null when ``event_id % 300 = 17``, empty when ``event_id % 450 = 19``, else
  ``acc_`` + 4-digit ``user_id % 200``
* counterparty_id null when ``event_id % 97 = 13``, else ``acc_`` + 4-digit
  ``(user_id * 7 + event_id) % 200``
* currency null when ``event_id % 211 = 5``; ``XYZ`` when ``event_id % 50 = 11``;
  else INR / JPY / USD for ``event_id % 3`` = 0 / 1 / 2
* amount_minor: JPY rows ``ceil(value)``, others ``round(value * 100)``; negated when
  ``event_id % 50 = 23``
* status ``TELEPORTED`` when ``event_id % 101 = 7``; else purchase, click -> SETTLED;
  view -> PENDING; error -> FAILED; signup -> CANCELLED; anything else -> REFUNDED
* event_time ``"garbage"`` when ``event_id % 900 = 41``; ``ts + 3 days`` when
  ``event_id % 650 = 61``; ``ts`` without a zone when ``event_id % 600 = 59``;
  ``ts - 2 h`` when ``event_id % 40 = 3``; else ``ts``
* payload ``{not json`` when ``event_id % 500 = 29``
* log partition ``user_id % 6``, one further when ``event_id % 400 = 9``; offset
  ``event_id * 2 + copy * 21``; broker time ``ts``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.wire import iso_instant, kafka_key
from lakeledger.schemas import RAW_TOPIC


def _m(k: int, r: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(k)) == r


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def payments_messages(ev: DataFrame) -> DataFrame:
    """One row per message with the structured wire fields, before encoding.

    The retry is produced by exploding a one- or two-element array, so ``events`` is
    scanned once and the step stays narrow (no union, no shuffle).
    """
    copies = F.when(_m(20, 7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ts = F.col("ts").cast(T.TimestampType())
    eid = F.col("event_id")
    uid = F.col("user_id")
    currency = (
        F.when(_m(211, 5), F.lit(None).cast("string"))
        .when(_m(50, 11), F.lit("XYZ"))
        .when(_m(3, 0), F.lit("INR"))
        .when(_m(3, 1), F.lit("JPY"))
        .otherwise(F.lit("USD"))
    )
    base_amount = F.when(_m(3, 1), F.ceil(F.col("value"))).otherwise(
        F.round(F.col("value") * 100)
    ).cast("long")
    signed = F.when(_m(50, 23), -base_amount).otherwise(base_amount)
    amount = signed + F.when((F.col("copy") == 1) & _m(200, 47), 1).otherwise(0)
    status = (
        F.when(_m(101, 7), F.lit("TELEPORTED"))
        .when(F.col("event_type").isin("purchase", "click"), F.lit("SETTLED"))
        .when(F.col("event_type") == "view", F.lit("PENDING"))
        .when(F.col("event_type") == "error", F.lit("FAILED"))
        .when(F.col("event_type") == "signup", F.lit("CANCELLED"))
        .otherwise(F.lit("REFUNDED"))
    )
    event_time_text = (
        F.when(_m(900, 41), F.lit("garbage"))
        .when(_m(650, 61), iso_instant(ts + F.expr("INTERVAL 3 DAYS")))
        .when(_m(600, 59), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(_m(40, 3), iso_instant(ts - F.expr("INTERVAL 2 HOURS")))
        .otherwise(iso_instant(ts))
    )
    return ev.select("*", F.explode(copies).alias("copy")).select(
        eid.alias("event_id"),
        ts.alias("ts"),
        "copy",
        F.when(_m(700, 31), F.lit(None).cast("string")).when(_m(750, 71), F.lit(""))
        .otherwise(F.concat(F.lit("txn_"), F.lpad(eid.cast("string"), 12, "0")))
        .alias("transaction_id"),
        F.when(_m(300, 17), F.lit(None).cast("string")).when(_m(450, 19), F.lit(""))
        .otherwise(F.concat(F.lit("acc_"), F.lpad(F.pmod(uid, F.lit(200)).cast("string"), 4, "0")))
        .alias("account_id"),
        F.when(_m(97, 13), F.lit(None).cast("string"))
        .otherwise(
            F.concat(
                F.lit("acc_"),
                F.lpad(F.pmod(uid * 7 + eid, F.lit(200)).cast("string"), 4, "0"),
            )
        )
        .alias("counterparty_id"),
        amount.alias("amount_minor"),
        currency.alias("currency"),
        status.alias("status"),
        event_time_text.alias("event_time"),
        iso_instant(ts).alias("ingest_time"),
        _m(500, 29).alias("not_json"),
        F.pmod(uid + F.when(_m(400, 9), 1).otherwise(0), F.lit(6)).cast("int").alias("partition"),
    )


def payments_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped log: ``key, value, topic, partition, offset, timestamp``.

    ``value`` is real JSON bytes (sorted keys, ISO times with microseconds) so the
    bronze parse runs on the same input a broker would deliver.
    """
    msgs = payments_messages(events(spark, sf_dir))
    payload = F.to_json(
        F.struct(
            *[
                F.col(c)
                for c in sorted(
                    [
                        "account_id", "amount_minor", "counterparty_id", "currency",
                        "event_time", "ingest_time", "status", "transaction_id",
                    ]
                )
            ]
        )
    )
    value = F.when(F.col("not_json"), F.lit("{not json")).otherwise(payload)
    return msgs.select(
        kafka_key("account_id").alias("key"),
        value.cast(T.BinaryType()).alias("value"),
        F.lit(RAW_TOPIC).alias("topic"),
        F.col("partition"),
        (F.col("event_id") * 2 + F.col("copy") * 21).cast("long").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def arrival_clock() -> Column:
    """The fixture's ingest stamp: broker time + 5 s, + 35 s for a retry.

    A retry's offset is odd (original offsets are even), which is how the stamp is
    recovered from the log row itself. This stands in for the micro-batch clock so
    that lateness, ingest dates and ``last_ingested_at`` are reproducible.
    """
    secs = F.lit(5) + F.lit(30) * F.pmod(F.col("offset"), F.lit(2))
    return F.timestamp_micros(F.unix_micros(F.col("timestamp")) + secs * F.lit(1_000_000))
