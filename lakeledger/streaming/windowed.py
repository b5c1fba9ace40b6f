"""The daily mart as a stream of event-time windows, and restatements of closed ones.

Totals of a day come out once, when the watermark passes the day's end (append mode). Rows
that arrive for a day behind it, which Spark's operator drops, travel beside the totals in
the same micro-batch and are added as restatements: totals and restatements together are
the batch mart of all closed days. Times are never ahead of the broker's clock, so a
row dated in the future counts in its own date's group but closes no day."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeledger.operators.delta_mart import DELTA_SCHEMA, RESTARTS, RUN, mart_of
from lakeledger.operators.gold import GRAIN, MEASURES, daily_account_totals, dated
from lakeledger.schemas import GOLD_PARTITION, MART_SCHEMA
from lakeledger.sources.tables import BATCH, append_once, read_table
from lakeledger.streaming.dedup import MARK, late_before
from lakeledger.streaming.ingest import evaluated, start

APP_ID, IS_TOTAL = "windowed", "_is_total"


def with_totals(silver: DataFrame, *, delay: str) -> DataFrame:
    """Silver rows of a stream and, beside them, the totals of days that the watermark passed
    (``_is_total``)."""
    rows = dated(silver).withColumn(MARK, F.least("event_time", "kafka_timestamp"))
    totals = rows.withWatermark(MARK, delay).groupBy(F.window(MARK, "1 day"), *GRAIN).agg(
        *(F.expr(sql).alias(name) for name, sql in MEASURES.items()))
    return rows.withColumn(IS_TOTAL, F.lit(False)).unionByName(
        totals.drop("window").withColumn(IS_TOTAL, F.lit(True)), allowMissingColumns=True)


def land_totals(batch: DataFrame, batch_id: int, *, root: str, delay: str) -> None:
    """Write the batch's closed days to ``root``/closed, what its late rows add to days that
    were closed before to ``root``/restated."""
    with evaluated(batch) as held:
        line = late_before(batch.sparkSession, root, batch_id, delay)
        ends = F.unix_micros(F.date_trunc("day", MARK)) + 86_400_000_000
        rows = held.where(~F.col(IS_TOTAL))
        late = rows.where(F.lit(False) if line is None else ends <= line * 1000)
        newest = rows.agg(F.max(MARK).alias("newest")).where("newest IS NOT NULL")
        for name, part in (("closed", held.where(IS_TOTAL)), ("restated", daily_account_totals(late))):
            append_once(part.select(*MART_SCHEMA.names), f"{root}/{name}", app_id=APP_ID, version=batch_id, partition_by=(GOLD_PARTITION,))
        append_once(newest, f"{root}/newest", app_id=APP_ID, version=batch_id)


def start_mart_stream(silver: DataFrame, *, root: str, checkpoint_path: str, delay: str, trigger: dict | None = None) -> StreamingQuery:
    """silver stream -> totals of closed days and restatements under ``root``."""
    body = partial(land_totals, root=root, delay=delay)
    return start(with_totals(silver, delay=delay), lambda batch, batch_id: body(batch, batch_id), checkpoint_path=checkpoint_path,
                 trigger=trigger or {"availableNow": True})


def closed_mart(spark: SparkSession, root: str) -> DataFrame:
    """The mart of all closed days, restatements included."""
    wide = T.StructType(MART_SCHEMA.fields)
    parts = [read_table(spark, f"{root}/{name}", wide, batches=True).select(
        *MART_SCHEMA.names, F.lit(False).alias(RESTARTS), F.col(BATCH).alias(RUN)) for name in ("closed", "restated")]
    return mart_of(parts[0].unionByName(parts[1]).select(*DELTA_SCHEMA.names))
