"""Registered queries: each reads the supplied tables under ``sf_dir`` and returns a
DataFrame. Queries that exercise tables or streams write to a fresh scratch folder of
their own and return what they read back; no query reads another one's folder.

Outputs drop ``raw_payload`` (JSON text formatting differs between engines) and
carry instants as TIMESTAMP_NTZ in UTC, so an independent SQL engine can compare.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.rules import WIRE_RULES, reason_list
from lakeledger.functions.wire import to_wire
from lakeledger.operators import audit
from lakeledger.operators.bronze import good_of, split_parseable, tag_parseable, to_bronze
from lakeledger.operators.generate import CLI_DEFECTS, generate_log
from lakeledger.operators.gold import GRAIN, MEASURES, affected_dates, affected_dates_frame, daily_account_totals, dated, rebuild
from lakeledger.operators.quality import DataQualityBreach, breach_frame, dq_results, dq_results_by, dq_trend
from lakeledger.operators.silver import deduplicate, flag_lateness, judged, to_silver
from lakeledger.plans.incremental import IncrementalLayout, fold_deltas, refine_new
from lakeledger.plans.medallion import VERDICT, CheckpointLost, Layout, ingest, refine, run_daily, threshold_override
from lakeledger.schemas import BRONZE_PARTITION, BRONZE_SCHEMA, DQ_PARTITION, DQ_SCHEMA, GOLD_PARTITION, MART_SCHEMA, SILVER_SCHEMA
from lakeledger.session import ensure_utc, scratch_path
from lakeledger.sources import tables as tb
from lakeledger.sources.fixtures import arrival_clock, events, payments_log
from lakeledger.sources.log import keyed_log, read_log, read_log_stream, write_log
from lakeledger.streaming.dedup import kept_rows, late_rows, start_dedup_stream
from lakeledger.streaming.ingest import dead_letters_of, drain, land_batch, start

# Fixed parameters of the registered runs (the oracle SQL states the same values).
RUN_ID = "fixture-run"
CHECKED_AT = datetime(2024, 2, 1, tzinfo=UTC)
GATE_THRESHOLD = 0.02
BATCH_SPLIT = date(2024, 1, 16)  # micro-batch 0 = rows ingested before this date
REBATCH_SPLIT = date(2024, 1, 21)  # batch 0 after a cleared checkpoint, larger batches
GEN_SEED = 42
GEN_CLOCK = datetime(2024, 2, 1, 12, 0, tzinfo=UTC)
RECORDS_PER_FILE, LOG_FILES = 400, 128  # of the log files the streams read: records at least, files about at most
BATCHES = 4  # about so many micro-batches a stream query runs
WATERMARK_DELAY = "1 hour"  # the log spans 30 days: almost all state is evicted on the way
DELIVERY_CUTS = tuple(datetime(2024, 1, d, tzinfo=UTC) for d in (9, 16, 23))  # weeks of the delivered log
LAGGING, FILES_A_BATCH = 5, 4
LOST_OFFSETS = 14  # offset_missing: rows with offset % 1000 = 14 never land
STREAM_TIMEOUT_S = 600  # so long without the end of a task, and a stream has failed

Query = Callable[[SparkSession, str], DataFrame]


def _out(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name == "raw_payload":
            continue
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return payments_log(spark, sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(_log(spark, sf_dir), ingested_at=arrival_clock())


def _good_dead(spark, sf_dir):
    return split_parseable(_bronze(spark, sf_dir))


def _silver(spark, sf_dir):
    return to_silver(_good_dead(spark, sf_dir)[0])


def _batches(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = F.col(BRONZE_PARTITION) < F.lit(BATCH_SPLIT)
    return good.where(early), good.where(~early)


def _records_per_file(log: DataFrame) -> int:
    """Files grow with the log; their number, and with it that of the files a micro-batch
    writes, doesn't."""
    return max(RECORDS_PER_FILE, -(-log.count() // LOG_FILES))


def _log_files(log: DataFrame, root: str, per_file: int) -> tuple[str, int]:
    """The log as Parquet files, and how many of them a trigger admits."""
    path = f"{root}/log"
    rows = write_log(log, path, max_records_per_file=per_file)
    return path, max(1, rows // (BATCHES * per_file))


# --------------------------------------------------------------------- bronze


def q_bronze_parse(spark, sf_dir):
    return _out(_bronze(spark, sf_dir))


def q_bronze_good(spark, sf_dir):
    return _out(_good_dead(spark, sf_dir)[0])


def q_bronze_dlq(spark, sf_dir):
    return _out(_good_dead(spark, sf_dir)[1])


def q_dlq_reason_counts(spark, sf_dir):
    _, dead = _good_dead(spark, sf_dir)
    return dead.groupBy("dlq_reason").agg(F.count(F.lit(1)).alias("messages"))


def q_wire_violations(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    tagged = good.withColumn("violations", reason_list(WIRE_RULES))
    return tagged.where(F.col("violations") != "").select(
        "transaction_id", "kafka_partition", "kafka_offset", "violations"
    )


# --------------------------------------------------------------------- silver


def q_silver_dedup(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return _out(deduplicate(good))


def q_silver_lateness(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return _out(flag_lateness(deduplicate(good)))


def q_silver_clean(spark, sf_dir):
    return _out(_silver(spark, sf_dir)[0])


def q_silver_quarantine(spark, sf_dir):
    return _out(_silver(spark, sf_dir)[1])


def q_quarantine_reason_counts(spark, sf_dir):
    _, quarantined = _silver(spark, sf_dir)
    return quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("messages"))


# --------------------------------------------------------------------- quality


def _dq(spark, sf_dir, thresholds=None):
    good, _ = _good_dead(spark, sf_dir)
    _, quarantined = _silver(spark, sf_dir)
    return dq_results(
        source=good, quarantined=quarantined, run_id=RUN_ID, checked_at=CHECKED_AT,
        thresholds=thresholds,
    )


def q_dq_results(spark, sf_dir):
    return _out(_dq(spark, sf_dir))


def q_dq_breaches(spark, sf_dir):
    return breach_frame(_dq(spark, sf_dir, thresholds={
        "non_positive_amount": GATE_THRESHOLD, "unknown_currency": GATE_THRESHOLD,
        "unknown_status": GATE_THRESHOLD, "missing_counterparty": GATE_THRESHOLD,
    }))


def q_dq_trend(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    _, quarantined = _silver(spark, sf_dir)
    per_day = dq_results_by(source=good, quarantined=quarantined, by=BRONZE_PARTITION)
    return _out(dq_trend(per_day))


# --------------------------------------------------------------------- gold


def q_daily_account_totals(spark, sf_dir):
    return _out(daily_account_totals(_silver(spark, sf_dir)[0]))


def q_affected_dates(spark, sf_dir):
    silver, _ = _silver(spark, sf_dir)
    return affected_dates_frame(silver)


def _silver_table(spark, sf_dir, root) -> DataFrame:
    """Silver as the pipeline stores it: partitioned by event date."""
    silver, _ = _silver(spark, sf_dir)
    tb.replace_all(silver.withColumn(GOLD_PARTITION, F.to_date("event_time")), f"{root}/silver", partition_by=(GOLD_PARTITION,))
    return tb.read_table(spark, f"{root}/silver", T.StructType([*SILVER_SCHEMA.fields, T.StructField(GOLD_PARTITION, T.DateType())]))


def _mart(spark, root):
    return _out(tb.read_table(spark, f"{root}/gold", MART_SCHEMA))


def q_gold_rebuild_twice(spark, sf_dir):
    root = scratch_path(spark, "gold_rebuild_twice")
    silver = _silver_table(spark, sf_dir, root)
    for _ in range(2):
        rebuild(silver, f"{root}/gold")
    return _mart(spark, root)


def q_gold_late_restate(spark, sf_dir):
    root = scratch_path(spark, "gold_late_restate")
    silver = _silver_table(spark, sf_dir, root)
    rebuild(silver.where("NOT is_late"), f"{root}/gold")
    rebuild(silver, f"{root}/gold", dates=affected_dates(silver.where("is_late")))
    return _mart(spark, root)


def q_gold_vanished_date(spark, sf_dir):
    root = scratch_path(spark, "gold_vanished_date")
    silver = _silver_table(spark, sf_dir, root)
    first = rebuild(silver, f"{root}/gold")[0]
    corrected = silver.where(F.col(GOLD_PARTITION) != F.lit(first))
    held = tb.partition_values(spark, f"{root}/gold", GOLD_PARTITION)
    rebuild(corrected, f"{root}/gold", dates={*map(str, affected_dates(corrected)), *held})
    return _mart(spark, root)


# --------------------------------------------------------------------- tables


def _appended(spark, name, *batches) -> DataFrame:
    """Bronze after appending (frame, app id, version) in order."""
    path = scratch_path(spark, name) + "/bronze"
    for frame, app, version in batches:
        tb.append_once(frame, path, app_id=app, version=version, partition_by=(BRONZE_PARTITION,))
    return _out(tb.read_table(spark, path, BRONZE_SCHEMA))


def q_append_replay(spark, sf_dir):
    b0, b1 = _batches(_good_dead(spark, sf_dir)[0])
    return _appended(spark, "append_replay", (b0, "bronze", 0), (b0, "bronze", 0), (b1, "bronze", 1))


def q_append_old_version(spark, sf_dir):
    b0, b1 = _batches(_good_dead(spark, sf_dir)[0])
    return _appended(spark, "append_old_version", (b0, "bronze", 0), (b1, "bronze", 1), (b1, "bronze", 0))


def q_append_other_app(spark, sf_dir):
    b0, b1 = _batches(_good_dead(spark, sf_dir)[0])
    return _appended(spark, "append_other_app", (b0, "bronze", 0), (b1, "bronze", 1), (b0, "bronze-restarted", 0))


def q_replace_all(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    silver, _ = to_silver(good)
    path = scratch_path(spark, "replace_all") + "/silver"
    tb.replace_all(good, path)  # a stale table with another schema
    tb.replace_all(silver, path)
    return _out(tb.read_table(spark, path, SILVER_SCHEMA))


def q_append_merge_schema(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    _, quarantined = to_silver(good)
    path = scratch_path(spark, "append_merge_schema") + "/dq_results"

    def results(run):
        return dq_results(source=good, quarantined=quarantined, run_id=run, checked_at=CHECKED_AT)

    tb.append(results("r-old").drop("threshold", "passed"), path, partition_by=(DQ_PARTITION,))
    tb.append(results("r-new"), path, partition_by=(DQ_PARTITION,))
    return _out(tb.read_table(spark, path, DQ_SCHEMA))


# --------------------------------------------------------------------- streams


class Crash(RuntimeError):
    """Injected: the driver dies after a batch's first write, before Spark's commit."""


def _crash_in(layout: Layout, crash_batch: int):
    """A micro-batch body that lands bronze of ``crash_batch`` and then dies."""

    def body(batch, batch_id):
        if batch_id != crash_batch:
            land_batch(batch, batch_id, bronze_path=layout.path("bronze"), dlq_path=layout.path("bronze_dlq"), clock=arrival_clock())
            return
        rows = tag_parseable(to_bronze(batch, ingested_at=arrival_clock()))
        tb.append_once(good_of(rows), layout.path("bronze"), app_id="bronze", version=batch_id, partition_by=(BRONZE_PARTITION,))
        raise Crash(f"after bronze of batch {batch_id}")

    return body


def _streamed(spark, sf_dir, name, *, crash_batch=None) -> Layout:
    root = scratch_path(spark, name)
    rows = _log(spark, sf_dir)
    log, admitted = _log_files(rows, root, _records_per_file(rows))
    layout = Layout(f"{root}/warehouse")
    if crash_batch is not None:
        query = start(read_log_stream(spark, log, max_per_trigger=admitted), _crash_in(layout, crash_batch),
                      checkpoint_path=layout.checkpoints, trigger={"availableNow": True})
        try:
            drain(query, STREAM_TIMEOUT_S)
        except Exception as exc:  # the injected crash is expected; anything else is real
            if "Crash" not in str(exc):
                raise
        else:
            raise RuntimeError("the injected crash did not happen")
    ingest(spark, layout, log, max_per_trigger=admitted, clock=arrival_clock(), timeout_s=STREAM_TIMEOUT_S)
    return layout


def q_stream_ingest(spark, sf_dir):
    return _out(_streamed(spark, sf_dir, "stream_ingest").read(spark, "bronze"))


def q_stream_crash_replay(spark, sf_dir):
    return _out(_streamed(spark, sf_dir, "stream_crash_replay", crash_batch=1).read(spark, "bronze"))


def q_stream_dlq(spark, sf_dir):
    return _out(_streamed(spark, sf_dir, "stream_dlq", crash_batch=0).read(spark, "bronze_dlq"))


def q_stream_cleared_checkpoint(spark, sf_dir):
    """The log grows between two runs and the checkpoint is lost: the second run is refused;
    under a new app id the whole log lands again, and log positions tell copies apart."""
    root = scratch_path(spark, "stream_cleared_checkpoint")
    log = _log(spark, sf_dir)
    early = F.col("timestamp") < F.lit(datetime(2024, 1, 16, tzinfo=UTC))
    per_file = _records_per_file(log)
    path, admitted = _log_files(log.where(early), root, per_file)
    layout = Layout(f"{root}/warehouse")

    def run(**where):
        ingest(spark, layout, path, max_per_trigger=admitted, clock=arrival_clock(), timeout_s=STREAM_TIMEOUT_S, **where)

    run()
    write_log(log.where(~early), path, max_records_per_file=per_file)
    cleared = f"{root}/cleared"
    try:
        run(checkpoint_path=cleared)
    except CheckpointLost:
        run(checkpoint_path=cleared, app_id="bronze-2")
    else:
        raise RuntimeError("an empty checkpoint over landed batches was not refused")
    landed = layout.read(spark, "bronze")
    return _out(landed.dropDuplicates(["kafka_topic", "kafka_partition", "kafka_offset"]))


def _delivery(*, time: str = "timestamp", partition: str = "partition", lagging: bool = True) -> Column:
    """Which micro-batch brings a log row: its week; one log partition lags a week behind."""
    week = F.lit(0)
    for cut in DELIVERY_CUTS:
        week = week + (F.col(time) >= F.lit(cut)).cast("int")
    return week + (F.col(partition) == LAGGING).cast("int") if lagging else week


def _delivered(spark, log: DataFrame, path: str) -> int:
    """The log as files in the order of delivery; how many of them make a micro-batch."""
    batched = log.withColumn("_batch", _delivery())
    for n in range(len(DELIVERY_CUTS) + 2):
        write_log(batched.where(F.col("_batch") == n).drop("_batch").repartition(FILES_A_BATCH), path)
    return FILES_A_BATCH


def q_stream_dedup_watermark(spark, sf_dir):
    """Rows kept and rows behind the watermark; what is in neither repeats a kept row."""
    root = scratch_path(spark, "stream_dedup")
    admitted = _delivered(spark, _log(spark, sf_dir), f"{root}/log")
    drain(start_dedup_stream(read_log_stream(spark, f"{root}/log", max_per_trigger=admitted), root=f"{root}/out",
                             checkpoint_path=f"{root}/_checkpoint", delay=WATERMARK_DELAY, clock=arrival_clock()),
          STREAM_TIMEOUT_S)
    kept, late = (rows(spark, f"{root}/out").select("transaction_id", "kafka_partition", "kafka_offset", F.lit(outcome).alias("outcome"))
                  for rows, outcome in ((kept_rows, "kept"), (late_rows, "late")))
    return kept.union(late)


# --------------------------------------------------------------------- runs


def _landed_batches(spark, sf_dir, name) -> Layout:
    """Bronze and dead letters as two micro-batches leave them."""
    layout = Layout(scratch_path(spark, name) + "/warehouse")
    good, dead = _good_dead(spark, sf_dir)
    for rows, table, app in ((good, "bronze", "bronze"), (dead, "bronze_dlq", dead_letters_of("bronze"))):
        for version, part in enumerate(_batches(rows)):
            tb.append_once(part, layout.path(table), app_id=app, version=version, partition_by=(BRONZE_PARTITION,))
    return layout


def q_refine_summary(spark, sf_dir):
    layout = _landed_batches(spark, sf_dir, "refine_summary")
    s = refine(spark, layout, run_id=RUN_ID, checked_at=CHECKED_AT)
    return spark.createDataFrame(
        [(s["run_id"], s["bronze_rows"], s["silver_rows"], s["quarantined_rows"],
          len(s["gold_dates"]), len(s["dq_breaches"]))],
        "run_id string, bronze_rows long, silver_rows long, quarantined_rows long, "
        "gold_dates long, dq_breaches long",
    )


def q_refine_gate(spark, sf_dir):
    """A run whose gate trips: what it wrote before it raised."""
    layout = _landed_batches(spark, sf_dir, "refine_gate")
    try:
        refine(spark, layout, run_id=RUN_ID, checked_at=CHECKED_AT, thresholds=threshold_override(GATE_THRESHOLD))
        raised = False
    except DataQualityBreach:
        raised = True
    checks = layout.read(spark, "dq_results").agg(F.count(F.lit(1)).alias("dq_rows"), F.count_if(~F.col("passed")).alias("failed_checks"))
    mart = layout.read(spark, "gold").agg(F.count(F.lit(1)).alias("gold_rows"),
                                          F.coalesce(F.sum("total_amount_minor"), F.lit(0)).cast("long").alias("gold_amount"))
    return checks.join(mart).withColumn("raised", F.lit(raised))


def q_daily_rerun(spark, sf_dir):
    """The daily sequence over a warehouse in which a batch died half way, then again under the
    same name: nothing doubles, and the dead batch's rows are gone."""
    layout = _landed_batches(spark, sf_dir, "daily_rerun")
    good, _ = _good_dead(spark, sf_dir)
    crashed = tb.batch_folder(layout.path("bronze"), "bronze-dead", 0)
    good.where("kafka_partition = 0").write.partitionBy(BRONZE_PARTITION).parquet(crashed)
    tb.drop_folder(spark, f"{crashed}/{tb.DONE}")
    swept = [len(run_daily(spark, layout, RUN_ID, retain_hours=0)["swept"]) for _ in range(2)]
    checks = layout.read(spark, "dq_results").agg(F.count(F.lit(1)).alias("dq_rows"), F.max("rows_checked").alias("rows_checked"))
    mart = layout.read(spark, "gold").agg(F.count(F.lit(1)).alias("gold_rows"),
                                          F.coalesce(F.sum("total_amount_minor"), F.lit(0)).cast("long").alias("gold_amount"))
    return checks.join(mart).withColumns({"swept_first": F.lit(swept[0]).cast("long"), "swept_again": F.lit(swept[1]).cast("long"),
                                          "bronze_rows": F.lit(layout.read(spark, "bronze").count())})


def _refined_by_run(spark, sf_dir, name) -> IncrementalLayout:
    """Three runs over batches that arrive out of order: retries and the last days first, then
    the first days, then the rest, so that rows taken early lose their place later."""
    layout = IncrementalLayout(scratch_path(spark, name) + "/warehouse")
    good, _ = _good_dead(spark, sf_dir)
    day, retry = F.col(BRONZE_PARTITION), F.col("kafka_offset") % 2 == 1
    first = retry | (day >= F.lit(REBATCH_SPLIT))
    early = day < F.lit(BATCH_SPLIT)
    for version, part in enumerate((first, ~first & early, ~first & ~early)):
        tb.append_once(good.where(part), layout.path("bronze"), app_id="bronze", version=version, partition_by=(BRONZE_PARTITION,))
        refine_new(spark, layout, run_id=f"{RUN_ID}-{version}", checked_at=CHECKED_AT)
    return layout


def q_refine_incremental(spark, sf_dir):
    """Silver and quarantine after incremental runs: what a full run makes of all bronze."""
    layout = _refined_by_run(spark, sf_dir, "refine_incremental")
    return _out(layout.read(spark, "silver").drop(VERDICT, GOLD_PARTITION))


def q_refine_incremental_dq(spark, sf_dir):
    """DQ rows of the last incremental run: counts over all bronze, added up from the runs'."""
    layout = _refined_by_run(spark, sf_dir, "refine_incremental_dq")
    return _out(layout.read(spark, "dq_results").where(F.col(DQ_PARTITION) == f"{RUN_ID}-2").withColumn(DQ_PARTITION, F.lit(RUN_ID)))


def q_mart_deltas(spark, sf_dir):
    """The mart added up from the runs' deltas, rows taken back included."""
    return _out(_refined_by_run(spark, sf_dir, "mart_deltas").mart(spark))


def q_mart_deltas_folded(spark, sf_dir):
    layout = _refined_by_run(spark, sf_dir, "mart_deltas_folded")
    fold_deltas(spark, layout)
    return _out(layout.mart(spark))


def q_upsert_mart(spark, sf_dir):
    """A mart that counted quarantined rows too, put right by key: groups restated, and those
    that no clean row is left of deleted."""
    path = scratch_path(spark, "upsert_mart") + "/gold"
    good, _ = _good_dead(spark, sf_dir)
    rows = judged(good)
    dirty = daily_account_totals(rows.where("quarantine_reason = '' OR event_time < '2024-01-21'"))
    tb.replace_partitions(dirty, path, column=GOLD_PARTITION, values=[])
    bad = dated(rows.where("quarantine_reason <> '' AND event_time < '2024-01-21'")).select(*GRAIN).distinct()
    right = daily_account_totals(rows.where("quarantine_reason = ''")).withColumn("_there", F.lit(True))
    same = [bad[g].eqNullSafe(right[g]) for g in GRAIN]
    fixed = bad.join(right, same, "left").select(*(bad[g] for g in GRAIN), *(right[m] for m in MEASURES), right["_there"].isNull().alias("gone"))
    tb.upsert(fixed, path, key=GRAIN, partition_by=[GOLD_PARTITION], schema=MART_SCHEMA, deleted="gone")
    return _out(tb.read_table(spark, path, MART_SCHEMA))


def q_compact_rows(spark, sf_dir):
    layout = _landed_batches(spark, sf_dir, "compact_rows")
    out = layout.path("bronze") + "_compacted"
    tb.compact(spark, layout.path("bronze"), out, schema=BRONZE_SCHEMA, partition_by=(BRONZE_PARTITION,))
    return _out(tb.read_table(spark, out, BRONZE_SCHEMA))


def q_expire_rows(spark, sf_dir):
    """A crashed batch leaves a folder without its end mark; a sweep removes it alone."""
    layout = _landed_batches(spark, sf_dir, "expire_rows")
    good, _ = _good_dead(spark, sf_dir)
    crashed = tb.batch_folder(layout.path("bronze"), "bronze", 2)
    good.write.partitionBy(BRONZE_PARTITION).parquet(crashed)
    tb.drop_folder(spark, f"{crashed}/{tb.DONE}")
    tb.sweep(spark, layout.path("bronze"), retain_hours=0)
    return _out(layout.read(spark, "bronze"))


# --------------------------------------------------------------------- log & generator


def q_log_roundtrip(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    msgs = good.select(
        "transaction_id", "account_id", "counterparty_id", "amount_minor", "currency",
        "status", "event_time", F.col("produced_at").alias("ingest_time"),
        F.col("kafka_offset").alias("seq"), F.col("kafka_timestamp").alias("produced"),
    )
    log = keyed_log(to_wire(msgs), sequence="seq", timestamp="produced")
    path = scratch_path(spark, "log_roundtrip") + "/log"
    write_log(log, path)
    back = to_bronze(read_log(spark, path), ingested_at=CHECKED_AT)
    return _out(back.select(
        "transaction_id", "account_id", "counterparty_id", "amount_minor", "currency",
        "status", "event_time", "produced_at", "kafka_key", "kafka_topic",
    ))


def q_generated_log_profile(spark, sf_dir):
    ensure_utc(spark)
    ids = events(spark, sf_dir).select(F.col("event_id").alias("seq"))
    n = ids.count()
    log = generate_log(ids, n, seed=GEN_SEED, defects=CLI_DEFECTS, clock=GEN_CLOCK)
    parsed = to_bronze(log, ingested_at=GEN_CLOCK)
    return parsed.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("transaction_id").alias("distinct_transaction_ids"),
        F.count_if(F.col("account_id").isNull() | F.col("amount_minor").isNull()
                   | F.col("currency").isNull()).alias("null_field_rows"),
        F.count_if(F.col("amount_minor") < 0).alias("negative_amounts"),
        F.count_if(F.col("currency") == "XYZ").alias("unknown_currency_rows"),
    )


# --------------------------------------------------------------------- audits


def _landed(spark, sf_dir):
    good, dead = _good_dead(spark, sf_dir)
    return audit.landed_positions(good, dead)


def q_offset_gaps(spark, sf_dir):
    return audit.offset_gaps(_landed(spark, sf_dir))


def q_offset_missing(spark, sf_dir):
    log = _log(spark, sf_dir)
    arrived = log.where(F.col("offset") % 1000 != LOST_OFFSETS)  # the others never land
    good, dead = split_parseable(to_bronze(arrived, ingested_at=arrival_clock()))
    return audit.offset_missing(log, audit.landed_positions(good, dead))


def q_offset_not_in_bronze(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return audit.offset_missing(_log(spark, sf_dir), good.select(*audit.LOG_POSITION))


def q_offset_lost_after_rebatch(spark, sf_dir):
    """The loss that ``ingest`` refuses to risk, forced through the tables, and X1 finding it.

    A first run lands batch 0 (rows ingested before the 16th) and dies. A restart on a
    cleared checkpoint draws larger batches: its batch 0 (before the 21st) counts as done,
    its batch 1 lands. Rows of the 16th to the 20th are lost; the audit reports them.
    """
    layout = Layout(scratch_path(spark, "offset_lost_after_rebatch") + "/warehouse")
    day = F.col(BRONZE_PARTITION)
    runs = [(0, day < F.lit(BATCH_SPLIT)), (0, day < F.lit(REBATCH_SPLIT)), (1, day >= F.lit(REBATCH_SPLIT))]
    for rows, table, app in zip(_good_dead(spark, sf_dir), ("bronze", "bronze_dlq"), ("bronze", dead_letters_of("bronze"))):
        for version, part in runs:
            tb.append_once(rows.where(part), layout.path(table), app_id=app, version=version, partition_by=(BRONZE_PARTITION,))
    landed = audit.landed_positions(layout.read(spark, "bronze"), layout.read(spark, "bronze_dlq"))
    return audit.offset_missing(_log(spark, sf_dir), landed)


def q_offset_reconcile(spark, sf_dir):
    return audit.offset_reconcile(_log(spark, sf_dir), _landed(spark, sf_dir))


def q_retry_conflicts(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return audit.retry_report(good)


def q_ingest_lag(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return audit.ingest_lag(good)


def q_key_spread(spark, sf_dir):
    good, _ = _good_dead(spark, sf_dir)
    return audit.key_spread(good)


def q_distinct_counts(spark, sf_dir):
    return audit.distinct_counts(_good_dead(spark, sf_dir)[0])


def q_dlq_replay(spark, sf_dir):
    recovered = audit.replay_dlq(_good_dead(spark, sf_dir)[1])
    again = (recovered, "replay.event-time-fallback", 0)  # a replayed replay lands once
    return _appended(spark, "dlq_replay", again, again)


QUERIES: dict[str, Query] = {
    "bronze_parse": q_bronze_parse,
    "bronze_good": q_bronze_good,
    "bronze_dlq": q_bronze_dlq,
    "dlq_reason_counts": q_dlq_reason_counts,
    "wire_violations": q_wire_violations,
    "silver_dedup": q_silver_dedup,
    "silver_lateness": q_silver_lateness,
    "silver_clean": q_silver_clean,
    "silver_quarantine": q_silver_quarantine,
    "quarantine_reason_counts": q_quarantine_reason_counts,
    "dq_results": q_dq_results,
    "dq_breaches": q_dq_breaches,
    "dq_trend": q_dq_trend,
    "daily_account_totals": q_daily_account_totals,
    "affected_dates": q_affected_dates,
    "gold_rebuild_twice": q_gold_rebuild_twice,
    "gold_late_restate": q_gold_late_restate,
    "gold_vanished_date": q_gold_vanished_date,
    "append_replay": q_append_replay,
    "append_old_version": q_append_old_version,
    "append_other_app": q_append_other_app,
    "replace_all": q_replace_all,
    "append_merge_schema": q_append_merge_schema,
    "stream_ingest": q_stream_ingest,
    "stream_crash_replay": q_stream_crash_replay,
    "stream_dlq": q_stream_dlq,
    "stream_cleared_checkpoint": q_stream_cleared_checkpoint,
    "stream_dedup_watermark": q_stream_dedup_watermark,
    "refine_summary": q_refine_summary,
    "refine_gate": q_refine_gate,
    "daily_rerun": q_daily_rerun,
    "refine_incremental": q_refine_incremental,
    "refine_incremental_dq": q_refine_incremental_dq,
    "mart_deltas": q_mart_deltas,
    "mart_deltas_folded": q_mart_deltas_folded,
    "upsert_mart": q_upsert_mart,
    "compact_rows": q_compact_rows,
    "expire_rows": q_expire_rows,
    "log_roundtrip": q_log_roundtrip,
    "generated_log_profile": q_generated_log_profile,
    "offset_gaps": q_offset_gaps,
    "offset_missing": q_offset_missing,
    "offset_not_in_bronze": q_offset_not_in_bronze,
    "offset_lost_after_rebatch": q_offset_lost_after_rebatch,
    "offset_reconcile": q_offset_reconcile,
    "retry_conflicts": q_retry_conflicts,
    "ingest_lag": q_ingest_lag,
    "key_spread": q_key_spread,
    "distinct_counts": q_distinct_counts,
    "dlq_replay": q_dlq_replay,
}
