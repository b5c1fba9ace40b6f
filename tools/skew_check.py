"""Skew check (not a registered query): a third of all rows on one id and one account.

Usage: python tools/skew_check.py <fresh scratch dir> [rows]
Runs dedup, the mart, the retry report and the offset audits over a synthetic
bronze frame and prints, per stage, task count and max / median task time from
the Spark event log, so a hot key that lands in one task shows up as max >> median.
"""

from __future__ import annotations

import glob
import io
import json
import statistics
import sys
import time
from datetime import UTC, datetime

import zstandard
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, ".")
from lakeledger.operators import audit  # noqa: E402
from lakeledger.operators.gold import daily_account_totals  # noqa: E402
from lakeledger.operators.silver import deduplicate, to_silver  # noqa: E402


def main():
    out = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 6_000_000
    spark = (SparkSession.builder.master("local[8]").appName("skew")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", out)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = datetime(2024, 1, 1, tzinfo=UTC)
    hot = F.pmod(F.col("id"), F.lit(3)) == 0
    bronze = spark.range(0, n, numPartitions=32).select(
        F.when(hot, F.lit("txn_hot")).otherwise(F.concat(F.lit("txn_"), F.col("id").cast("string")))
        .alias("transaction_id"),
        F.when(F.pmod(F.col("id"), F.lit(3)) == 1, F.lit("acc_hot"))
        .otherwise(F.concat(F.lit("acc_"), F.pmod(F.col("id"), F.lit(5000)).cast("string")))
        .alias("account_id"),
        F.lit("acc_x").alias("counterparty_id"),
        (F.pmod(F.col("id"), F.lit(1000)) + 1).alias("amount_minor"),
        F.lit("INR").alias("currency"),
        F.lit("SETTLED").alias("status"),
        F.timestamp_seconds(F.lit(int(base.timestamp())) + F.pmod(F.col("id"), F.lit(86400 * 30)))
        .alias("event_time"),
        F.timestamp_seconds(F.lit(int(base.timestamp())) + F.pmod(F.col("id"), F.lit(86400 * 30)) + 5)
        .alias("ingested_at"),
        F.lit("txn.raw").alias("kafka_topic"),
        F.pmod(F.col("id"), F.lit(6)).cast("int").alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
    ).withColumn("produced_at", F.col("event_time")).withColumn("ingest_date", F.to_date("ingested_at"))
    silver, _ = to_silver(bronze)
    steps = {
        "dedup": deduplicate(bronze),
        "mart": daily_account_totals(silver),
        "retry_report": audit.retry_report(bronze),
        "offset_gaps": audit.offset_gaps(bronze.select(*audit.LOG_POSITION)),
        "key_spread": audit.key_spread(bronze),
    }
    for name, df in steps.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:14s} {time.perf_counter() - t0:6.1f}s")
    spark.stop()
    tasks, names = {}, {}
    logs = [p for p in glob.glob(f"{out}/**/*", recursive=True)
            if p.split("/")[-1].startswith(("local-", "events_"))]
    for path in logs:
        opener = open(path, "rb")
        stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(opener), encoding="utf-8") \
            if path.endswith(".zstd") else io.TextIOWrapper(opener, encoding="utf-8")
        for line in stream:
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
            elif e.get("Event") == "SparkListenerJobStart":
                desc = e.get("Properties", {}).get("spark.job.description", "")
                for s in e["Stage IDs"]:
                    names[s] = desc
    for sid in sorted(tasks):
        ts = tasks[sid]
        if len(ts) > 1 and max(ts) > 0.5:
            print(f"stage {sid:3d} {names.get(sid, ''):14s} tasks={len(ts):3d} "
                  f"max={max(ts):5.2f}s median={statistics.median(ts):5.2f}s")


if __name__ == "__main__":
    main()
