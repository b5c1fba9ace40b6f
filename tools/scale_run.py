"""Scale run (not a registered query): generated log -> ingest -> refine -> compacted copy.

Usage: python tools/scale_run.py <fresh scratch dir> <messages>
Writes the log, the tables, checkpoints and a Spark event log under the scratch dir.
"""
import sys, time, json
sys.path.insert(0, "/root/repo")
from datetime import UTC, datetime
from pyspark.sql import SparkSession
out = sys.argv[1]; n = int(sys.argv[2])
spark = (SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress","false").config("spark.ui.enabled","false")
         .config("spark.sql.shuffle.partitions","64").config("spark.driver.memory","16g")
         .config("spark.checkpoint.dir", out + "/ckpt")
         .config("spark.eventLog.enabled","true").config("spark.eventLog.dir", out)
         .getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from lakeledger.session import ensure_utc
ensure_utc(spark)
from lakeledger.operators.generate import generate_log, CLI_DEFECTS
from lakeledger.sources.log import write_log
from lakeledger.plans.medallion import Layout, ingest, refine
from lakeledger.sources.tables import compact
t = {}
t0 = time.perf_counter()
ids = spark.range(0, n, numPartitions=64).withColumnRenamed("id", "seq")
log = generate_log(ids, n, seed=7, defects=CLI_DEFECTS, clock=datetime(2026, 9, 24, 12, tzinfo=UTC))
rows = write_log(log, out + "/log", max_records_per_file=max(1, n // 32))
t["generate+write_log"] = time.perf_counter() - t0
lay = Layout(out + "/wh")
t0 = time.perf_counter(); ingest(spark, lay, out + "/log", max_per_trigger=8); t["ingest(4 batches)"] = time.perf_counter() - t0
t0 = time.perf_counter(); s = refine(spark, lay, run_id="scale"); t["refine"] = time.perf_counter() - t0
t0 = time.perf_counter(); c = compact(spark, lay.path("bronze"), lay.path("bronze") + "_compacted"); t["compact bronze"] = time.perf_counter() - t0
print(json.dumps({"n": n, "log_rows": rows, "seconds": {k: round(v, 1) for k, v in t.items()},
                  "summary": {k: v for k, v in s.items() if k != "gold_dates"}, "compact": c}, default=str))
