"""Print the physical plans of the pipeline's main steps over stored tables.

Usage: python tools/show_plans.py [sf_dir]
Builds bronze/DLQ tables from the fixture log in a fresh scratch folder, then
explains: silver (dedup + rules), the mart, the single-pass DQ counts, a gold
partition rebuild write, offset gaps and retry conflicts.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

sys.path.insert(0, ".")
from lakeledger.operators import audit  # noqa: E402
from lakeledger.operators.gold import daily_account_totals  # noqa: E402
from lakeledger.operators.quality import dq_results  # noqa: E402
from lakeledger.operators.silver import judged, to_silver  # noqa: E402
from lakeledger.plans.registry import _landed_batches  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    layout = _landed_batches(spark, sf_dir, "show_plans")
    bronze = layout.read(spark, "bronze")
    silver, quarantined = to_silver(bronze)
    steps = {
        "silver (dedup, lateness, rules) over the bronze table": judged(bronze),
        "daily_account_totals over silver": daily_account_totals(silver),
        "dq_results (one pass)": dq_results(source=bronze, quarantined=quarantined, run_id="r"),
        "mart scoped to two dates, as rebuild writes it":
            daily_account_totals(silver.where("to_date(event_time) IN "
                                              "(DATE'2024-01-02', DATE'2024-01-03')"))
            .hint("rebalance", "event_date"),
        "offset_gaps over bronze + DLQ":
            audit.offset_gaps(audit.landed_positions(bronze, layout.read(spark, "bronze_dlq"))),
        "retry_report": audit.retry_report(bronze),
        "bronze read with a partition filter and two columns":
            bronze.where("ingest_date = DATE'2024-01-05'").select("transaction_id", "amount_minor"),
    }
    for title, df in steps.items():
        print(f"\n### {title}\n")
        df.explain("formatted")


if __name__ == "__main__":
    main()
