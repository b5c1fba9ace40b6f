"""Refine by what is new (C2, incremental): each run reads the batches that landed since.

Tables of its own under the warehouse, written as batches of the app id ``refine``, one a
run, so a run that died is run again without a trace:

* ``refine_plan``: the bronze batches that a run takes, fixed before anything is read;
* ``refine_changes``: rows that the run adds, each with the place of the row it replaces;
* ``silver_runs``: the judged rows, by run, verdict and event date;
* ``silver_index``: id -> log position, run, verdict and date of the row that counts;
* ``mart_deltas``, ``dq_deltas``: what the run adds to (and takes from) marts and counts;
* ``refine_done``: the batches taken; its end mark ends the run.

The first arrival of an id counts, whichever batch brings it. The index tells which ids are
there; a row that precedes the held one takes its place, and only the folder that holds
the old row (its run, verdict and date) is read and rewritten. All other old rows stay in
their files, unread.

A run's cost follows the new batches, but for the index: it is read whole (id and place
only), and meets the new ids in one shuffled join, in front of which Spark puts a Bloom
filter of the new ids where they are the small side.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.rules import QUARANTINE_RULES
from lakeledger.operators import delta_mart
from lakeledger.operators.quality import dq_counts, dq_results_of, enforce_gate, run_name
from lakeledger.operators.silver import IDENTITY, QUARANTINE_REASON, judged
from lakeledger.plans.medallion import JUDGED_SCHEMA, VERDICT, Layout
from lakeledger.schemas import BRONZE_SCHEMA, DEFAULT_LATENESS_SECONDS, DQ_PARTITION, GOLD_PARTITION
from lakeledger.sources import tables as tb

APP_ID = "refine"
BATCH_COLUMNS = T.StructType([T.StructField("source_app", T.StringType()), T.StructField("source_batch", T.LongType())])
PLACE = ("kafka_partition", "kafka_offset")
#: Where a judged row is stored.
FOLDER = (tb.APP, tb.BATCH, VERDICT, GOLD_PARTITION)
HELD = T.StructType([T.StructField("run", T.LongType()), T.StructField(VERDICT, T.StringType()), T.StructField(GOLD_PARTITION, T.DateType())])
CHANGE_SCHEMA = T.StructType([*JUDGED_SCHEMA.fields, T.StructField("held", HELD)])
INDEX_SCHEMA = T.StructType([T.StructField(IDENTITY, T.StringType()), *(BRONZE_SCHEMA[p] for p in PLACE), *HELD.fields])
STORED_SCHEMA = T.StructType([*JUDGED_SCHEMA.fields, T.StructField(tb.APP, T.StringType()), T.StructField(tb.BATCH, T.LongType())])


class IncrementalLayout(Layout):
    """A warehouse whose silver is kept by run."""

    TABLES = Layout.TABLES | {
        "silver": ("silver_runs", JUDGED_SCHEMA, (VERDICT, GOLD_PARTITION)),
        "refine_plan": ("refine_plan", BATCH_COLUMNS, ()),
        "refine_done": ("refine_done", BATCH_COLUMNS, ()),
        "refine_changes": ("refine_changes", CHANGE_SCHEMA, ()),
        "silver_index": ("silver_index", INDEX_SCHEMA, ()),
        "mart_deltas": ("mart_deltas", delta_mart.DELTA_SCHEMA, (GOLD_PARTITION,)),
        "dq_deltas": ("dq_deltas", T.StructType([T.StructField(n, T.LongType()) for n in ("rows_checked", *(n for n, _ in QUARANTINE_RULES))]), ()),
    }

    def mart(self, spark: SparkSession) -> DataFrame:
        """The daily mart, added up from the deltas of all runs."""
        return delta_mart.mart_of(self.read(spark, "mart_deltas"))

    def run_rows(self, spark: SparkSession, table: str, run: int) -> DataFrame:
        """What ``run`` wrote to a table."""
        return tb.read_batches(spark, self.path(table), self.TABLES[table][1], [(APP_ID, run)])

    def append_run(self, df: DataFrame, table: str, run: int) -> bool:
        return tb.append_once(df, self.path(table), app_id=APP_ID, version=run, partition_by=self.TABLES[table][2])


def taken(spark: SparkSession, layout: IncrementalLayout) -> set[tuple[str, int]]:
    """Bronze batches that finished runs have taken."""
    if not tb.exists(spark, layout.path("refine_done")):
        return set()
    done = tb.landed_batches(spark, layout.path("refine_done"))
    return {tuple(r) for r in tb.read_batches(spark, layout.path("refine_done"), BATCH_COLUMNS, done).distinct().collect()}


def planned(spark: SparkSession, layout: IncrementalLayout) -> tuple[int, list[tuple[str, int]]]:
    """(run, its bronze batches): those of a run that died, else all that landed since."""
    runs = {n for _, n in tb.landed_batches(spark, layout.path("refine_done"))}
    run = max(runs, default=-1) + 1
    plan = layout.path("refine_plan")
    if (APP_ID, run) not in tb.landed_batches(spark, plan):
        new = sorted(tb.landed_batches(spark, layout.path("bronze")) - taken(spark, layout))
        layout.append_run(spark.createDataFrame(new, BATCH_COLUMNS).coalesce(1), "refine_plan", run)
    return run, sorted(tuple(r) for r in layout.run_rows(spark, "refine_plan", run).collect())


def new_bronze(spark: SparkSession, layout: IncrementalLayout, batches: list[tuple[str, int]]) -> DataFrame:
    return tb.read_batches(spark, layout.path("bronze"), BRONZE_SCHEMA, batches)


def held_places(spark: SparkSession, layout: IncrementalLayout, ids: DataFrame, run: int) -> DataFrame:
    """Where the rows of ``ids`` stand before ``run``: (id, place, run, verdict, date)."""
    path = layout.path("silver_index")
    if not run:
        return spark.createDataFrame([], INDEX_SCHEMA)
    index = tb.read_table(spark, path, INDEX_SCHEMA, batches=True).where(F.col(tb.BATCH) < run).select(*INDEX_SCHEMA.names)
    first = F.min(F.struct(*PLACE, *HELD.names)).alias("at")
    return index.join(ids.select(IDENTITY), IDENTITY, "left_semi").groupBy(IDENTITY).agg(first).select(IDENTITY, "at.*")


def changes(spark: SparkSession, layout: IncrementalLayout, bronze: DataFrame, run: int, *, lateness_seconds: int, rules) -> DataFrame:
    """The rows that ``run`` adds: first arrivals of ids that are new, and of ids whose held
    row came later on the log (``held``: where that one is)."""
    rows = judged(bronze, lateness_seconds=lateness_seconds, rules=rules)
    rows = rows.withColumns({VERDICT: F.when(F.col(QUARANTINE_REASON) == "", "clean").otherwise("quarantined"),
                             GOLD_PARTITION: F.to_date("event_time")})
    held = held_places(spark, layout, bronze, run).select(
        IDENTITY, F.struct(*PLACE).alias("_at"), F.struct(*HELD.names).alias("held"))
    return rows.join(held, IDENTITY, "left").where(F.col("_at").isNull() | (F.struct(*PLACE) < F.col("_at"))).select(*CHANGE_SCHEMA.names)


def refine_new(spark: SparkSession, layout: IncrementalLayout, *, run_id: str | None = None,
               thresholds: Mapping[str, float] | None = None, lateness_seconds: int = DEFAULT_LATENESS_SECONDS,
               checked_at: datetime | None = None, rules=QUARANTINE_RULES) -> dict:
    """Take the bronze batches that landed since the last run into silver, mart and DQ rows.
    Ends like ``refine``: evidence first, then the gate."""
    name = run_name(run_id)
    tb.finish_rewrite(spark, layout.path("silver"), schema=STORED_SCHEMA, partition_by=FOLDER)  # of a run that died
    run, batches = planned(spark, layout)
    bronze = new_bronze(spark, layout, batches)
    layout.append_run(changes(spark, layout, bronze, run, lateness_seconds=lateness_seconds, rules=rules), "refine_changes", run)
    change = layout.run_rows(spark, "refine_changes", run)
    layout.append_run(change.drop("held"), "silver", run)

    # Rows whose place was taken: read from their folders, kept for the deltas, then dropped.
    moved = change.where("held IS NOT NULL").select(
        IDENTITY, F.lit(APP_ID).alias(tb.APP), F.col("held.run").alias(tb.BATCH), f"held.{VERDICT}", f"held.{GOLD_PARTITION}")
    touched = tb.touched_partitions(moved, FOLDER)
    stored = tb.read_table(spark, layout.path("silver"), JUDGED_SCHEMA, batches=True).select(*STORED_SCHEMA.names)
    old = stored.where(tb.in_partitions(touched, FOLDER))
    gone_path = f"{layout.path('silver')}_replaced"
    tb.append_once(old.join(moved, [IDENTITY, *FOLDER], "left_semi").select(*JUDGED_SCHEMA.names), gone_path, app_id=APP_ID, version=run)
    replaced = tb.read_batches(spark, gone_path, JUDGED_SCHEMA, [(APP_ID, run)])
    tb.rewrite_partitions(old.join(moved, [IDENTITY, *FOLDER], "left_anti").select(*STORED_SCHEMA.names), layout.path("silver"),
                          partition_by=FOLDER, touched=touched, schema=STORED_SCHEMA)

    clean, added = F.col(VERDICT) == "clean", layout.run_rows(spark, "silver", run)
    lost_dates = [d for d, in tb.touched_partitions(replaced.where(clean), [GOLD_PARTITION])]
    left = layout.clean(spark).where(F.col(GOLD_PARTITION).isin(lost_dates) if lost_dates else F.lit(False))
    layout.append_run(delta_mart.deltas(added.where(clean), replaced.where(clean), left, run=run), "mart_deltas", run)
    layout.append_run(change.select(IDENTITY, *PLACE, F.lit(run).cast("long").alias("run"), VERDICT, GOLD_PARTITION), "silver_index", run)

    names = [n for n, _ in rules]
    more, less = (dq_counts(checked, rows.where(~clean), rules) for checked, rows in ((bronze, added), (bronze.limit(0), replaced)))
    counted = more.unionByName(less.select(*(-F.col(c) for c in less.columns)).toDF(*less.columns))
    layout.append_run(counted.agg(*(F.sum(c).cast("long").alias(c) for c in ("rows_checked", *names))), "dq_deltas", run)
    results = dq_results_of(layout.read(spark, "dq_deltas"), run_id=name, checked_at=checked_at or datetime.now(UTC),
                            thresholds=thresholds, rules=rules)
    tb.replace_partitions(results, layout.path("dq_results"), column=DQ_PARTITION, values=[name], present=[name])
    layout.append_run(spark.createDataFrame(batches, BATCH_COLUMNS).coalesce(1), "refine_done", run)

    dates = tb.touched_partitions(layout.run_rows(spark, "mart_deltas", run), [GOLD_PARTITION])
    summary = {"run_id": name, "run": run, "batches": batches, "rewritten": touched, "gold_dates": sorted(str(d) for d, in dates)}
    enforce_gate(layout.read(spark, "dq_results"), run_id=name, summary=summary)
    return summary


def fold_deltas(spark: SparkSession, layout: IncrementalLayout, dates: list | None = None) -> int:
    """Merge the mart's deltas of all finished runs into one per group (of ``dates``, or all);
    the mart stays the same, reading it costs one row a group again. Returns the folders
    merged."""
    path, by = layout.path("mart_deltas"), (tb.APP, tb.BATCH, GOLD_PARTITION)
    schema = T.StructType([*delta_mart.DELTA_SCHEMA.fields, T.StructField(tb.APP, T.StringType()), T.StructField(tb.BATCH, T.LongType())])
    parts = tb.read_table(spark, path, delta_mart.DELTA_SCHEMA, batches=True)
    parts = parts.where(F.col(GOLD_PARTITION).isin(list(dates))) if dates is not None else parts
    touched = tb.touched_partitions(parts, by)
    if not touched:
        return 0
    run = max(n for _, n, _ in touched)
    merged = delta_mart.folded(parts.select(*delta_mart.DELTA_SCHEMA.names), run=run).withColumns(
        {tb.APP: F.lit(APP_ID), tb.BATCH: F.lit(run).cast("long")})
    tb.rewrite_partitions(merged.select(*schema.names), path, partition_by=by, touched={*touched, *((APP_ID, run, d) for *_, d in touched)}, schema=schema)
    return len(touched)
