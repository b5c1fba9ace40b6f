"""The daily mart as partial totals that add up: one frame of deltas a run.

A run writes what its rows add to a group and, as negative rows, what rows that no longer
count took part with. Counts and sums of a group are sums over its deltas. A newest time
can't be taken back, so a group that loses a row has its newest time counted again from the
rows that are left, and the delta says so (``restarts``): newest times of earlier runs no
longer count for that group. Runs are ordered by ``run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.operators.gold import GRAIN, MEASURES, daily_account_totals, dated
from lakeledger.schemas import MART_SCHEMA

NEWEST = "last_ingested_at"
ADDED_UP = tuple(m for m in MEASURES if m != NEWEST)
RUN, RESTARTS = "run", "restarts"
DELTA_SCHEMA = T.StructType([*MART_SCHEMA.fields, T.StructField(RESTARTS, T.BooleanType()), T.StructField(RUN, T.LongType())])


def deltas(added: DataFrame, taken: DataFrame, left: DataFrame, *, run: int) -> DataFrame:
    """One row for each group that ``run`` touches. ``added`` and ``taken`` are silver rows
    that begin and cease to count; ``left`` holds (at least) all rows of the groups of
    ``taken`` as they are now."""
    more, less = daily_account_totals(added), daily_account_totals(taken)
    counted = more.withColumn("_lost", F.lit(False)).unionByName(less.select(
        *GRAIN, *(-F.col(m) for m in ADDED_UP), F.lit(None).cast("timestamp").alias(NEWEST), F.lit(True).alias("_lost")
    ).toDF(*GRAIN, *ADDED_UP, NEWEST, "_lost"))
    summed = counted.groupBy(*GRAIN).agg(*(F.sum(m).alias(m) for m in ADDED_UP), F.max(NEWEST).alias(NEWEST),
                                         F.bool_or("_lost").alias(RESTARTS))
    hit = less.select(*(F.col(g).alias(f"_{g}") for g in GRAIN))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in GRAIN]
    again = dated(left).join(hit, same, "left_semi").groupBy(*GRAIN).agg(F.max("ingested_at").alias("_again")).select(
        *(F.col(g).alias(f"_{g}") for g in GRAIN), "_again")
    newest = F.when(F.col(RESTARTS), F.col("_again")).otherwise(F.col(NEWEST)).alias(NEWEST)
    return summed.join(again, same, "left").select(*GRAIN, *ADDED_UP, newest, RESTARTS, F.lit(run).cast("long").alias(RUN))


def mart_of(parts: DataFrame) -> DataFrame:
    """The mart from the deltas of all runs. A group without a row left is not in it."""
    newest = F.max(F.when(F.col(RUN) >= F.coalesce("_since", F.lit(-1)), F.col(NEWEST))).alias(NEWEST)
    since = F.expr(f"max(IF({RESTARTS}, {RUN}, NULL)) OVER (PARTITION BY {', '.join(GRAIN)})")
    return (parts.withColumn("_since", since).groupBy(*GRAIN).agg(*(F.sum(m).alias(m) for m in ADDED_UP), newest)
            .where("transaction_count > 0").select(*MART_SCHEMA.names))


def folded(parts: DataFrame, *, run: int) -> DataFrame:
    """The deltas of all runs as one of ``run``: what compaction of old runs writes."""
    return mart_of(parts).withColumns({RESTARTS: F.lit(True), RUN: F.lit(run).cast("long")})
