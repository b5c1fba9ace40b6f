"""As-of join: each left row meets the latest right row of its key at or before its time.

Both sides are put in one frame and sorted once per (key, block of time); inside a block the
latest right row is carried along the order. What a block begins with is the last right row
of the blocks before it, of which there is one per block: so a key that holds a third of
all rows is spread over its blocks, and no row is joined with a range of others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, left_time: str, right_time: str,
              columns: Sequence[str], order: Sequence[str] = (), block: str = "1 day", prefix: str = "asof_") -> DataFrame:
    """``left`` with ``columns`` of the right row (and its time), prefixed; null where none is.

    Of right rows at the same time the last in ``order`` counts. Keys and times that are null
    match nothing. ``block`` is the span (an interval) that one task sorts at a time."""
    carried = [right_time, *columns]
    seconds = F.unix_seconds(F.expr(f"TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {block}"))

    def at(time: str):
        return F.floor(F.unix_micros(time) / (seconds * 1_000_000)).alias("_block")

    known = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_key).alias("_key"), F.col(right_time).alias("_time"), at(right_time),
        F.struct(*[F.col(c) for c in order]).alias("_order") if order else F.lit(None).cast("struct<>").alias("_order"),
        F.struct(*carried).alias("_right"))
    known = known.withColumn("_order", F.col("_order").cast(known.schema["_order"].dataType))
    asked = left.select(F.col(left_key).alias("_key"), F.col(left_time).alias("_time"), at(left_time), F.struct(*left.columns).alias("_left"))
    # Right before left at the same time: a row counts from its own instant on.
    both = asked.withColumn("_side", F.lit(1)).unionByName(known.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    # Left rows without a key have nothing to meet: dealt by themselves, not as one group.
    both = both.withColumn("_alone", F.when(F.col("_key").isNull() | F.col("_time").isNull(), F.monotonically_increasing_id()))
    inside = Window.partitionBy("_key", "_block", "_alone").orderBy("_time", "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_here", F.last("_right", ignorenulls=True).over(inside)).where("_side = 1")
    last = known.groupBy("_key", "_block").agg(F.max_by("_right", F.struct("_time", "_order")).alias("_last"))
    blocks = asked.where("_key IS NOT NULL AND _block IS NOT NULL").select("_key", "_block").distinct().join(last, ["_key", "_block"], "full_outer")
    past = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    before = blocks.select("_key", "_block", F.last("_last", ignorenulls=True).over(past).alias("_before")).where("_before IS NOT NULL")
    met = found.join(before, ["_key", "_block"], "left").withColumn("_met", F.coalesce("_here", "_before"))
    return met.select("_left.*", *[F.col(f"_met.{c}").alias(f"{prefix}{c}") for c in carried])
