"""Offset audits on bitmaps (X1): positions become bits before anything is shuffled.

Offsets of a (topic, partition) are cut into ranges of 32,768. Each task turns its rows
into one bitmap of 4 kB for each range, tables and log alike; what is shuffled is one
bitmap per task and range, whatever the number of rows. Missing, unknown and distinct
positions are bit counts of unions. Only ranges where counts don't agree are looked at bit
by bit, and only ranges where rows outnumber bits go back to their rows for the repeats.
Offsets are zero or more, as a log's are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.operators.audit import LOG_POSITION, log_positions

RANGE = 32_768  # positions of a bitmap
TOPIC, PARTITION, OFFSET = LOG_POSITION
GROUP = (TOPIC, PARTITION, "range")
NO_BITS = f"CAST(unhex(repeat('00', {RANGE // 8})) AS BINARY)"


def _ranged(positions: DataFrame) -> DataFrame:
    return positions.select(TOPIC, PARTITION, F.expr(f"{OFFSET} DIV {RANGE}").alias("range"), F.expr(f"{OFFSET} % {RANGE}").alias("at"))


def bitmaps(positions: DataFrame) -> DataFrame:
    """(topic, partition, range, bits, rows) of log positions, repeats included."""
    return _ranged(positions).groupBy(*GROUP).agg(F.bitmap_construct_agg("at").alias("bits"), F.count(F.lit(1)).alias("rows"))


def _both(log: DataFrame, landed: DataFrame) -> DataFrame:
    """For each range: bits of the log, of what landed and of either, and the rows behind."""
    sides = [bitmaps(p).selectExpr(*GROUP, *(f"{'bits' if s == side else NO_BITS} AS {s}_bits" for s in ("log", "landed")),
                                   *(f"{'rows' if s == side else '0L'} AS {s}_rows" for s in ("log", "landed")))
             for side, p in (("log", log_positions(log)), ("landed", landed))]
    # One row a side and range: the aggregate below joins two rows, not two tables.
    joined = sides[0].unionByName(sides[1]).groupBy(*GROUP).agg(F.bitmap_or_agg("log_bits").alias("log_bits"), F.bitmap_or_agg("landed_bits").alias("landed_bits"),
                                        F.sum("log_rows").alias("log_rows"), F.sum("landed_rows").alias("landed_rows"))
    return joined.withColumns({f"{s}_at": F.bitmap_count(f"{s}_bits") for s in ("log", "landed")})


def set_positions(bits: str) -> str:
    """SQL text for the sorted positions that are set in a bitmap."""
    byte = f"CAST(conv(substring(hex({bits}), CAST(2 * i + 1 AS INT), 2), 16, 10) AS INT)"
    return (f"flatten(transform(filter(transform(sequence(0, {RANGE // 8 - 1}), i -> named_struct('i', i, 'b', {byte})), x -> x.b > 0),"
            " x -> transform(filter(sequence(0, 7), k -> shiftright(x.b, k) & 1 = 1), k -> x.i * 8 + k)))")


def missing(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Log positions with no landed row, as ``audit.offset_missing``. A range is opened only
    if the union of both sides holds more than what landed."""
    pairs = _both(log, landed)
    either = (pairs.selectExpr(*GROUP, "log_bits AS bits").unionByName(pairs.selectExpr(*GROUP, "landed_bits AS bits"))
              .groupBy(*GROUP).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("either_at")))
    short = pairs.join(either, list(GROUP)).where("either_at > landed_at")
    lost = f"array_except({set_positions('log_bits')}, {set_positions('landed_bits')})"
    return short.selectExpr(TOPIC, PARTITION, "range", f"explode({lost}) AS at").selectExpr(
        TOPIC, PARTITION, f"range * {RANGE} + at AS {OFFSET}")


def gaps(landed: DataFrame) -> DataFrame:
    """Holes in the landed offsets, as ``audit.offset_gaps``: inside ranges from their bits,
    between ranges from their first and last bit."""
    held = bitmaps(landed).selectExpr(*GROUP, f"{set_positions('bits')} AS at")
    inside = held.selectExpr(TOPIC, PARTITION, "range", "inline(filter(transform(at, (x, i) -> named_struct('lo', get(at, i - 1), 'hi', x)),"
                             " g -> g.hi - g.lo > 1))").selectExpr(
        TOPIC, PARTITION, f"range * {RANGE} + lo AS after_offset", f"range * {RANGE} + hi AS before_offset")
    ends = held.selectExpr(TOPIC, PARTITION, "range", f"range * {RANGE} + at[0] AS lo", f"range * {RANGE} + element_at(at, -1) AS hi")
    order = Window.partitionBy(TOPIC, PARTITION).orderBy("range")  # a row a range
    across = ends.select(TOPIC, PARTITION, F.lag("hi").over(order).alias("after_offset"), F.col("lo").alias("before_offset"))
    return inside.unionByName(across.where("before_offset - after_offset > 1")).selectExpr(
        "*", "before_offset - after_offset - 1 AS missing_offsets")


def reconcile(log: DataFrame, landed: DataFrame) -> DataFrame:
    """Per (topic, partition) the counts of ``audit.offset_reconcile``."""
    pairs = _both(log, landed)
    either = (pairs.selectExpr(*GROUP, "log_bits AS bits").unionByName(pairs.selectExpr(*GROUP, "landed_bits AS bits"))
              .groupBy(*GROUP).agg(F.bitmap_or_agg("bits").alias("bits")))
    first, last = f"range * {RANGE} + array_min({set_positions('bits')})", f"range * {RANGE} + array_max({set_positions('bits')})"
    edge = Window.partitionBy(TOPIC, PARTITION)
    spans = (either.withColumns({"lo": F.min("range").over(edge), "hi": F.max("range").over(edge)})
             .selectExpr(*GROUP, "bitmap_count(bits) AS either_at", f"IF(range = lo, {first}, NULL) AS first", f"IF(range = hi, {last}, NULL) AS last"))
    crowded = pairs.where("landed_rows > landed_at").select(*GROUP)
    repeats = (_ranged(landed).join(crowded, list(GROUP), "left_semi").groupBy(*GROUP, "at").count().where("count > 1")
               .groupBy(TOPIC, PARTITION).agg(F.count(F.lit(1)).alias("repeated")))
    totals = pairs.join(spans, list(GROUP)).groupBy(TOPIC, PARTITION).agg(
        F.sum("log_rows").alias("log_rows"), F.sum("landed_rows").alias("landed_rows"),
        F.sum(F.expr("either_at - landed_at")).alias("missing_rows"), F.sum(F.expr("either_at - log_at")).alias("unknown_positions"),
        F.min("first").alias("min_offset"), F.max("last").alias("max_offset"))
    return totals.join(repeats, [TOPIC, PARTITION], "left").select(
        TOPIC, PARTITION, "log_rows", "landed_rows", "missing_rows", F.coalesce("repeated", F.lit(0)).cast("long").alias("repeated_positions"),
        "unknown_positions", "min_offset", "max_offset")
