"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target (in words); every document of it should be taken
``target / source words`` times, a fractional number of copies. The whole part is taken
outright; the fractional parts are rounded in pairs: between two documents, word mass
moves in a random direction (probabilities keep each document's expectation) until one
of the two becomes integral; the other meets the next document. Mass is counted in
words, so a source's taken words change only when its very last residual is rounded:
they end within one document's size of the target.

Distribution: documents are dealt by a hash of their content into blocks of about
``block_rows`` rows inside their source, so a hot source is split; each block is
rounded in one streaming pass and leaves at most one residual. Residuals are paired
again, ``FAN_IN`` blocks to one, until one per source is left, which is rounded by a
coin. Only (source, key, size) rows move, never texts.

Decisions depend on content alone (source, key columns, size), so reruns agree however
the input is split; identical rows are interchangeable.

Edge cases: a document without words has nothing to take (0 copies, target as its
source's); a null source is a source, last in order; a source without words has target
0; an empty table gives an empty result. Input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import col, lookup_join, others, staged, words

#: Residuals of so many blocks are paired in one block of the next level.
FAN_IN = 256


def n_words(text: str) -> Column:
    """Words of a text column, as long (null: 0)."""
    return F.expr(f"CAST(size({words('`' + text + '`')}) AS BIGINT)")


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``totals`` (source, source_size, ...) -> the same with ``target``: ``share`` times
    all words dealt by ``weights``, which repeat over the sources in code point order
    (null last); no target exceeds ``cap`` times its source's words, and what a capped
    source can't take is dealt again by weight.

    Dealing again until none is above its cap ends at one water level L with
    target = min(cap, weight * L). Sources are sorted by the level at which they cap;
    running sums give the level after each. One row per source goes through this.
    """
    by_name = "ORDER BY source ASC NULLS LAST"
    every = ", ".join(f"{float(w)!r}D" for w in weights)
    weighed = totals.selectExpr(
        "*", f"element_at(array({every}), CAST((row_number() OVER ({by_name}) - 1) % {len(weights)} + 1 AS INT)) AS weight"
    ).selectExpr("*", f"{cap!r}D * source_size AS most")
    order = "ORDER BY most / weight, source ASC NULLS LAST"
    before = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    levels = weighed.selectExpr(
        "*",
        f"({share!r}D * sum(source_size) OVER () - coalesce(sum(most) {before}, 0D))"
        f" / greatest(sum(weight) OVER () - coalesce(sum(weight) {before}, 0D), 1e-9D) AS level",
    )
    # Capped sources come first; the first uncapped one's level is the water level, and
    # from there on levels only fall, so it is the highest of the uncapped ones'.
    water = levels.selectExpr("*", "max(CASE WHEN level * weight <= most THEN level END) OVER () AS water")
    return water.selectExpr(
        *[f"`{c}`" for c in totals.columns], "CASE WHEN water IS NULL THEN most ELSE least(most, weight * water) END AS target")


def pivotal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over rows sorted by (source, block): within each run of equal (source,
    block) the fractions in ``part`` are rounded pairwise against a carried document.
    ``whole`` counts decided copies; a row leaves with ``part`` 0, but for each run's
    residual. ``u`` in (0, 1) is the row's coin."""
    carried = None  # [row id, source id, block, size, whole, part]
    for frame in frames:
        rows, done = frame[["row", "sid", "block", "size", "whole", "part", "u"]].itertuples(index=False, name=None), []
        for row, sid, block, size, whole, part, u in rows:
            if not 0.0 < part < 1.0:
                done.append((row, sid, block, size, whole + round(part), 0.0))
                continue
            if carried is None:
                carried = (row, sid, block, size, whole, part)
                continue
            c_row, c_sid, c_block, c_size, c_whole, c_part = carried
            if (c_sid, c_block) != (sid, block):
                done.append(carried)
                carried = (row, sid, block, size, whole, part)
                continue
            # Word mass that can move from the carried document to this one, and back.
            there = min(c_part * c_size, (1.0 - part) * size)
            back = min((1.0 - c_part) * c_size, part * size)
            moved = there if u * (there + back) < back else -back
            if moved > 0:
                c_ends, ends = c_part * c_size <= (1.0 - part) * size, (1.0 - part) * size <= c_part * c_size
                c_to, to = 0.0, 1.0
            else:
                c_ends, ends = (1.0 - c_part) * c_size <= part * size, part * size <= (1.0 - c_part) * c_size
                c_to, to = 1.0, 0.0
            c_part = c_to if c_ends else min(max(c_part - moved / c_size, 0.0), 1.0)
            part = to if ends else min(max(part + moved / size, 0.0), 1.0)
            if 0.0 < c_part < 1.0:
                done.append((row, sid, block, size, whole + round(part), 0.0))
                carried = (c_row, c_sid, c_block, c_size, c_whole, c_part)
            else:
                done.append((c_row, c_sid, c_block, c_size, c_whole + round(c_part), 0.0))
                carried = (row, sid, block, size, whole, part)
                if not 0.0 < part < 1.0:
                    done.append((row, sid, block, size, whole + round(part), 0.0))
                    carried = None
        yield pd.DataFrame(done, columns=["row", "sid", "block", "size", "whole", "part"])
    if carried is not None:
        yield pd.DataFrame([carried], columns=["row", "sid", "block", "size", "whole", "part"])


_ROWS = "row long, sid long, block long, size long, whole long, part double"


def _round(df: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the reduction tree: pair inside each (sid, block)."""
    coin = F.expr(f"(shiftrightunsigned(xxhash64({seed}L, {level}L, sid, content, size), 11) + 0.5D) * {2.0**-53!r}D")
    ordered = (df.withColumn("u", coin).repartition("sid", "block")
               .sortWithinPartitions("sid", "block", F.desc("size"), "content", "row"))
    return ordered.select("row", "sid", "block", "size", "whole", "part", "u").mapInPandas(pivotal, _ROWS)


def mix(docs: DataFrame, *, key: tuple[str, ...] = ("doc_id",), source: str = "source", text: str | None = "text",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 0,
        block_rows: int = 4096) -> DataFrame:
    """``docs`` with ``size`` (words of the text), ``source_size``, ``target`` (words its
    source should give) and ``copies`` (how often the mix takes the document). Columns of
    ``docs`` with other names are carried through one write and one join.

    ``text``: the column whose words count, or None if ``docs`` has ``size`` already.
    ``key``: columns that, with the size, tell documents apart for coins and blocks."""
    size = n_words(text) if text else col("size")
    keep = others(docs, ("size", "source_size", "target", "copies"))
    rows = staged(docs.select(
        F.struct(*[col(c) for c in keep]).alias("doc"), col(source).alias("source"),
        size.cast("long").alias("size"),
        F.xxhash64(*[col(c) for c in key]).alias("content"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = staged(source_targets(totals, weights, share, cap).withColumn("sid", F.xxhash64("source")), "mix-targets")
    sources, most = targets.agg(F.count(F.lit(1)), F.max("n")).first()
    blocks = ceil((most or 0) / block_rows)

    per_row = lookup_join(
        rows.select("row", "source", "size", "content").withColumnRenamed("source", "s"), targets,
        F.col("s").eqNullSafe(F.col("source")), 6 * sources)
    open_ = per_row.where("size > 0").selectExpr(
        "row", "sid", f"pmod(xxhash64({seed}L, content, size), CAST(ceil(n / {block_rows}) AS BIGINT)) AS block",
        "size", "content", "target / source_size AS copies"
    ).selectExpr("row", "sid", "block", "size", "content", "CAST(floor(copies) AS BIGINT) AS whole",
                 "copies - floor(copies) AS part")
    contents = rows.select("row", "content")
    settled, level = [], 0
    for level in range(max(1, ceil(log(blocks, FAN_IN)) + 1 if blocks > 1 else 1)):
        result = staged(_round(open_, level, seed), f"mix-level{level}")
        settled.append(result.where("part = 0"))
        open_ = result.where("part > 0").join(contents, "row").withColumn(
            "block", F.expr(f"CAST(floor(block / {FAN_IN}) AS BIGINT)"))
    coin = f"(shiftrightunsigned(xxhash64({seed}L, -1L, sid, content), 11) + 0.5D) * {2.0**-53!r}D"
    last = open_.selectExpr("row", "whole + IF(part > 0 AND {} < part, 1L, 0L) AS whole".format(coin))
    decided = last
    for part in settled:
        decided = decided.unionByName(part.select("row", "whole"))
    wide = lookup_join(rows, targets.select(F.col("source").alias("s"), "source_size", "target"),
                       F.col("source").eqNullSafe(F.col("s")), 4 * sources)
    return wide.join(decided, "row", "left").selectExpr(
        "doc.*", "size", "source_size", "target", "coalesce(whole, 0L) AS copies")
