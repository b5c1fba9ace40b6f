"""Uniform shuffle into shards of exact size (native: DataFrame and SQL functions only).

A communication matrix says how many rows each input partition sends to each shard.
It is drawn exactly: the row sums are the partition sizes, the column sums the shard
sizes, and the entries follow the multivariate hypergeometric law that a uniform
permutation of all rows would give. Each partition permutes its rows and deals them
out by its matrix row; after the one exchange each shard permutes what it got.

Steps, and what each costs:

1. permute locally: ``sortWithinPartitions`` on a random key, written once with the
   partition number and the place in it (no exchange). From here on every decision is
   a function of written columns, so a retried task repeats it.
2. draw the matrix down a binary tree over partitions: a node splits its shard counts
   between its halves by hypergeometric draws (inversion from the mode). One small
   row per node and level; log2(partitions) levels.
3. deal out and permute again: one exchange by (shard, block), where a shard is cut
   into random blocks of about ``block_rows`` rows so that no task holds a shard.

Edge cases: an empty table gives an empty result; with fewer rows than shards the last
shards stay empty; nulls, empty and very long texts and repeated rows are only
carried. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import col, let, lookup_join, others, staged, uniform

ROW = "__row"
PLACE_MASK = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | place


def _log_factorial(x: str) -> str:
    x = f"CAST({x} AS DOUBLE)"
    stirling = (
        f"{x} * ln({x}) - {x} + 0.5D * ln(6.283185307179586D * {x}) + 1D / (12D * {x})"
        f" - 1D / (360D * pow({x}, 3D)) + 1D / (1260D * pow({x}, 5D))"
    )
    return f"IF({x} <= 20D, ln(factorial(CAST(least({x}, 20D) AS INT))), {stirling})"


def _log_choose(n: str, k: str) -> str:
    return f"({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')})"


def hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL text for the number of marked items among ``drawn`` out of ``total``, of
    which ``marked`` are marked; ``u`` is uniform in (0, 1).

    Inversion that visits values outward from the mode until their mass exceeds u. The
    walk is 12 standard deviations and 40 steps long, past which a double holds no mass.
    """
    t, k, n = "g.t", "g.k", "g.n"
    up = f"({k} - g.m) * ({n} - g.m) / ((g.m + 1D) * ({t} - {k} - {n} + g.m + 1D))"
    down = f"g.m * ({t} - {k} - {n} + g.m) / (({k} - g.m + 1D) * ({n} - g.m + 1D))"
    up_next = f"({k} - w.a) * ({n} - w.a) / greatest((w.a + 1D) * ({t} - {k} - {n} + w.a + 1D), 1D)"
    down_next = f"w.b * ({t} - {k} - {n} + w.b) / greatest(({k} - w.b + 1D) * ({n} - w.b + 1D), 1D)"
    spread = f"sqrt({n} * ({k} / {t}) * (1D - {k} / {t}) * ({t} - {n}) / greatest({t} - 1D, 1D))"
    walk = f"""aggregate(
        sequence(1, CAST(ceil(12D * {spread}) AS INT) + 40),
        named_struct('x', CAST(NULL AS DOUBLE), 'rest', g.u - g.f, 'a', g.m + 1D, 'up', g.f * ({up}),
                     'b', g.m - 1D, 'down', g.f * ({down})),
        (w, j) -> IF(w.x IS NOT NULL, w, named_struct(
            'x', CASE WHEN w.rest < w.up THEN w.a WHEN w.rest < w.up + w.down THEN w.b END,
            'rest', w.rest - w.up - w.down,
            'a', w.a + 1D, 'up', w.up * ({up_next}), 'b', w.b - 1D, 'down', w.down * ({down_next}))),
        w -> coalesce(w.x, g.m))"""
    mass = (f"exp({_log_choose('h.k', 'h.m')} + {_log_choose('(h.t - h.k)', '(h.n - h.m)')}"
            f" - {_log_choose('h.t', 'h.n')})")
    inner = let(f"named_struct('t', h.t, 'k', h.k, 'n', h.n, 'm', h.m, 'u', h.u, 'f', {mass})", "g",
                f"IF(g.u < g.f, g.m, {walk})")
    mode = "floor((CAST({n} AS DOUBLE) + 1D) * (CAST({k} AS DOUBLE) + 1D) / (CAST({t} AS DOUBLE) + 2D))"
    mode = mode.format(t=total, k=marked, n=drawn)
    whole = let(
        f"named_struct('t', CAST({total} AS DOUBLE), 'k', CAST({marked} AS DOUBLE), 'n', CAST({drawn} AS DOUBLE),"
        f" 'm', CAST({mode} AS DOUBLE), 'u', {u})", "h", inner)
    return (f"CAST(CASE WHEN {drawn} = 0 OR {marked} = 0 THEN 0 WHEN {marked} = {total} THEN {drawn}"
            f" WHEN {drawn} = {total} THEN {marked} ELSE {whole} END AS BIGINT)")


def split_columns(columns: str, left: str, seed: int) -> str:
    """SQL text: of a node's shard counts ``columns``, those of its left half, which has
    ``left`` rows; shard by shard, each draw given what the earlier ones left over."""
    draw = hypergeometric("s.rest", "c", "s.need", uniform(f"{seed}L", "level", "node", "size(s.out)"))
    step = let(draw, "x", "named_struct('out', concat(s.out, array(x)), 'rest', s.rest - c, 'need', s.need - x)")
    return f"""aggregate({columns},
        named_struct('out', CAST(array() AS ARRAY<BIGINT>), 'rest', aggregate({columns}, 0L, (a, c) -> a + c),
                     'need', {left}),
        (s, c) -> {step}, s -> s.out)"""


def communication_matrix(sizes: DataFrame, shard_sizes: DataFrame, partitions: int, seed: int = 0) -> DataFrame:
    """``sizes`` (p, n): rows of each input partition, p in [0, partitions);
    ``shard_sizes``: one row with ``counts``, an array of the shards' sizes (same total).
    Returns (p, counts): one matrix row for each partition that has rows."""
    levels = ceil(log2(partitions)) if partitions > 1 else 0
    nodes = shard_sizes.select(F.lit(0).cast("long").alias("node"), "counts")
    for level in range(1, levels + 1):
        half = F.shiftright(F.col("p").cast("long"), levels - level)
        left = (sizes.where(half % 2 == 0).groupBy(F.shiftright(half, 1).alias("node"))
                .agg(F.sum("n").alias("left_n")))
        drawn = nodes.join(left, "node", "left").select(
            "node", "counts", F.coalesce("left_n", F.lit(0)).alias("left_n"), F.lit(level).alias("level"))
        drawn = drawn.select("node", "counts", F.expr(split_columns("counts", "left_n", seed)).alias("part"))
        nodes = drawn.selectExpr(
            "inline(array(named_struct('node', node * 2, 'counts', part), named_struct('node', node * 2 + 1,"
            " 'counts', zip_with(counts, part, (c, x) -> c - x))))"
        ).where("exists(counts, c -> c > 0)")
    return nodes.select(F.col("node").cast("int").alias("p"), "counts")


def shuffle_to_shards(df: DataFrame, shards: int, *, seed: int = 0, block_rows: int = 4096) -> DataFrame:
    """``df`` with ``shard`` int in [0, shards) and ``slot`` long, gapless from 0 in each
    shard: a uniformly random arrangement of all rows, shard sizes at most one apart
    (the first ``rows % shards`` shards have one more)."""
    keep = others(df, ("shard", "slot"))
    local = (
        df.select(F.struct(*[col(c) for c in keep]).alias(ROW))
        .withColumn("__key", F.xxhash64(F.lit(seed), F.lit("local"), F.monotonically_increasing_id()))
        .sortWithinPartitions("__key")
        .select(ROW, F.spark_partition_id().alias("p"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_MASK)).alias("place"))
    )
    table = staged(local, "shard-rows")
    sizes = staged(table.groupBy("p").agg(F.count(F.lit(1)).alias("n")), "shard-sizes")
    last, rows = sizes.agg(F.max("p"), F.coalesce(F.sum("n"), F.lit(0))).first()
    partitions = (last or 0) + 1
    base, extra = divmod(rows, shards)
    goal = df.sparkSession.range(1).selectExpr(
        f"transform(sequence(0, {shards - 1}), s -> {base}L + IF(s < {extra}, 1L, 0L)) AS counts")
    matrix = staged(communication_matrix(sizes, goal, partitions, seed), "shard-matrix")

    bounds = matrix.selectExpr(
        "p", "transform(sequence(1, size(counts)), j -> aggregate(slice(counts, 1, j), 0L, (a, c) -> a + c)) AS ends")
    blocks = max(1, ceil(rows / shards / block_rows))
    dealt = lookup_join(table, bounds, "p", partitions * shards).select(
        ROW, "p", "place",
        F.expr("size(filter(ends, e -> e <= place))").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), "p", "place"), F.lit(blocks)).alias("block"),
        F.xxhash64(F.lit(seed), F.lit("slot"), "p", "place").alias("__key"),
    )
    before = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "shard", "block",
        "sum(n) OVER (PARTITION BY shard ORDER BY block ROWS UNBOUNDED PRECEDING) - n AS start")
    placed = lookup_join(dealt, before, ["shard", "block"], 3 * shards * blocks)
    return placed.selectExpr(
        f"{ROW}.*", "shard",
        "start + row_number() OVER (PARTITION BY shard, block ORDER BY __key, p, place) - 1 AS slot")
