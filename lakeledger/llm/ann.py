"""Approximate nearest neighbours (cosine) over several shifted Hilbert orderings.

Each curve projects unit vectors to a few random directions, shifts the grid, and sorts
by the Hilbert key of the cell. Near vectors stand near each other on most curves: a
query looks at the key windows around its own on every curve; what they hold is merged
and ranked by exact cosine on the original vectors, in double precision.

Distribution: equal vectors are collapsed first (each distinct vector keeps the few
smallest ids that can ever be among the nearest, chosen by a window limit before the
shuffle), so a very common vector is one row. A curve's keys are cut at quantiles into
at most ``WINDOWS`` ranges; (curve, range) groups meet the queries whose window covers
them, by hash cells of at most about ``CELL_ROWS`` rows on either side. Cells return
only each query's best few.

Why the windows are a share of the rows and not a fixed number: embeddings without
low-dimensional structure put a true neighbour almost anywhere within the nearest tenth
of a curve. The work is queries x rows x ``CURVES`` x (2 * REACH + 1) / ``WINDOWS``, for a
stated query set, in blocks; recall is measured against brute force in the tests.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take
no part; vectors of different lengths are not neighbours, each length is searched by itself;
fewer candidates than asked for: all of them; ties go to the smaller id. An empty table
gives an empty result. Repeated ids count as one row per distinct vector, which is a query
and a candidate for itself (but not for its own id). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import col, lookup_join, staged

CURVES = 8
DIRECTIONS, BITS = 6, 10
#: Ranges a curve is cut into, fewest rows of a range, and ranges looked at to either side.
WINDOWS, RANGE_ROWS, REACH = 50, 64, 4
CELL_ROWS = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of ``cells`` (n, m), coordinates below
    2**bits: the coordinates are turned to the curve's transposed form bit by bit (undo
    the rotations, then the Gray code), and the bits interleaved."""
    x = [c.astype(np.uint64) for c in cells.T]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(len(x)):
            turned = (x[i] & top) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip = np.where(x[-1] & np.uint64(1 << bit) != 0, flip ^ np.uint64((1 << bit) - 1), flip)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | (((c ^ flip) >> np.uint64(bit)) & one)
    return key


def curve_cells(unit: np.ndarray, curve: int, seed: int) -> np.ndarray:
    """Grid cells of unit vectors on one curve: random directions, random shift. Along a
    random direction unit vectors spread by 1 / sqrt(dims); the grid spans 4 of that."""
    dims = unit.shape[1]
    rng = np.random.default_rng([seed, curve, dims])
    m = min(DIRECTIONS, dims)
    directions = np.linalg.qr(rng.normal(size=(dims, m)))[0]
    scaled = (unit @ directions) * np.sqrt(dims) / 8.0 + 0.5 + rng.uniform(-0.1, 0.1, m)
    return (np.clip(scaled, 0.0, 1.0 - 1e-9) * (1 << BITS)).astype(np.uint64)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return fine & F.exists(vector, lambda x: x != 0)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def nearest(df: DataFrame, k: int, is_query: Column, *, id: str = "vec_id", vector: str = "embedding",
            curves: int = CURVES, reach: int = REACH, seed: int = 0) -> DataFrame:
    """For each row where ``is_query`` (over the column ``vec_id``): its ``k`` nearest other
    rows, as (query_id, rank from 1, vec_id, score)."""
    raw = df.select(col(id).alias("vec_id"), col(vector).alias("vec")).where("vec_id IS NOT NULL").where(_usable(F.col("vec")))
    rows = staged(raw.withColumn("dims", F.size("vec")).distinct(), "ann-rows")
    lengths = [r.dims for r in rows.select("dims").distinct().orderBy("dims").collect()]  # one for each kind of embedding
    found = [_nearest(rows.where(F.col("dims") == d).drop("dims"), k, is_query, curves, reach, seed) for d in lengths or [0]]
    return reduce(DataFrame.union, found)


def _nearest(rows: DataFrame, k: int, is_query: Column, curves: int, reach: int, seed: int) -> DataFrame:
    """``nearest`` over distinct rows (vec_id, vec) of one length."""
    spark = rows.sparkSession
    # One row per distinct vector, with the k + 1 smallest ids: a query can itself be one.
    # Its number follows its smallest id, so ties by number are ties by id.
    ids = rows.selectExpr("vec", "vec_id", "row_number() OVER (PARTITION BY vec ORDER BY vec_id) AS nth").where(f"nth <= {k + 1}")
    grouped = ids.groupBy("vec").agg(F.min("vec_id").alias("first"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    numbered = grouped.repartitionByRange("first", "vec").sortWithinPartitions("first", "vec")
    groups = staged(numbered.select("vec", F.monotonically_increasing_id().alias("gid"), "ids"), "ann-vectors")
    queries = staged(rows.where(is_query).join(groups.select("vec", "gid"), "vec").select("vec_id", "gid"), "ann-queries")
    asked = queries.select("gid").distinct()
    n, n_asked = groups.count(), asked.count()

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                unit = _unit(_matrix(f["vec"]))
                for c in range(curves):
                    yield pd.DataFrame({"gid": f["gid"], "curve": c, "key": hilbert_keys(curve_cells(unit, c, seed), BITS).astype(np.int64)})

    keys = staged(groups.select("gid", "vec").mapInPandas(keyed, "gid long, curve int, key long"), "ann-keys")
    windows = max(1, min(WINDOWS, n // RANGE_ROWS))
    cuts = [i / windows for i in range(1, windows)]
    edges = (keys.groupBy("curve").agg(F.percentile_approx("key", cuts, 20_000).alias("edges")) if cuts
             else spark.range(curves).selectExpr("CAST(id AS INT) AS curve", "CAST(array() AS ARRAY<BIGINT>) AS edges"))
    ranged = staged(lookup_join(keys, edges, "curve", curves * windows).selectExpr(
        "gid", "curve", "size(filter(edges, e -> e < key)) AS rng"), "ann-ranges")

    # Cells: hash shares of a (curve, range) group on both sides, so none outgrows a task.
    shares = max(1, ceil(n / windows / CELL_ROWS))
    asked_shares = max(1, ceil(n_asked * (2 * reach + 1) / windows / CELL_ROWS))
    held = ranged.join(groups.select("gid", "vec"), "gid").withColumn("a", F.pmod(F.xxhash64("gid"), F.lit(shares))).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(asked_shares - 1))))
    looking = (ranged.join(asked, "gid").join(groups.select("gid", "vec"), "gid")
               .withColumn("rng", F.expr(f"explode(sequence(greatest(rng - {reach}, 0), least(rng + {reach}, {windows - 1})))"))
               .withColumn("b", F.pmod(F.xxhash64("gid", F.lit(1)), F.lit(asked_shares)).cast("int"))
               .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))))
    top = k + 1

    def best(held_rows: pd.DataFrame, asked_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held_rows) and len(asked_rows):
            held_rows = held_rows.sort_values("gid")
            have, have_ids = _matrix(held_rows["vec"]), held_rows["gid"].to_numpy()
            have_norm = np.linalg.norm(have, axis=1)
            for at in range(0, len(asked_rows), 256):
                part = asked_rows.iloc[at:at + 256]
                want = _matrix(part["q_vec"])
                score = (want @ have.T) / (np.linalg.norm(want, axis=1)[:, None] * have_norm[None, :])
                # A stable sort of the few rows at or above the k-th score: ties to the smaller id.
                floor = -np.partition(-score, min(top, score.shape[1]) - 1, axis=1)[:, min(top, score.shape[1]) - 1]
                for q, line, least in zip(part["q"].to_numpy(), score, floor):
                    good = np.flatnonzero(line >= least)
                    good = good[np.argsort(-line[good], kind="stable")][:top]
                    out.append(pd.DataFrame({"q": q, "gid": have_ids[good], "score": line[good]}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "gid": [], "score": []})

    cell = ("curve", "rng", "a", "b")
    looking = looking.select(*(F.col(c).alias(f"q_{c}") for c in cell), F.col("gid").alias("q"), F.col("vec").alias("q_vec"))
    found = held.select(*cell, "gid", "vec").groupBy(*cell).cogroup(looking.groupBy(*(f"q_{c}" for c in cell))).applyInPandas(best, "q long, gid long, score double")
    merged = found.groupBy("q", "gid").agg(F.max("score").alias("score"))
    few = merged.selectExpr("*", "row_number() OVER (PARTITION BY q ORDER BY score DESC, gid) AS nth").where(f"nth <= {top}")
    with_ids = few.join(groups.select("gid", "ids"), "gid").groupBy("q").agg(
        F.expr("collect_list(named_struct('s', score, 'ids', ids))").alias("found"))
    return (queries.withColumnRenamed("vec_id", "query_id").join(with_ids, F.col("gid") == F.col("q"))
            .selectExpr("query_id", f"""slice(sort_array(filter(flatten(transform(found, f -> transform(f.ids, i ->
                named_struct('far', -f.s, 'vec_id', i)))), x -> x.vec_id != query_id)), 1, {k}) AS best""")
            .selectExpr("query_id", "posexplode(best) AS (nth, x)")
            .selectExpr("query_id", "nth + 1 AS rank", "x.vec_id AS vec_id", "-x.far AS score"))
