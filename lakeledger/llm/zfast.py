"""Prefix trie of conversations, built as a z-fast trie.

A conversation is its sequence of turns; a turn counts as its role and text together. A
prefix of d turns has a 128-bit fingerprint: sums of hashes of (place, turn), so prefix sums
give all of them and a long conversation is split over tasks. The trie is held compacted: a
node for each prefix where conversations branch or end, with the edge that leads to it. A
node is hashed under its *handle*, the prefix whose depth in the edge (p, e] is the
two-fattest number there: the one divisible by the highest power of two.

Conversations are inserted in batches of growing size. A *fat binary search* over the depths
of a conversation (each probe one join with the handles, log2 of the depth many) ends at the
deepest node on its path; the child that its next turn leads to is the exit node, and the
common part of that edge tells where it leaves. Splits of old edges and the rest of each
conversation, cut where those of the batch branch or end, make the new trie. So a prefix
that many share is walked once, and later conversations bring only what is new.

Sums over subtrees come by pointer doubling: each node adds its sums to its 1st, 2nd, 4th...
ancestor, log2 of the height rounds. At the end every edge is expanded into a node a turn.

A conversation is cut into pieces of ``BLOCK`` turns, each hung under the node where the one
before it ends, so no row, array or search depends on how long a conversation is. Equal
conversations are one string with a count from the start. Order inside a conversation comes
from a range partitioning, so one that holds a third of all turns is dealt over many tasks.
Texts are read once, for their digest and length. What runs through one task for one prefix
is the digest over the ids of those conversations that end there, a stream of ids in order.

Edge cases: null role or text is empty; null turns come first, equal turns of a conversation
stand in the order of the SHA-256 of role and text; repeated rows are repeated turns. Rows
with a null conversation id belong to none and are left out. Ids without a turn end at the
root. Without any id there is no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import col, lookup_join, staged

BLOCK = 256  # turns of a piece
BATCHES = 3  # each three times the one before it
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["a", "b", "e"]  # fingerprint and depth
LOW32 = "4294967295L"


# ------------------------------------------------------------------ turns in order


def positioned(turns: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos from 0, token, chars) of every row with an id, written once."""
    said = turns.select(col(id).alias("conv"), col(turn).alias("turn"), F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(col(text).cast("string"), F.lit("")).alias("text")).where("conv IS NOT NULL")
    slim = said.selectExpr("conv", "turn", "substring(unhex(sha2(concat(octet_length(role), ':', role, text), 256)), 1, 16) AS token",
                           "CAST(char_length(text) AS LONG) AS chars", "monotonically_increasing_id() AS salt")
    order = ["conv", "turn", "token", "salt"]  # the salt deals out repeated rows
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order).selectExpr(
        "conv", "token", "chars", "spark_partition_id() AS block", "monotonically_increasing_id() AS at")
    ranged = staged(ranged, "zfast-order")
    here = ranged.selectExpr("*", "row_number() OVER (PARTITION BY conv, block ORDER BY at) - 1 AS here")
    # Conversations that go on from an earlier block: one at most for each border.
    before = (ranged.groupBy("conv", "block").count()
              .selectExpr("conv", "block", "sum(count) OVER (PARTITION BY conv ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before")
              .where("before > 0"))
    return staged(here.join(F.broadcast(before), ["conv", "block"], "left").selectExpr(
        "conv", "CAST(here + coalesce(before, 0) AS INT) AS pos", "token", "chars"), "zfast-turns")


def with_heads(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Conversations rebuilt: for each of ``ids`` (conv, base, head) the first ``head`` turns
    of ``base``, all if fewer, then its own turns after its first ``head``."""
    n = ids.count()
    most = ids.agg(F.max("head")).first()[0] or 0
    first = rows.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    lengths = first.groupBy("base").agg(F.count(F.lit(1)).cast("int").alias("length"))
    known = lookup_join(ids, lengths, "base", 2 * n, "left").selectExpr("conv", "base", "head", "least(head, coalesce(length, 0)) AS lead")
    heads = lookup_join(first, known.select("conv", "base", "head"), "base", 3 * n).where("pos < head")
    own = lookup_join(rows, known.select("conv", "head", "lead"), "conv", 3 * n).where("pos >= head")
    return heads.select("conv", "pos", "token", "chars").union(own.selectExpr("conv", "pos - head + lead AS pos", "token", "chars"))


def pieces(rows: DataFrame) -> DataFrame:
    """Conversations cut into pieces of BLOCK turns: (conv, ends, d0, e, key of both depths,
    arr), ``arr`` holding key and cumulated characters of the prefixes d0 + 1 to e."""
    halves = rows.selectExpr("conv", "pos", f"pos DIV {BLOCK} AS piece", "chars AS s5", "xxhash64(pos, token) AS x", "xxhash64(token, pos, 1L) AS y").selectExpr(
        "conv", "pos", "piece", "shiftright(x, 32) AS s1", f"x & {LOW32} AS s2", "shiftright(y, 32) AS s3", f"y & {LOW32} AS s4", "s5")
    own = Window.partitionBy("conv", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = [f"s{i}" for i in range(1, 6)]
    summed = halves.select("conv", "piece", "pos", *(F.sum(s).over(own).alias(s) for s in sums))
    runs = summed.groupBy("conv", "piece").agg(F.sort_array(F.collect_list(F.struct("pos", *sums))).alias("run"))
    runs = staged(runs, "zfast-runs")
    full = runs.where(f"size(run) = {BLOCK} OR piece > 0").selectExpr("conv", "piece", "run[size(run) - 1] AS last")
    past = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = full.select("conv", "piece", F.lead("piece").over(Window.partitionBy("conv").orderBy("piece")).isNotNull().alias("more"),
                          *(F.sum(f"last.{s}").over(past).alias(f"c{s[1]}") for s in sums))
    carried = staged(carried.where("more OR piece > 0"), "zfast-carried")
    joined = lookup_join(runs, carried, ["conv", "piece"], 8 * carried.count(), "left").fillna(0, [f"c{i}" for i in range(1, 6)])

    def key(depth: str, s: str) -> str:
        at = [f"{s}{i} + c{i}" if s else f"c{i}" for i in range(1, 6)]
        return (f"named_struct('a', xxhash64({at[0]}, {at[1]}, {at[2]}, {at[3]}, {depth}), "
                f"'b', xxhash64({depth}, {at[3]}, {at[2]}, {at[1]}, {at[0]}, 1L), 'cum', {at[4]})")

    return staged(
        joined.selectExpr("conv", "NOT coalesce(more, false) AS ends", f"CAST(piece * {BLOCK} AS INT) AS d0",
                          f"IF(piece = 0, named_struct('a', 0L, 'b', 0L, 'cum', 0L), {key(f'CAST(piece * {BLOCK} AS INT)', '')}) AS base",
                          f"transform(run, r -> {key('r.pos + 1', 'r.s')}) AS arr")
        .selectExpr("conv", "ends", "d0", "base", "arr", "arr[size(arr) - 1].a AS a", "arr[size(arr) - 1].b AS b", "d0 + size(arr) AS e"),
        "zfast-pieces")


# ------------------------------------------------------------------ the compacted trie


def fattest(l: str, r: str) -> str:
    """SQL text for the two-fattest number in (l, r]."""
    return f"({r} & shiftleft(-1, length(bin({l} ^ {r})) - 1))"


def locate(strings: DataFrame, nodes: DataFrame) -> DataFrame:
    """``strings`` with their exit node: ``l`` (depth of the deepest node on the path),
    ``lcp`` (depth where it leaves the trie), and the child it leaves in, if any (ca, cb, ce)."""
    n, size = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("e") - F.col("p")), F.lit(0))).first()
    if not n:
        return strings.selectExpr("*", "d0 AS l", "d0 AS lcp", "0L AS ca", "0L AS cb", "CAST(NULL AS INT) AS ce")
    deepest = strings.agg(F.max(F.col("e") - F.col("d0"))).first()[0] or 0
    handles = nodes.selectExpr("a AS xa", "b AS xb", "e AS xe", "p AS xp", f"{fattest('p', 'e')} AS hf", "arr").selectExpr(
        "xa", "xb", "xe", "xp", "hf", "arr[hf - xp - 1].a AS ha", "arr[hf - xp - 1].b AS hb")
    state, kept = strings.selectExpr("*", "d0 AS l", "e AS r"), [*strings.columns]
    for _ in range(int(deepest).bit_length()):
        # A search that is over probes for itself, so such rows don't meet under one key.
        probe = state.selectExpr("*", f"IF(l < r, {fattest('l', 'r')}, -1) AS hf").selectExpr(
            "*", "IF(l < r, get(arr, hf - d0 - 1).a, a) AS ha", "IF(l < r, get(arr, hf - d0 - 1).b, b) AS hb")
        found = lookup_join(probe, handles, ["ha", "hb", "hf"], 7 * n, "left").selectExpr(
            "*", "coalesce(xe <= e AND get(arr, xe - d0 - 1).a = xa AND get(arr, xe - d0 - 1).b = xb, false) AS whole")
        state = found.selectExpr(*kept, "CASE WHEN xe IS NULL THEN l WHEN whole THEN xe ELSE xp END AS l",
                                 "CASE WHEN l >= r THEN r WHEN xe IS NULL THEN hf - 1 WHEN whole THEN r ELSE xp END AS r")
    children = nodes.selectExpr("arr[0].a AS fa", "arr[0].b AS fb", "p AS fp", "a AS ca", "b AS cb", "e AS ce", "arr AS carr")
    asked = state.selectExpr("*", "IF(l < e, l, -1) AS fp", "IF(l < e, get(arr, l - d0).a, a) AS fa", "IF(l < e, get(arr, l - d0).b, b) AS fb")
    same = "filter(carr, (x, i) -> coalesce(get(arr, l - d0 + i).a = x.a AND get(arr, l - d0 + i).b = x.b, false))"
    return lookup_join(asked, children, ["fa", "fb", "fp"], 6 * n + 3 * size, "left").selectExpr(
        *kept, "l", f"IF(ce IS NULL, l, l + size({same})) AS lcp", "ca", "cb", "ce")


def edges(cut: DataFrame) -> DataFrame:
    """Nodes with their edges, from paths (d0, base, arr) cut from depth ``start`` on at the
    depths ``at``."""
    prefix = "IF({d} = d0, base, get(arr, {d} - d0 - 1))"
    return (cut.selectExpr("d0", "base", "arr", "start", "at", "posexplode(at) AS (i, e)")
            .selectExpr("d0", "base", "arr", "e", "IF(i = 0, start, get(at, i - 1)) AS p")
            .selectExpr("arr[e - d0 - 1].a AS a", "arr[e - d0 - 1].b AS b", "e", "p", f"{prefix.format(d='p')} AS parent",
                        "slice(arr, p - d0 + 1, e - p) AS arr")
            .dropDuplicates(KEY))


def insert(nodes: DataFrame, batch: DataFrame) -> DataFrame:
    """The trie with the strings of ``batch``."""
    located = staged(locate(batch, nodes), "zfast-located")
    splits = located.where("lcp > l AND lcp < ce").groupBy("ca", "cb", "ce").agg(F.sort_array(F.collect_set("lcp")).alias("cuts"))
    n_splits = splits.count()
    old = lookup_join(nodes, splits.withColumnsRenamed({"ca": "a", "cb": "b", "ce": "e"}), KEY, (3 + BLOCK) * n_splits, "left")
    old = edges(old.selectExpr("p AS d0", "parent AS base", "arr", "p AS start", "concat(coalesce(cuts, array()), array(e)) AS at"))

    fresh = located.where("lcp < e")
    steps = fresh.selectExpr(*KEY, "d0", "arr", "explode(sequence(lcp + 1, e)) AS d").selectExpr(
        *KEY, "d", "arr[d - d0 - 1].a AS ka", "arr[d - d0 - 1].b AS kb", "get(arr, d - d0) AS next")
    marks = staged(steps.groupBy("ka", "kb", "d").agg(
        (F.min("next.a").eqNullSafe(F.max("next.a")) & F.min("next.b").eqNullSafe(F.max("next.b"))
         & (F.count("next") == F.count(F.lit(1)))).alias("through")).where("NOT through").drop("through"), "zfast-marks")
    cuts = (lookup_join(steps.select(*KEY, "d", "ka", "kb"), marks, ["ka", "kb", "d"], 3 * marks.count(), "left_semi")
            .groupBy(*KEY).agg(F.sort_array(F.collect_set("d")).alias("at")))
    new = edges(fresh.join(cuts, KEY).selectExpr("d0", "base", "arr", "lcp AS start", "at"))
    return staged(old.unionByName(new), "zfast-nodes")


def compacted(strings: DataFrame, batches: int = BATCHES) -> DataFrame:
    """All nodes but the root: key (a, b, e), depth ``p`` and key of the parent, edge."""
    nodes = strings.sparkSession.createDataFrame([], strings.selectExpr(
        *KEY, "d0 AS p", "base AS parent", "arr").schema)
    parts = (3**batches - 1) // 2
    share = F.pmod(F.xxhash64(*KEY, F.lit(3)), F.lit(parts))
    for i in range(batches):
        nodes = insert(nodes, strings.where((share >= (3**i - 1) // 2) & (share < (3 ** (i + 1) - 1) // 2)))
    return nodes


# ------------------------------------------------------------------ sums over subtrees


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` (key, up = the parent's key or null, n, low, w, u, leaves), each sum taken
    over the subtree, ``low`` its minimum."""
    sums = {"n": F.sum, "low": F.min, "w": F.sum, "u": F.sum, "leaves": F.sum}
    nodes = staged(nodes, "zfast-sums")
    while left := nodes.where("up IS NOT NULL").count():
        given = nodes.where("up IS NOT NULL").groupBy("up").agg(*(f(c).alias(f"g_{c}") for c, f in sums.items())).selectExpr(
            "up.a AS a", "up.b AS b", "up.e AS e", *(f"g_{c}" for c in sums))
        above = nodes.selectExpr("named_struct('a', a, 'b', b, 'e', e) AS up", "up AS next")
        added = lookup_join(nodes, given, KEY, 8 * left, "left").select(
            *KEY, "up", *(F.least("low", "g_low").alias(c) if c == "low" else (F.col(c) + F.coalesce(f"g_{c}", F.lit(0))).alias(c) for c in sums))
        going = lookup_join(added.where("up IS NOT NULL"), above, "up", 8 * left).select(*KEY, F.col("next").alias("up"), *sums)
        nodes = staged(going.unionByName(added.where("up IS NULL")), "zfast-sums")
    return nodes


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 over the ids (conv, ascending, joined by commas) that end at each key. Ids run
    through a task in order; it holds the state of one digest, not the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for a, b, e, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b, e) != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (a, b, e), hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield out(done)
        if now is not None:
            yield out([(*now, state.hexdigest())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[*KEY, "sha"])

    ordered = ends.select(*KEY, "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv")
    return ordered.mapInArrow(run, "a long, b long, e int, sha string")


def prefix_trie(rows: DataFrame, ids: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The nodes of the trie of conversations ``rows`` (conv, pos from 0 without gaps, token,
    chars); ``ids`` (conv) names all conversations, those without a turn too. A node:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    cut = pieces(rows)
    strings = staged(cut.select(*KEY, "d0", "base", "arr").dropDuplicates(KEY), "zfast-strings")
    turnless = ids.select("conv").distinct().join(cut.where("d0 = 0").select("conv"), "conv", "left_anti")
    ends = staged(cut.where("ends").select(*KEY, "conv").unionByName(
        turnless.selectExpr("0L AS a", "0L AS b", "0 AS e", "conv")), "zfast-ends")

    root = ends.limit(1).selectExpr("0L AS a", "0L AS b", "0 AS e", "-1 AS p", "CAST(NULL AS STRUCT<a: BIGINT, b: BIGINT, cum: BIGINT>) AS parent",
                                    "array(named_struct('a', 0L, 'b', 0L, 'cum', 0L)) AS arr")
    nodes = staged(compacted(strings, batches).unionByName(root), "zfast-trie")
    n = nodes.count()
    counted = lookup_join(nodes, ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("here"), F.min("conv").alias("low")), KEY, 5 * n, "left")
    below = nodes.where("p >= 0").groupBy(F.col("parent.a").alias("a"), F.col("parent.b").alias("b"), F.col("p").alias("e")).agg(
        F.count(F.lit(1)).alias("n_children"))
    counted = lookup_join(counted, below, KEY, 4 * n, "left").selectExpr(
        *KEY, "p", "parent", "arr", "coalesce(here, 0L) AS here", "low", "coalesce(n_children, 0L) AS n_children",
        "arr[size(arr) - 1].cum AS cum", "coalesce(parent.cum, 0L) AS past")
    counted = staged(counted, "zfast-counted")
    sums = subtree_sums(counted.selectExpr(
        *KEY, "IF(p < 0, NULL, named_struct('a', parent.a, 'b', parent.b, 'e', p)) AS up", "here AS n", "low", "here * cum AS w",
        "cum - past AS u", "IF(n_children = 0, 1L, 0L) AS leaves")).drop("up")

    known = lookup_join(counted.drop("low"), sums, KEY, 8 * n)
    known = lookup_join(known.withColumns({"pa": F.col("parent.a"), "pb": F.col("parent.b")}),
                        sums.selectExpr("a AS pa", "b AS pb", "e AS p", "low AS above"), ["pa", "pb", "p"], 4 * n, "left")
    known = known.join(digests(ends), KEY, "left")
    # A node a turn: depth d of the edge, with the characters before it.
    return known.selectExpr("*", "posexplode(arr) AS (i, step)").selectExpr(
        "low AS conv_id", "CAST(p + 1 + i AS LONG) AS depth", "IF(i = 0, above, low) AS parent_conv_id", "n AS n_convs",
        "IF(p + 1 + i = e, n_children, 1L) AS n_children", "leaves AS n_leaves",
        "IF(i = 0, past, get(arr, i - 1).cum) AS before", "past", "w", "u", "n", f"IF(p + 1 + i = e, coalesce(sha, '{EMPTY}'), '{EMPTY}') AS ends_sha256",
    ).selectExpr("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                 "(w - n * before) - (u - (before - past)) AS saved_tokens", "ends_sha256")


def conversation_trie(turns: DataFrame, *, id: str = "conv_id", **columns) -> DataFrame:
    """The trie of the conversations as they are: ``turns`` with id, turn, role and text."""
    rows = positioned(turns, id=id, **columns)
    return prefix_trie(rows, rows.select("conv").distinct())
