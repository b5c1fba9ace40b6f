"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set is its distinct word shingles. The sketch has ``COORDS`` coordinates,
filled in rounds: in each of the first COORDS rounds every shingle is hashed to one
coordinate, in the next COORDS rounds all shingles go to coordinate 0, 1, ...; a
coordinate keeps the least (round, hash) that reached it, and the work stops after the
round in which the last one fills. So every coordinate of a non-empty set fills, at about
one hash a shingle for large sets, and two sketches agree in a share of coordinates that
concentrates around the sets' similarity. ``BANDS`` bands of ``PER_BAND`` coordinates make
candidates: a pair of similarity 0.8 shares no band with probability 3e-6.

Every candidate link is confirmed on the full sets. To find components without writing
down all pairs of a group:

1. Documents with equal sets are one class (partial aggregation; a hot text is one row).
2. In every bucket the smallest class is compared with the others; links are joined to
   components. That settles most of a group of near copies with one comparison each.
3. ``LEADER_ROUNDS`` times, buckets that still hold several components choose another
   leader, by hash, from their first component and compare it with the members outside.
4. What remains is done in full: in every bucket each member outside the first component
   is compared with all members of other components. Tasks do this cell by cell (hash
   shares of about ``CELL_ROWS`` members on either side) and put out links, not pairs.
   Pairs inside one component need no comparison, since they cannot change the result.
   No bucket is capped.

Only sketches, keys and the sets of candidates move, never texts of other documents.

Words are hashed by a random polynomial over their bytes and mixed to 64 bits; sets are
compared by these hashes (in a document of 20,000 shingles a collision has odds of 1e-11).

Edge cases: null, empty and blank texts have the empty set and are linked with nothing;
a text with fewer words than a shingle is one shingle; a row with a null id is linked
with nothing and kept; rows that share an id are each a node if their texts differ (kept, if
the id is their component's); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import col, lookup_join, small_batches, staged
from lakeledger.llm.components import connected

BANDS, PER_BAND = 32, 5
COORDS = BANDS * PER_BAND
LEADER_ROUNDS = 2
CELL_ROWS = 512

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (xor-shift-multiply)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base, back = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    base[0] = back[0] = 1
    return np.cumprod(base), np.cumprod(back)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order, A-Z as a-z."""
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.r_[False, ~_SPACE[raw], False]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, int(len(raw)).bit_length()))
    sums = np.r_[_U(0), np.cumsum(_BYTE[_LOWER[raw]] * up[:len(raw)])]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The set of a text: sorted distinct hashes of its shingles of ``size`` words."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total + words[i:len(words) - size + 1 + i])
    return np.unique(total)


def sketch(members: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Fast similarity sketch of a non-empty set: 32 bits a coordinate."""
    value = np.zeros(coords, np.uint64)
    empty, done = np.ones(coords, bool), 0
    while done < 2 * coords and empty.any():
        rounds = np.arange(done, min(2 * coords, done + max(1, 2048 // len(members))), dtype=np.uint64)
        h = mix(members[None, :] ^ mix(rounds + _U(1))[:, None])
        place = np.where(rounds[:, None] < coords, (h >> _U(40)) % _U(coords), rounds[:, None] % _U(coords)).astype(np.int64)
        key = ((rounds[:, None] << _U(32)) | (h & _U(0xFFFFFFFF))).ravel()
        order = np.argsort(key)[::-1]  # the least is written last
        now = np.zeros(coords, np.uint64)
        reached = np.zeros(coords, bool)
        now[place.ravel()[order]] = key[order]
        reached[place.ravel()] = True
        value = np.where(empty & reached, now, value)
        empty &= ~reached
        done = int(rounds[-1]) + 1
    return (mix(value) & _U(0xFFFFFFFF)).astype("<u4")


def _long(x: np.ndarray) -> int:
    return int(x.astype(np.uint64).view(np.int64))


def set_key(members: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        return _long(np.sum(mix(members), keepdims=True)[0]), _long(np.sum(mix(members ^ _U(0x5851F42D4C957F2D)), keepdims=True)[0])


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, k1, k2, sketch, version) of each row (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n, k1, k2, sketches = [], [], [], []
            for t in batch.column(1):
                s = shingles(t.as_py(), size)
                a, b = set_key(s) if len(s) else (0, 0)
                n.append(len(s)), k1.append(a), k2.append(b)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(sketches, pa.binary()), batch.column(2)], names=["id", "n", "k1", "k2", "sketch", "version"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.xxhash64("text").alias("version")).mapInArrow(
        run, f"id {kind}, n long, k1 long, k2 long, sketch binary, version long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(k1, k2, members) of each row (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made = [shingles(t.as_py(), size) for t in batch.column(1)]
            keys = [set_key(s) for s in made]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)] + [pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))],
                names=["k1", "k2", "members"])

    return docs.select("id", "text").mapInArrow(run, "k1 long, k2 long, members array<long>")


def _members(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(gid, members): the full sets of the classes ``nodes`` (gid), from their texts."""
    wanted = staged(nodes.join(classes.select("gid", "id", "k1", "k2"), "gid"), "dup-nodes")
    count = wanted.count()
    texts = lookup_join(docs, wanted.select("id").distinct(), "id", count, "left_semi")
    found = lookup_join(_sets(texts, size), wanted.select("gid", "k1", "k2"), ["k1", "k2"], 3 * count)
    return staged(found.groupBy("gid").agg(F.first("members").alias("members")), "dup-sets")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the similarity."""
    named = staged(
        pairs.select("a", "b").join(classes.select(F.col("gid").alias("a"), F.col("n").alias("n_a")), "a")
        .join(classes.select(F.col("gid").alias("b"), F.col("n").alias("n_b")), "b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b"), "dup-pairs")
    nodes = named.select(F.col("a").alias("gid")).union(named.select("b")).distinct()
    sets = _members(nodes, classes, docs, size)
    both = (named.join(sets.select(F.col("gid").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("gid").alias("b"), F.col("members").alias("y")), "b"))
    shared = both.withColumn("shared", F.size(F.array_intersect("x", "y")))
    return shared.where(f"100 * shared >= {percent} * (size(x) + size(y) - shared)").select("a", "b")


def _across(open_: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """All links (a, b) between members of a bucket that lie in different components;
    ``open_`` (bucket, gid, label)."""
    held = open_.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("cells"), F.min("label").alias("main"))
    rows = open_.join(held, "bucket").join(_members(open_.select("gid").distinct(), classes, docs, size), "gid")
    rows = staged(rows.withColumn("own", F.pmod(F.xxhash64("gid"), F.col("cells")).cast("int")), "dup-cells")
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    left = rows.select("bucket", F.col("own").alias("a"), every.alias("b"), "gid", "label", "members")
    right = rows.where("label <> main").select(
        F.col("bucket").alias("bucket_"), every.alias("a_"), F.col("own").alias("b_"), F.col("gid").alias("gid_"),
        F.col("label").alias("label_"), F.col("members").alias("members_"))

    def links(held_rows: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held_rows) and len(outside):
            sets = [np.asarray(m, np.int64) for m in held_rows["members"]]
            sizes, flat = np.array([len(m) for m in sets]), np.concatenate(sets)
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            gids, labels = held_rows["gid"].to_numpy(), held_rows["label"].to_numpy()
            for gid, label, own in zip(outside["gid_"], outside["label_"], outside["members_"]):
                own = np.sort(np.asarray(own, np.int64))
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                shared = np.add.reduceat(own[at] == flat, starts, dtype=np.int64)
                good = (100 * shared >= percent * (sizes + len(own) - shared)) & (labels != label)
                out += [(gid, other) for other in gids[good]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    found = left.groupBy("bucket", "a", "b").cogroup(right.groupBy("bucket_", "a_", "b_")).applyInPandas(links, "a long, b long")
    return found.distinct()


def _components(docs: DataFrame, words: int, percent: int, id: str, text: str) -> DataFrame:
    """(id, version, n, component_id, stays) for each row of ``docs``: the smallest id that
    links lead to, and the smallest (id, version) of the component, the row that stays."""
    plain = docs.select(col(id).alias("id"), col(text).alias("text"))
    rows = staged(_signed(plain, words).withColumn("rid", F.monotonically_increasing_id()), "dup-rows")
    own = rows.where("n > 0 AND id IS NOT NULL")
    classes = staged(
        own.groupBy("k1", "k2").agg(F.min(F.struct("id", "version", "rid")).alias("least"), F.first("n").alias("n"),
                                    F.first("sketch").alias("sketch"))
        .select("k1", "k2", "n", "sketch", F.col("least.id").alias("id"), F.col("least.version").alias("version"),
                F.col("least.rid").alias("gid")), "dup-classes")

    slices = [f"xxhash64({b}, substring(sketch, {b * PER_BAND * 4 + 1}, {PER_BAND * 4}))" for b in range(BANDS)]
    buckets = classes.selectExpr("gid", f"explode(array({', '.join(slices)})) AS bucket")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"), F.min("gid").alias("leader")).where("held > 1")
    members = staged(buckets.join(shared, "bucket"), "dup-buckets")
    compared = staged(members.where("gid <> leader").select(F.col("leader").alias("a"), F.col("gid").alias("b")).distinct(), "dup-star")
    links = staged(_confirm(compared, classes, plain, words, percent), "dup-links0")
    labels = connected(links)

    # Buckets of two are settled by their one comparison.
    open_ = members.where("held > 2").select("bucket", "gid")
    for turn in range(1, LEADER_ROUNDS + 2):
        seen = open_.join(labels.withColumnRenamed("node", "gid"), "gid", "left").withColumn("label", F.coalesce("label", "gid"))
        mixed = seen.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                           F.min(F.struct("label", F.xxhash64(F.lit(turn), "bucket", "gid").alias("h"), "gid")).alias("led"))
        mixed = mixed.where("lo <> hi").select("bucket", F.col("led.gid").alias("leader"), F.col("led.label").alias("leads"))
        open_ = staged(seen.join(mixed, "bucket"), f"dup-open{turn}")
        if open_.isEmpty():
            break
        if turn <= LEADER_ROUNDS:
            new = open_.where("label <> leads").select(F.least("leader", "gid").alias("a"), F.greatest("leader", "gid").alias("b"))
            new = staged(new.distinct().join(compared, ["a", "b"], "left_anti"), f"dup-new{turn}")
            found = _confirm(new, classes, plain, words, percent)
            compared = compared.union(new)
        else:
            found = _across(open_.select("bucket", "gid", "label"), classes, plain, words, percent)
        links = staged(links.union(found), f"dup-links{turn}")
        labels = connected(links)
        open_ = open_.select("bucket", "gid")

    named = classes.join(labels, F.col("gid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "gid"))
    least = named.groupBy("label").agg(F.min(F.struct("id", "version")).alias("stays"))
    by_set = named.join(least, "label").select("k1", "k2", "stays")
    linked = own.join(by_set, ["k1", "k2"]).select("id", "version", "n", F.col("stays.id").alias("component_id"), "stays")
    alone = rows.where("n = 0 OR id IS NULL").select(
        "id", "version", "n", F.col("id").alias("component_id"), F.struct("id", "version").alias("stays"))
    return linked.union(alone)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``: component_id is the
    smallest id that links lead to, kept whether it is the row's own."""
    return _components(docs, words, percent, id, text).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one of smallest id, and of rows that
    share that id the text of smallest hash. Rows are told apart by id and text, so texts
    without a link both stay, whatever their ids; of rows equal in both one stays. Rows
    without a word or an id are linked with nothing: all stay."""
    found = staged(_components(docs, words, percent, id, text).where("n > 0 AND id IS NOT NULL").select(
        F.col("id").alias("__id"), F.col("version").alias("__v"),
        (F.struct("id", "version") != F.col("stays")).alias("gone")), "dup-found")
    gone = staged(found.where("gone").select("__id", "__v").distinct(), "dup-gone")
    again = staged(found.where("NOT gone").groupBy("__id", "__v").count().where("count > 1").select("__id", "__v"), "dup-again")
    same = (col(id) == F.col("__id")) & (F.xxhash64(col(text)) == F.col("__v"))
    left = lookup_join(docs, gone, same, 2 * gone.count(), "left_anti")
    repeats = again.count()
    if not repeats:
        return left
    once = lookup_join(left, again, same, 2 * repeats, "left_semi").dropDuplicates([id, text])
    return lookup_join(left, again, same, 2 * repeats, "left_anti").unionByName(once)
