"""Line dedup by a segment-partition edit join (native: DataFrame and SQL functions only).

A line of a document goes when the same line, or one within ``edits`` edits of it, stands
earlier in the corpus (by document id, then line number). Lines shorter than
``MIN_CHARS`` characters take no part in the edit join; with ``short_repeats`` their exact
repeats go all the same, blank lines (empty or white space only) excepted.

The join: a line is cut into edits + 1 segments; two lines within ``edits`` edits share at
least one segment unchanged, moved by a few characters at most. Each distinct line gives
index keys (its segments, with length and number) and probe keys (the substrings at
which a segment of a line of its own or a slightly smaller length could stand; only
starts that a valid alignment can use). Keys that several lines share make candidates.
The texts of the lines that share a key are read again, once; a candidate pair must
agree in its counts of single characters (an edit changes at most two) and is verified
by a banded bit-parallel edit distance: one column of the dynamic program at a time,
its 2 * edits + 1 diagonals as bits of one long.

To decide, it is enough to know *some* earlier near line, not all: in a shared key the
earliest indexed line is compared with the others first. Pairs whose later line already
goes are then skipped, so a family of variants of one line costs one comparison each;
the rest is compared in full, without a cap.

Moves: slim rows (hashes, places), the keys of distinct lines once, and the texts of
candidate lines. A hot line is one distinct line after partial aggregation. Dropped line
numbers meet their documents by a broadcast within the bound of ``lookup_join``, else by
a shuffle join.

Edge cases: null and empty texts have nothing to drop and stay as they are; a text whose
lines all go becomes empty, its row stays; lines are split at \\n only and compared as
they are; rows that share id and text are one document; a null id comes last in order; ids
that aren't whole numbers are ordered as strings; an empty table gives an empty result. Input columns named like an output column are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.llm.common import col, let, lookup_join, others, staged

EDITS = 2
MIN_CHARS = 30
#: Characters whose counts are compared, 8 to a long, 8 bits each (modulo 256).
COUNTED = ["aeinorst", "hdlucmfp", "gbvywkjx", "zq .,éüó"]
LAST = (1 << 63) - 1


def segment(length: str, i: int, edits: int) -> tuple[str, str]:
    """SQL for (start from 0, length) of segment ``i`` of a line of ``length``: even parts,
    the longer ones last."""
    parts = edits + 1
    short = f"({parts} - {length} % {parts})"  # how many segments have the shorter length
    return (f"({i} * ({length} DIV {parts}) + greatest(0, {i} - {short}))",
            f"({length} DIV {parts} + IF({i} >= {short}, 1, 0))")


def _key(line: str, chars: str, less: int, i: int, shift: int, edits: int) -> str:
    start, size = segment(f"({chars} - {less})", i, edits)
    start = f"({start} + {shift})"
    inside = f"{start} >= 0 AND {start} + {size} <= {chars}"
    return f"IF({inside}, xxhash64({chars} - {less}, {i}, substring({line}, CAST({start} + 1 AS INT), CAST({size} AS INT))), NULL)"


def index_keys(line: str = "line", chars: str = "chars", edits: int = EDITS) -> list[str]:
    return [_key(line, chars, 0, i, 0, edits) for i in range(edits + 1)]


def probe_keys(line: str = "line", chars: str = "chars", edits: int = EDITS) -> list[str]:
    """Keys at which lines shorter by 0 to ``edits`` may stand, but for the line's own
    index keys. A segment ``i`` moves by at most the edits left of it, and what the edits
    right of it can make up for."""
    keys = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            right = edits - i
            for shift in range(max(-i, less - right), min(i, less + right) + 1):
                if less or shift:
                    keys.append(_key(line, chars, less, i, shift, edits))
    return keys


def letter_counts(line: str, counted: str) -> str:
    lanes = [f"shiftleft(CAST(((octet_length({line}) - octet_length(replace({line}, '{c}', ''))) DIV {len(c.encode())}) & 255 AS BIGINT), {8 * j})"
             for j, c in enumerate(counted)]
    return " | ".join(lanes)


def counts_near(a: str, b: str, edits: int = EDITS) -> str:
    """SQL for: the counts in the arrays ``a`` and ``b`` differ by what the edits can do."""
    lane = lambda x, k, j: f"(shiftrightunsigned({x}[{k}], {8 * j}) & 255L)"
    parts = [f"abs((({lane(a, k, j)} - {lane(b, k, j)} + 384L) % 256L) - 128L)"
             for k, counted in enumerate(COUNTED) for j in range(len(counted))]
    return f"({' + '.join(parts)} <= {2 * edits})"


def within(a: str, b: str, edits: int = EDITS) -> str:
    """SQL for: the edit distance of strings ``a`` and ``b`` is at most ``edits``.

    Bit d of a word stands for the diagonal ``edits - d`` above the main one. ``vp`` / ``vn``:
    the cell is one more / less than the one above it; ``d0``: the cell equals its upper
    left neighbour. The cost follows the diagonal on which the last cell lies.
    """
    mask = (1 << (2 * edits + 1)) - 1
    start = mask & ~((1 << edits) - 1)
    match = " | ".join(f"IF(get(x.p, j - {edits - d + 1}) = get(x.t, j - 1), {1 << d}L, 0L)" for d in range(2 * edits + 1))
    d0 = "((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {}L".format(mask)
    after = (f"named_struct('vp', ((d0 & s.vp) | ~(shiftright(d0, 1) | hp)) & {mask}L, 'vn', shiftright(d0, 1) & hp,"
             f" 'cost', s.cost + IF(j > -x.tilt, 1 - CAST(shiftright(d0, {edits} + x.tilt) & 1L AS INT), 0))")
    step = let(match, "m", let(d0, "d0", let(f"(s.vn | ~(d0 | s.vp)) & {mask}L", "hp", after)))
    run = f"""aggregate(sequence(1, size(x.t)), named_struct('vp', {start}L, 'vn', 0L, 'cost', abs(x.tilt)),
        (s, j) -> IF(s.cost > {edits}, s, {step}), s -> s.cost <= {edits})"""
    chars = f"named_struct('p', split({a}, ''), 't', split({b}, ''), 'tilt', CAST(length({a}) - length({b}) AS INT))"
    return (f"CASE WHEN {a} = {b} THEN true WHEN abs(length({a}) - length({b})) > {edits} THEN false"
            f" WHEN length({b}) = 0 THEN true ELSE {let(chars, 'x', run)} END")


def _last(docs: DataFrame) -> Column:
    """What a null id counts as: after all others."""
    return F.lit(LAST) if docs.schema["id"].dataType.simpleString() == "bigint" else F.lit("\U0010ffff" * 4)


def _lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(id, version, nth, line, chars, h1, h2) for each line long enough, with ``short`` also
    for each shorter one that isn't blank; docs: (id, text)."""
    exploded = docs.select("id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("nth", "line"))
    wanted = F.col("chars") >= MIN_CHARS
    wanted = wanted | F.col("line").rlike(r"\S") if short else wanted
    return exploded.withColumn("chars", F.length("line")).where(wanted).select(
        "id", "version", "nth", "line", "chars", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _texts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(h1, line, letters) of the lines in ``shared`` (h1, id): read again from their
    documents."""
    lines = staged(shared.select("h1", "id").distinct(), "line-wanted")
    n = lines.count()
    named = docs.select(F.coalesce("id", _last(docs)).alias("id"), "text")  # as places name them
    some = lookup_join(named, lines.select("id").distinct(), "id", n, "left_semi")
    found = lookup_join(_lines(some), lines.select("h1").distinct(), "h1", n, "left_semi").groupBy("h1").agg(F.min("line").alias("line"))
    counts = ", ".join(letter_counts("line", c) for c in COUNTED)
    return staged(found.select("h1", "line", F.expr(f"array({counts})").alias("letters")), "line-texts")


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Those of ``pairs`` (early, late) that lie within ``edits`` edits."""
    both = (pairs.join(texts.select(F.col("h1").alias("early"), F.col("line").alias("a")), "early")
            .join(texts.select(F.col("h1").alias("late"), F.col("line").alias("b")), "late"))
    return both.where(F.expr(within("a", "b", edits))).select("early", "late")


def near_lines(docs: DataFrame, *, edits: int = EDITS) -> DataFrame:
    """``docs`` (id, text) -> (h1, early): each distinct line that has an earlier distinct line
    within ``edits`` edits, with one such line. Lines are named by their hash."""
    order = F.struct(F.coalesce("id", _last(docs)).alias("id"), F.col("nth").alias("nth"))
    keys = [f"named_struct('key', {k}, 'indexed', {flag})" for flag, ks in
            (("true", index_keys(edits=edits)), ("false", probe_keys(edits=edits))) for k in ks]
    lines = _lines(docs).select("h1", "h2", order.alias("place"), F.expr(f"array({', '.join(keys)})").alias("keys"))
    distinct = lines.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("keys").alias("keys"))
    rows = distinct.select("h1", "place.id", "place.nth", F.expr("inline(keys)")).where("key IS NOT NULL")
    alike = staged(
        rows.selectExpr("*", "min(h1) OVER (PARTITION BY key) AS lo", "max(h1) OVER (PARTITION BY key) AS hi",
                        "max(indexed) OVER (PARTITION BY key) AS any_indexed")
        .where("lo <> hi AND any_indexed").drop("lo", "hi", "any_indexed"), "line-alike")
    texts = _texts(docs, alike)
    shared = staged(alike.join(texts.drop("line"), "h1"), "line-shared")

    place = F.struct("id", "nth", "h1", "letters")
    probe = shared.select("key", place.alias("x"))
    index = shared.where("indexed").select("key", place.alias("y"))
    leader = index.groupBy("key").agg(F.min("y").alias("y"))
    near = F.expr("x.h1 <> y.h1 AND " + counts_near("x.letters", "y.letters", edits))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x", "y").alias("e"), F.greatest("x", "y").alias("l")).selectExpr(
            "e.h1 AS early", "l.h1 AS late").distinct()

    first = staged(ordered(probe.join(leader, "key").where(near)), "line-first")
    links = staged(_verified(first, texts, edits), "line-links")
    gone = links.select("late").distinct()
    # Pairs that can still decide something: their later line stands so far.
    standing = shared.join(gone, F.col("h1") == F.col("late"), "left_anti").select("key", place.alias("x"))
    standing_index = shared.where("indexed").join(gone, F.col("h1") == F.col("late"), "left_anti").select("key", place.alias("y"))
    rest = (standing.join(index, "key").where(near & (F.col("y") < F.col("x")))
            .unionByName(probe.join(standing_index, "key").where(near & (F.col("x") < F.col("y")))))
    rest = staged(ordered(rest).join(first, ["early", "late"], "left_anti"), "line-rest")
    more = _verified(rest, texts, edits)
    return staged(links.unionByName(more).groupBy("late").agg(F.min("early").alias("early"))
                  .select(F.col("late").alias("h1"), "early"), "line-near")


def dedup_lines(docs: DataFrame, *, edits: int = EDITS, short_repeats: bool = False, id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs`` with the text's repeated lines removed, ``n_lines`` (of its text before) and
    ``n_dropped``. ``short_repeats``: exact repeats of lines under MIN_CHARS go, too."""
    whole = isinstance(docs.schema[id].dataType, T.IntegralType)
    name = col(id).cast("long" if whole else "string")
    plain = docs.select(name.alias("id"), col(text).alias("text"))
    near = near_lines(plain, edits=edits)
    lines = staged(_lines(plain, short_repeats).select("id", "version", "nth", "h1", "h2"), "line-places")
    place = F.struct(F.coalesce("id", _last(plain)).alias("id"), "nth", "version")  # rows may share an id
    first = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    doubtful = first.join(near.select("h1", F.lit(True).alias("near")), "h1", "left").where("n > 1 OR near")
    dropped = staged(
        lines.join(doubtful, ["h1", "h2"]).where((place != F.col("first")) | F.coalesce("near", F.lit(False)))
        .groupBy("id", "version").agg(F.collect_set("nth").alias("__drop")).select(F.col("id").alias("__id"), F.col("version").alias("__v"), "__drop"),
        "line-dropped")
    size = dropped.agg(F.coalesce(F.sum(F.size("__drop") + 3), F.lit(0))).first()[0]
    out = ("n_lines", "n_dropped")
    keep = others(docs, out)
    marked = lookup_join(docs.select(*[col(c) for c in keep]), dropped,
                         name.eqNullSafe(F.col("__id")) & (F.xxhash64(col(text)) == F.col("__v")), size, "left")
    parts = F.split(col(text), "\n")
    kept: Column = F.when(F.col("__drop").isNull(), col(text)).otherwise(F.expr(
        f"array_join(filter(split(`{text}`, '\\\\n'), (l, i) -> NOT array_contains(__drop, i)), '\\n')"))
    return marked.select(
        *[kept.alias(c) if c == text else col(c) for c in keep],
        F.when(col(text).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("long").alias("n_dropped"))
