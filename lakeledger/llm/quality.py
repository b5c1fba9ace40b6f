"""Quality rules as a short-circuit cascade (native: DataFrame and SQL functions only).

Rules are SQL predicates that reject a document. On a sample the cost and the
selectivity of each rule are estimated; rules are then tried in the order of
rejections per unit of cost, as branches of one CASE expression, so a document pays
only for the rules up to the first that rejects it. A document is kept when no rule
rejects it: the order decides what is spent (and which of several failing rules is
named), never what is kept.

Everything is one projection over the scan: no exchange, whole texts, one document at
a time. Thresholds are ratios, written as integer comparisons, so they are exact.

Edge cases: a null text has no words; empty and blank texts too (rejected as short). A
text of one huge word or line takes time linear in its length. Repeated rows are
judged alike. An empty table gives an empty result. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import SPACE, col, others, staged, words

MIN_WORDS = 50
#: Rows of the sample on which rules are timed (an upper bound).
SAMPLE_ROWS = 2_000

SYMBOLS = "#*$%&|<>"


def _count(chars: str, text: str = "__t") -> str:
    """How often any of ``chars`` (one byte each) occurs: bytes lost when they go."""
    stripped = text
    for c in chars:
        stripped = f"replace({stripped}, '{c}', '')"
    return f"CAST(octet_length({text}) - octet_length({stripped}) AS BIGINT)"


def _matched(pattern: str, text: str = "__t") -> str:
    return f"CAST(length(regexp_replace({text}, '[^{pattern}]+', '')) AS BIGINT)".replace("\\", "\\\\")


_LINES = (f"filter(split(__t, '\\n'), l -> l RLIKE '[^{SPACE}]')").replace("\\", "\\\\")

#: Positions of windows that occur twice or more: equal windows stand side by side once
#: sorted. Reached only by texts that hold some window hash twice.
_REPEATS = """aggregate(
    sort_array(transform(
        filter(
            transform(array(sort_array(transform(slice(__w, 1, size(__w) - 2), (x, i) -> named_struct(
                'a', x, 'b', get(__w, i + 1), 'c', get(__w, i + 2), 'i', i)))), s -> transform(s, (x, j) -> named_struct(
                'i', x.i,
                'twice', coalesce((x.a = get(s, j - 1).a AND x.b = get(s, j - 1).b AND x.c = get(s, j - 1).c), false)
                      OR coalesce((x.a = get(s, j + 1).a AND x.b = get(s, j + 1).b AND x.c = get(s, j + 1).c), false))))[0],
            x -> x.twice),
        x -> x.i)),
    named_struct('end', 0, 'n', 0L),
    (s, i) -> named_struct('end', i + 3, 'n', s.n + i + 3 - greatest(i, s.end)),
    s -> s.n)"""
_WINDOWS = "transform(slice(__w, 1, size(__w) - 2), (x, i) -> xxhash64(x, get(__w, i + 1), get(__w, i + 2)))"

#: Measures of a document: SQL over ``__t`` (its text, never null) and ``__w`` (its words).
MEASURES = {
    "n_words": "CAST(size(__w) AS BIGINT)",
    "word_chars": "CAST(length(array_join(__w, '')) AS BIGINT)",
    "n_symbols": _count(SYMBOLS),
    "n_lines": f"CAST(size({_LINES}) AS BIGINT)",
    "n_dup_lines": f"transform(array({_LINES}), l -> CAST(size(l) - size(array_distinct(l)) AS BIGINT))[0]",
    "n_repeat_words": (
        f"CASE WHEN size(__w) < 4 THEN 0L WHEN transform(array({_WINDOWS}), h -> size(array_distinct(h)) = size(h))[0]"
        f" THEN 0L ELSE {_REPEATS} END"),
    "n_upper": _matched(r"\p{Lu}"),
    "n_letters": _matched(r"\p{L}"),
    "n_exclaims": _count("!"),
}


@dataclass(frozen=True)
class Rule:
    """``reject``: SQL over measure names in braces, true when the document goes."""

    name: str
    reject: str

    def sql(self, have: frozenset[str] = frozenset()) -> str:
        """The predicate; measures in ``have`` are columns already, others are inlined."""
        return self.reject.format(**{m: m if m in have else f"({sql})" for m, sql in MEASURES.items()})


BASE = [
    Rule("short", f"{{n_words}} < {MIN_WORDS}"),
    Rule("repetitive", "100 * {n_repeat_words} > 50 * {n_words}"),
]
#: Beyond the base: symbols, odd word lengths, repeated lines, capitals, exclamations.
RULES = [
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("word_length", "{word_chars} < 2 * {n_words} OR {word_chars} > 20 * {n_words}"),
    Rule("dup_lines", "2 * {n_dup_lines} > {n_lines}"),
    Rule("capitals", "2 * {n_upper} > {n_letters}"),
    Rule("exclaims", "2 * {n_exclaims} > {n_words}"),
]


def _prepared(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """With ``__t``, the text, and ``__w``, its words. The words come out of a one-element
    generator: a filter on the verdict can't be pushed below it, where the optimizer would
    write the split into every place that looks at a word, once per word."""
    plain = docs.select(*[col(c) for c in keep], F.coalesce(col(text), F.lit("")).alias("__t"))
    return plain.select("*", F.explode(F.array(F.expr(words("__t")))).alias("__w"))


def estimate(docs: DataFrame, rules: list[Rule], *, text: str = "text", sample_rows: int = SAMPLE_ROWS,
             seed: int = 0) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule on a random sample of at most
    ``sample_rows`` rows. One count, one write of the sample, one small job a rule."""
    rows = docs.count()
    if not rows:
        return [(r, 1.0, 0.0) for r in rules]
    share = min(1.0, 0.9 * sample_rows / rows)
    sample = staged(_prepared(docs.select(col(text)).sample(share, seed).limit(sample_rows), text, []), "quality-sample")

    def timed(predicate: str) -> tuple[float, int, int]:
        began = time.perf_counter()
        n, out = sample.agg(F.count("__t"), F.coalesce(F.sum(F.expr(f"IF({predicate}, 1, 0)")), F.lit(0))).first()
        return time.perf_counter() - began, n, out

    timed("size(__w) < 0")  # opens the files and compiles what all rules share
    idle = timed("size(__w) < -1")[0]
    found = []
    for rule in rules:
        seconds, n, out = timed(rule.sql())
        found.append((rule, max(seconds - idle, 1e-3), out / max(n, 1)))
    return found


def ordered(found: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejections per second, most first."""
    return [r for r, s, out in sorted(found, key=lambda x: (-x[2] / x[1], x[1], x[0].name))]


def cascade_sql(rules: list[Rule], have: frozenset[str] = frozenset()) -> str:
    return "CASE " + " ".join(f"WHEN {r.sql(have)} THEN '{r.name}'" for r in rules) + " END"


def cascade(rules: list[Rule], have: frozenset[str] = frozenset()) -> Column:
    """Name of the first rule that rejects, in this order; null if none does. Branches
    after the first true one aren't evaluated."""
    return F.expr(cascade_sql(rules, have))


def judge(docs: DataFrame, *, base: list[Rule] = BASE, rules: list[Rule] = RULES, text: str = "text",
          measures: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``failed_rule`` (the first of ``base`` and ``rules``, as given, that
    rejects; null: none) and ``kept``, after the columns in
    ``measures`` (names of MEASURES), which are then computed for every document."""
    order = ordered(estimate(docs, base + rules, text=text, sample_rows=sample_rows))
    out = (*measures, "failed_rule", "kept")
    keep = others(docs, out)
    frame = _prepared(docs, text, keep)
    for m in measures:
        frame = frame.withColumn(m, F.expr(MEASURES[m]))
    have = frozenset(measures)
    judged = frame.withColumn("__hit", cascade(order, have))
    # The verdict is the cascade's; the name is that of the first rule in the given order, so
    # it doesn't hang on how long a rule took. Only rejected rows evaluate it.
    named = judged.withColumn("failed_rule", F.expr(f"IF(__hit IS NULL, NULL, {cascade_sql(base + rules, have)})"))
    return named.select(*[col(c) for c in keep], *measures, "failed_rule", F.col("__hit").isNull().alias("kept"))
