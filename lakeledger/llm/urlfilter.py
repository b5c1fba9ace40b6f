"""URL filter: rules first, then logistic regression on hashed character n-grams of host
and path (native: DataFrame and SQL functions; the fit is Spark ML's, in the JVM).

The model is trained from a small labelled URL table (url, label 1 = block); one comes with
the operator (``labels``, from ``urllabels``). Features
are character n-grams of the host (with a start and an end mark, so that a domain's
ending counts) and of the path, each marked with the part it comes from and hashed into
``dims`` places; a place counts once per url. Scoring adds the fitted weights of a
url's places inside an SQL expression; the weights (``dims`` doubles) travel in the plan
as one literal.

Edge cases: a null url or one without ``://`` has an empty host and path: no rule fits
and the verdict is that of the intercept. One linear pass over the characters, so very
long urls are fine. With labels of one class only, that class is every verdict; with
none, allow. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import urllabels
from lakeledger.llm.common import col, others

DIMS = 2048
GRAMS = (3, 4)


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` (after the first ``://``, A-Z lowered) and ``path`` (from there
    up to ``?`` or ``#``)."""
    u = F.coalesce(col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    place = F.split(rest, "[?#]", 2)[0]
    host = F.split(place, "/", 2)[0]
    kept = df.select(*[col(c) for c in others(df, ("host", "path"))])
    return kept.withColumn("__place", place).withColumn("host", host).withColumn(
        "path", F.expr("substr(__place, length(host) + 1)")).withColumn(
        "host", F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).drop("__place")


def places(dims: int = DIMS) -> Column:
    """Distinct hashed places of the n-grams of ``host`` and ``path``."""
    parts = []
    for part, text in (("h", "concat('^', host, '$')"), ("p", "concat(path, '$')")):
        for n in GRAMS:
            joined = ", ".join(f"c[i + {k}]" for k in range(n))
            parts.append(
                f"transform(array(split({text}, '')), c -> IF(size(c) < {n}, CAST(array() AS ARRAY<INT>),"
                f" transform(sequence(0, size(c) - {n}), i -> CAST(pmod(xxhash64('{part}', {joined}), {dims}) AS INT))))[0]")
    return F.expr(f"array_distinct(concat({', '.join(parts)}))")


def labels(spark: SparkSession) -> DataFrame:
    """The labelled URL table that comes with the operator: (url, label)."""
    rows = "\n".join(f"{label} {url}" for url, label in urllabels.TABLE)
    row = spark.range(1).select(F.explode(F.split(F.lit(rows), "\n")).alias("row"))
    return row.select(F.substring("row", 3, 1 << 20).alias("url"), F.substring("row", 1, 1).cast("int").alias("label"))


def fit(labelled: DataFrame, *, dims: int = DIMS, max_rows: int = 4_000, ridge: float = 1e-4) -> list[float]:
    """Weights (``dims`` of them, then the intercept) from ``labelled`` (url, label). At
    most ``max_rows`` rows enter the fit, of each class those of smallest url hash; a class
    has half of them, or more if the other leaves room. The table is meant to be small,
    and the bound keeps the fit's memory fixed."""
    rows = labelled.select("url", F.col("label").cast("double").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    room = {x: max(max_rows // 2, max_rows - sum(counts.values()) + n) for x, n in counts.items()}
    if len(counts) < 2:
        only = next(iter(counts), 0.0)
        return [0.0] * dims + [log(1e6) if only == 1.0 else -log(1e6)]
    drawn = [rows.where(F.col("label") == x).orderBy(F.xxhash64("url"), "url").limit(n) for x, n in sorted(room.items())]
    table = with_host_path(drawn[0].unionByName(drawn[1])).select("label", places(dims).cast("array<string>").alias("at"))
    sparse = CountVectorizerModel.from_vocabulary([str(d) for d in range(dims)], "at", "features", binary=True)
    model = LogisticRegression(regParam=ridge, standardization=False, maxIter=50).fit(sparse.transform(table))
    return [float(x) for x in model.coefficients.toArray()] + [float(model.intercept)]


def block_score(weights: list[float]) -> Column:
    """Probability of block for the columns ``host`` and ``path``."""
    *per_place, intercept = weights
    table = F.split(F.lit(",".join(repr(w) for w in per_place)), ",").cast("array<double>")
    at = places(len(per_place))
    total = F.aggregate(at, F.lit(float(intercept)), lambda s, i: s + F.get(table, i))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def best_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none
    does. ``rules``: (verdict, rule), a rule being ``host/path...``. It fits its host and
    all subdomains when the url's path starts with the rule's path."""
    rule, verdict = None, None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, path = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith("/" + path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return rule, verdict


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]], *, dims: int = DIMS) -> DataFrame:
    """``pages`` with host, path, ``rule``, ``score`` (the model's probability of block) and
    ``verdict``: the rule's, else block when the score is at least 0.5."""
    weights = fit(labelled, dims=dims)
    rule, verdict = best_rule(rules)
    parsed = with_host_path(pages)
    judged = parsed.select(*[col(c) for c in others(parsed, ("rule", "score", "verdict"))],
                           rule.alias("rule"), block_score(weights).alias("score"), verdict.alias("__said"))
    return judged.withColumn("verdict", F.coalesce("__said", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))).drop("__said")
