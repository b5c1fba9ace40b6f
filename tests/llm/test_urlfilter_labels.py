"""op3_urlfilter on urls that no rule decides: the model, not the rules, has to know them."""

from lakeledger.llm import urlfilter, urllabels
from lakeledger.llm.queries import op3_urlfilter
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"
SPAM = "casino-win|free-bets|spam-farm|cheap-pills|ads-track"
WORDS = SPAM.replace("|", "-").split("-")


def test_table(spark):
    got = [(r.url, r.label) for r in urlfilter.labels(spark).collect()]
    assert got == urllabels.TABLE and len({u for u, _ in got}) == len(got) == 655
    # None of the words that the supplied spam hosts are made of stands in a url labelled spam.
    assert not [u for u, label in got if label and any(w in u for w in WORDS)]
    hosts = {r.host for r in op3_urlfilter(spark, SF).select("host").distinct().collect()}
    assert not hosts & {r.host for r in urlfilter.with_host_path(urlfilter.labels(spark)).collect()}


def shares(spark):
    undecided = op3_urlfilter(spark, SF).where("rule IS NULL").select(F.col("host").rlike(SPAM).alias("spam"), "verdict")
    return {r.spam: r.share for r in undecided.groupBy("spam").agg(F.avg(F.expr("IF(verdict = 'block', 1, 0)")).alias("share")).collect()}


def test_blocked_shares_outside_the_rules(spark):
    """On words it never saw the model has only endings, signs and parts of words to go by."""
    share = shares(spark)
    assert share[False] <= 0.1 and share[True] > 2 * share[False]


def test_held_out_urls(spark):
    """Urls held out, their words mostly not: four parts by hash. (With whole host words held
    out it is right about as often as the larger class; README says so.)"""
    rows = urlfilter.with_host_path(urlfilter.labels(spark)).withColumn("part", F.crc32(F.col("url").cast("binary")) % 4)
    right = total = 0
    for part in range(4):
        weights = urlfilter.fit(rows.where(F.col("part") != part).select("url", "label"))
        judged = rows.where(F.col("part") == part).select("label", (urlfilter.block_score(weights) >= 0.5).alias("block"))
        for r in judged.collect():
            right, total = right + (r.block == bool(r.label)), total + 1
    assert right >= 0.8 * total


def test_each_class_has_its_share_of_the_sample(spark):
    rows = [(f"http://casino{i}.biz/win", 1) for i in range(20)] + [(f"http://museum{i}.org/read", 0) for i in range(2_000)]
    weights = urlfilter.fit(spark.createDataFrame(rows, "url string, label int"), max_rows=40)
    page = urlfilter.with_host_path(spark.createDataFrame([("http://casino-99.biz/win",)], "url string"))
    assert page.select(urlfilter.block_score(weights).alias("s")).first().s >= 0.9
