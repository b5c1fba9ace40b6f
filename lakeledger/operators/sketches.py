"""Stored sketches per day that merge over any range of days (A11, X3).

Distinct counts are HyperLogLog sketches: ``LG_K`` = 12 keeps 4,096 registers (at most 4 kB a
day and column) and a standard error of 0.8 / sqrt(2**LG_K) = 1.3 %. Lags are quantile
sketches (KLL), whose rank error is about 1.3 % at K = 200. A range of days merges its
sketches; no row is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
#: Bounds that estimates are held to: three standard errors, and the rank error.
DISTINCT_ERROR, RANK_ERROR = 3 * 0.8 / 2 ** (LG_K / 2), 0.0265


def daily_sketches(bronze: DataFrame, *, by: str = "ingest_date") -> DataFrame:
    """One row a day: messages, sketches of ids and accounts, sketch of the lag in seconds."""
    lag = (F.unix_micros("ingested_at") - F.unix_micros("produced_at")) / 1e6
    return bronze.groupBy(by).agg(
        F.count(F.lit(1)).alias("messages"), F.hll_sketch_agg("transaction_id", LG_K).alias("ids"),
        F.hll_sketch_agg("account_id", LG_K).alias("accounts"), F.kll_sketch_agg_double(lag).alias("lags"))


def merged(daily: DataFrame, *by) -> DataFrame:
    """Sketches of groups of days."""
    return daily.groupBy(*by).agg(
        F.sum("messages").alias("messages"), F.hll_union_agg("ids").alias("ids"), F.hll_union_agg("accounts").alias("accounts"),
        F.kll_merge_agg_double("lags").alias("lags"))


def estimates(sketches: DataFrame) -> DataFrame:
    return sketches.withColumns({
        "transactions": F.hll_sketch_estimate("ids"), "n_accounts": F.hll_sketch_estimate("accounts"),
        "p50_lag": F.kll_sketch_get_quantile_double("lags", F.lit(0.5)), "p99_lag": F.kll_sketch_get_quantile_double("lags", F.lit(0.99)),
    }).drop("ids", "accounts", "lags")
