"""Difference of two tables as multisets: EXCEPT ALL in both directions in one pass.

Rows travel as two 64-bit hashes with a sign. A hash whose signs add up to zero and whose
rows agree in the second hash holds the same rows on both sides; rows themselves are read
and compared only for the other hashes, so equal tables cost one slim shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hashes(columns: list[str]) -> list[Column]:
    nulls = F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns])  # a null is no empty value
    return [F.xxhash64(nulls, *columns).alias("_h1"), F.xxhash64(*columns[::-1], nulls, F.lit(1)).alias("_h2")]


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies``: how many more ``a`` has (less than
    zero: ``b`` has more). Columns are matched by name; nulls are equal."""
    columns = a.columns
    sides = [df.select(*columns).withColumn("_sign", F.lit(sign)) for df, sign in ((a, 1), (b, -1))]
    hashed = [s.select("*", *_hashes(columns)) for s in sides]
    slim = reduce(DataFrame.unionByName, (s.select("_h1", "_h2", "_sign") for s in hashed))
    odd = (slim.groupBy("_h1").agg(F.sum("_sign").alias("n"), F.min("_h2").alias("lo"), F.max("_h2").alias("hi"))
           .where("n <> 0 OR lo <> hi").select("_h1"))
    rows = reduce(DataFrame.unionByName, (s.join(odd, "_h1", "left_semi") for s in hashed))
    return rows.groupBy(*columns).agg(F.sum("_sign").alias("copies")).where("copies <> 0")
