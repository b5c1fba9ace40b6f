"""Parquet tables: batches land once, overwrites are whole, sweeps touch only wrecks."""

from __future__ import annotations

import pytest
from lakeledger.sources import tables as tb
from pyspark.sql import functions as F


def numbers(spark, lo, hi):
    return spark.range(lo, hi).withColumn("part", F.col("id") % 3)


def ids(spark, path):
    return sorted(r.id for r in tb.read_table(spark, path).collect())


def test_a_batch_lands_once(spark, warehouse):
    assert tb.append_once(numbers(spark, 0, 9), warehouse, app_id="x", version=0, partition_by=("part",))
    assert not tb.append_once(numbers(spark, 50, 60), warehouse, app_id="x", version=0, partition_by=("part",))
    assert tb.append_once(numbers(spark, 9, 12), warehouse, app_id="x", version=1, partition_by=("part",))
    assert ids(spark, warehouse) == list(range(12))


def test_app_ids_never_share_a_folder(spark, warehouse):
    apps = ["a b", "a_20_b", "a%20b", "a/b", "ä", "a=b", "a.b", "a:b"]
    for n, app in enumerate(apps):
        assert tb.append_once(numbers(spark, 10 * n, 10 * n + 3), warehouse, app_id=app, version=0)
    assert len(ids(spark, warehouse)) == 3 * len(apps)
    got = tb.read_table(spark, warehouse, batches=True).select("app_id").distinct().collect()
    assert {r.app_id for r in got} == set(apps)


def test_an_incomplete_batch_is_written_again(spark, warehouse):
    folder = tb.batch_folder(warehouse, "x", 0)
    tb.append_once(numbers(spark, 0, 50), warehouse, app_id="x", version=0)
    tb.drop_folder(spark, f"{folder}/{tb.DONE}")  # as if the writer had died
    assert not tb.holds_batches(spark, warehouse, "x")
    assert tb.append_once(numbers(spark, 0, 9), warehouse, app_id="x", version=0)
    assert ids(spark, warehouse) == list(range(9)) and tb.holds_batches(spark, warehouse, "x")


def test_sweep_removes_old_wrecks_only(spark, warehouse):
    for v in range(3):
        tb.append_once(numbers(spark, 10 * v, 10 * v + 5), warehouse, app_id="x", version=v)
    tb.drop_folder(spark, f"{tb.batch_folder(warehouse, 'x', 1)}/{tb.DONE}")
    assert tb.sweep(spark, warehouse, retain_hours=1) == []
    assert len(tb.sweep(spark, warehouse, retain_hours=0)) == 1
    assert ids(spark, warehouse) == [*range(5), *range(20, 25)]


def test_replace_all_swaps_columns_too(spark, warehouse):
    path = f"{warehouse}/t"
    tb.replace_all(numbers(spark, 0, 9), path, partition_by=("part",))
    tb.replace_all(spark.range(3).withColumn("new", F.lit("x")), path)
    got = tb.read_table(spark, path)
    assert got.columns == ["id", "new"] and got.count() == 3


def test_replace_partitions(spark, warehouse):
    path = f"{warehouse}/t"
    tb.replace_all(numbers(spark, 0, 9), path, partition_by=("part",))
    tb.replace_partitions(numbers(spark, 100, 109).where("part = 1"), path, column="part", values=[1, 2, 7])
    assert tb.partition_values(spark, path, "part") == ["0", "1"]
    assert sorted(i for i in ids(spark, path) if i < 100) == [0, 3, 6]


def test_added_columns_read_as_null_in_old_rows(spark, warehouse):
    from pyspark.sql import types as T

    tb.append(spark.range(2), warehouse)
    tb.append(spark.range(2, 4).withColumn("more", F.lit(1)), warehouse)
    wide = T.StructType([T.StructField("id", T.LongType()), T.StructField("more", T.IntegerType())])
    assert sorted((r.id, r.more) for r in tb.read_table(spark, warehouse, wide).collect()) == [(0, None), (1, None), (2, 1), (3, 1)]


def test_compact_copies_all_rows_into_fewer_files(spark, warehouse):
    for v in range(6):
        tb.append_once(numbers(spark, 10 * v, 10 * v + 10).repartition(3), f"{warehouse}/t", app_id="x", version=v)
    assert tb.compact(spark, f"{warehouse}/t", f"{warehouse}/c", partition_by=("part",)) == 60
    assert ids(spark, f"{warehouse}/c") == list(range(60))
    assert len(spark.read.parquet(f"{warehouse}/c").inputFiles()) <= 6


def test_missing_table(spark, warehouse):
    with pytest.raises(tb.TableNotFound):
        tb.read_table(spark, f"{warehouse}/none")
