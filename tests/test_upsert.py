"""Merge by key: touched partitions alone are rewritten; a writer that dies is rolled forward."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from lakeledger.sources import tables as tb
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("day", T.StringType())])
HOW = {"key": ("day", "k"), "partition_by": ("day",), "schema": SCHEMA}


def frame(spark, rows, gone=()):
    return spark.createDataFrame([(*r, False) for r in rows] + [(*r, True) for r in gone], "k string, v long, day string, gone boolean")


def table(spark, path):
    return {(r.day, r.k): r.v for r in tb.read_table(spark, path, SCHEMA).collect()}


def files(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in Path(path).rglob("*.parquet")}


def test_random_merges(spark, tmp_path):
    rng, path, want = random.Random(2), str(tmp_path / "t"), {}
    for turn in range(4):
        days = rng.sample(["a", "b/c", "d e", None], 2)
        keys = {(rng.choice(days), rng.choice([None, *"pqrstu"])) for _ in range(8)}
        rows = [(k, rng.randrange(100), d) for d, k in keys]
        cut = rng.randrange(len(rows)) if turn else len(rows)
        tb.upsert(frame(spark, rows[:cut], rows[cut:]), path, deleted="gone", **HOW)
        want |= {(d, k): v for k, v, d in rows[:cut]}
        for k, _, d in rows[cut:]:
            want.pop((d, k), None)
        assert table(spark, path) == want


def test_other_partitions_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.upsert(frame(spark, [(k, 1, d) for k in "xyz" for d in "abc"]), path, **HOW)
    before = files(path)
    assert tb.upsert(frame(spark, [("x", 2, "b"), ("w", 3, "b")], [("y", 0, "b")]), path, deleted="gone", **HOW) == [("b",)]
    after = files(path)
    assert {f: b for f, b in before.items() if "day=b" not in f} == {f: b for f, b in after.items() if "day=b" not in f}
    assert {k: v for k, v in table(spark, path).items() if k[0] == "b"} == {("b", "x"): 2, ("b", "w"): 3, ("b", "z"): 1}
    # A partition whose rows all go leaves no folder.
    tb.upsert(frame(spark, [], [(k, 0, "c") for k in "xyz"]), path, deleted="gone", **HOW)
    assert not (tmp_path / "t" / "day=c").exists() and len(table(spark, path)) == 6
    tb.upsert(frame(spark, []), path, **HOW)
    assert len(table(spark, path)) == 6


@pytest.mark.parametrize("step", ["staged", "placed"])
def test_a_dead_writer_is_rolled_forward(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    tb.upsert(frame(spark, [(k, 1, d) for k in "xyz" for d in "ab"]), path, **HOW)
    real = tb.finish_rewrite if step == "staged" else tb.drop_folder
    calls = []

    def dying(*a, **b):
        calls.append(a)
        if step == "placed" and not str(a[1]).endswith("t/day=a"):
            return real(*a, **b)
        if step == "staged" and len(calls) < 3:
            return real(*a, **b)
        raise RuntimeError("killed")

    monkeypatch.setattr(tb, "finish_rewrite" if step == "staged" else "drop_folder", dying)
    with pytest.raises(RuntimeError, match="killed"):
        tb.upsert(frame(spark, [("x", 5, "b")], [(k, 0, "a") for k in "xyz"]), path, deleted="gone", **HOW)
    monkeypatch.undo()
    tb.upsert(frame(spark, [("y", 6, "b")]), path, **HOW)
    assert table(spark, path) == {("b", "x"): 5, ("b", "y"): 6, ("b", "z"): 1}


def test_batches_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    for app, n in (("a/b c", 0), ("a/b c", 1), ("é%", 7)):
        tb.append_once(frame(spark, [("k", n, "d")]).drop("gone"), path, app_id=app, version=n, partition_by=("day",))
    assert tb.landed_batches(spark, path) == {("a/b c", 0), ("a/b c", 1), ("é%", 7)}
    assert [r.v for r in tb.read_batches(spark, path, SCHEMA, [("é%", 7), ("a/b c", 1)]).orderBy("v").collect()] == [1, 7]
    assert tb.read_batches(spark, path, SCHEMA, []).count() == 0 and tb.landed_batches(spark, str(tmp_path / "none")) == set()
